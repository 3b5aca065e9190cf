"""Repeated passages against brute force: windows, exact Jaccard of all lines, planted cases."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import xxhash

from tidemark.llm import passage_dedup as P
from tidemark.llm.queries import QUERIES

from .conftest import SF_DIR, frame


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(n))


def shingles(line):
    w = line.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain_near(lines):
    """Component of each line by the Jaccard similarity of all pairs."""
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {x: shingles(x) for x in lines}
    for a, b in combinations(lines, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    groups = defaultdict(set)
    for x in lines:
        groups[find(x)].add(x)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_units_are_hashes_of_their_words():
    rng = random.Random(1)
    text = "\n".join([prose(rng, 60), "short line", prose(rng, 5000), prose(rng, 16)])
    words = text.split()
    uid, start, n, bands = P.units(text)
    assert (n >= 16).all() and bands[:3].all() and not bands[3:].any()
    assert uid[0] == xxhash.xxh64_intdigest(text.split("\n")[0], 42)
    again = P.units(text.replace(text.split("\n")[0], "x y z"))
    shift = len(words) - len(text.replace(text.split("\n")[0], "x y z").split())
    moved = {(u, s - shift, k) for u, s, k in zip(uid[3:], start[3:], n[3:]) if s > 80}
    assert moved <= set(zip(*again[:3]))
    assert P.units("a b")[3].shape == P.units(None)[3].shape == (0, P.BANDS)


def test_sub_paragraphs_are_found_wherever_a_passage_stands():
    rng = random.Random(4)
    missed = 0
    for _ in range(300):
        passage = prose(rng, rng.randint(51, 70))
        a = P.units(prose(rng, rng.randint(0, 90)) + " " + passage + " " + prose(rng, rng.randint(0, 90)))[0]
        b = P.units(prose(rng, rng.randint(0, 90)) + " " + passage + " " + prose(rng, rng.randint(0, 90)))[0]
        missed += not set(a) & set(b)
    assert missed <= 3


def test_near_lines_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rng = random.Random(9)
    extra = []
    base = prose(rng, 120).split()
    for k in range(60):  # one crowded band of variants
        w = list(base)
        w[rng.randrange(120)] = f"edit{k}"
        extra.append((10_000 + k, " ".join(w)))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    lines = {x for r in docs.collect() for x in (r.text or "").split("\n") if len(x.split()) >= 16}
    uid = {np.uint64(xxhash.xxh64_intdigest(x, 42)).astype(np.int64).item(): x for x in lines}
    found = defaultdict(set)
    for r in P._near_lines(docs, P.occurrences(docs).where("size(bands) > 0")).collect():
        found[r.root].add(uid[r.node])
    assert {frozenset(g) for g in found.values()} == plain_near(sorted(lines))


def test_planted_and_clean_documents(spark):
    rng = random.Random(6)
    passage, header = prose(rng, 60), prose(rng, 9)
    rows = [(k, f"{header}\n{prose(rng, 150)}") for k in range(30)]
    rows += [(100 + k, f"{header}\n{prose(rng, 40)} {passage} {prose(rng, 40)}") for k in range(5)]
    whole = prose(rng, 200)
    rows += [(200, whole), (201, whole), (202, whole.replace(" ", "\n", 1))]
    got = {r.doc_id: r for r in P.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == {101, 102, 103, 104, 201, 202}
    assert all(got[d].kept_in == [100] for d in (101, 102, 103, 104)) and got[201].kept_in == [200]
    assert [tuple(s) for s in got[201].spans] == [(0, 200)]
    texts = dict(rows)
    for d in (101, 102, 103, 104):
        (span,) = got[d].spans
        assert " ".join(texts[d].split()[span.start : span.start + span.n]) in passage and span.n >= 20
    kept = {r.doc_id: r.text for r in P.drop_repeated_passages(frame(spark, rows)).collect()}
    assert kept[201] == "" and all(kept[k] == texts[k] for k in [*range(30), 100, 200])
    assert all(len(kept[d].split()) == len(texts[d].split()) - got[d].spans[0].n for d in (101, 102))


def wrapped(text, size, at=0):
    w = text.split()
    cuts = [0, *range(at or size, len(w), size), len(w)]
    return "\n".join(" ".join(w[a:b]) for a, b in zip(cuts, cuts[1:]))


def test_passages_over_short_lines(spark):
    rng = random.Random(11)
    passage = prose(rng, 60)
    texts = [wrapped(prose(rng, 25) + " " + passage + " " + prose(rng, 25), 10, at) for at in (10, 3, 7)]
    rows = [*enumerate(texts), (3, wrapped(prose(rng, 120), 10)), (4, prose(rng, 20) + " " + passage)]
    got = {r.doc_id: r for r in P.repeated_passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2, 4} and all(r.kept_in == [0] for r in got.values())
    kept = {r.doc_id: r.text for r in P.drop_repeated_passages(frame(spark, rows)).collect()}
    for d, t in rows:
        w = t.split()
        stays = len(w) - sum(s.n for s in got[d].spans) if d in got else len(w)
        assert len(kept[d].split()) == stays
        assert all(" ".join(w[s.start : s.start + s.n]) in passage for s in (got[d].spans if d in got else []))


def test_every_passage_of_37_words_has_a_common_run():
    rng = random.Random(12)
    for _ in range(3000):
        passage = prose(rng, 37)
        a, b = (P.units(f"{prose(rng, rng.randint(0, 60))} {passage} {prose(rng, rng.randint(0, 60))}") for _ in range(2))
        assert {u for u, n in zip(a[0], a[2]) if n == 16} & set(b[0])


def test_whole_passages_go(spark):
    rng = random.Random(13)

    def around(inner):
        return f"{prose(rng, rng.randint(0, 60))} {inner} {prose(rng, rng.randint(0, 60))}"

    rows, want = [], {}
    for k in range(0, 120, 3):
        passage = prose(rng, rng.randint(37, 110))
        part = " ".join(passage.split()[:30])  # an earlier text may have less of it
        rows += [(k, around(part)), (k + 1, around(passage)), (k + 2, around(passage))]
        want[k + 2] = passage
    texts = dict(rows)
    got = {r.doc_id: r.spans for r in P.repeated_passages(frame(spark, rows)).collect()}
    for d, passage in want.items():
        (span,) = got[d]
        assert " ".join(texts[d].split()[span.start : span.start + span.n]) == passage


def test_contexts_in_arrays_and_dealt_against_all_pairs(spark):
    rng = random.Random(14)
    rows, at = {}, 0
    for uid in range(60):
        for _ in range(rng.choice([1, 2, 5, 40])):
            words = [rng.randint(1, 2) for _ in range(rng.randint(1, P.WINDOW - 1))]
            hashes = tuple(hash((uid, *words[: k + 1])) for k in range(len(words)))
            side, first = rng.choice([-1, 1]), (rng.choice([None, rng.randint(0, 9)]), rng.randint(0, 9), at)
            rows.setdefault((uid, side, hashes), first)
            at += 1

    def order(place):
        return (place[0] is not None, place[0] or 0, *place[1:])

    want = set()
    for (uid, side, own), first in rows.items():
        found = (None, None)
        for k in range(len(own)):
            alike = [f for (u, s, o), f in rows.items() if (u, s) == (uid, side) and o[k : k + 1] == own[k : k + 1]]
            least = min(alike, key=order)
            found = (k + 1, least) if least != first else found
        want.add((uid, side, own[-1], first, len(own), *found))
    kind = "uid bigint, side int, context bigint, _first struct<doc_id:bigint,_key:bigint,start:bigint>, _hashes array<bigint>"
    contexts = spark.createDataFrame([(u, s, o[-1], f, list(o)) for (u, s, o), f in rows.items()], kind)
    for way in (P._compared, P._dealt):
        got = way(contexts).select("uid", "side", "context", "_first", "_n", "_words", "_least").collect()
        assert {tuple(tuple(x) if isinstance(x, tuple) else x for x in r) for r in got} == want and len(got) == len(want)
    assert P._compared(contexts.limit(0)).collect() == []


def test_contexts_deal_no_rows_for_their_hashes_unless_crowded(spark, monkeypatch):
    rng = random.Random(15)
    rows = []
    for k in range(0, 30, 3):
        passage = prose(rng, 60)
        rows += [(k + j, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for j in range(3)]
    dealt = P._dealt
    calls = []
    monkeypatch.setattr(P, "_dealt", lambda contexts: calls.append(1) or dealt(contexts))
    few = sorted(map(str, P.repeated_passages(frame(spark, rows)).collect()))
    assert len(few) == 20 and not calls
    monkeypatch.setattr(P, "GROUP_CONTEXTS", 1)
    assert sorted(map(str, P.repeated_passages(frame(spark, rows)).collect())) == few and calls


def test_units_of_many_texts_are_those_of_each():
    rng = random.Random(16)
    texts = [None, "", "a b", "w " * 300, "x y\n" * 40, "q " * 16, "q " * 15, prose(rng, 5000)]
    texts += [f"{prose(rng, rng.randint(0, 50))}\n{prose(rng, rng.randint(0, 50))}" for _ in range(200)]
    of, *got = P._units([P._split(t) for t in texts])
    for k, text in enumerate(texts):
        assert all((part[of == k] == own).all() and (of == k).sum() == len(own) for part, own in zip(got, P.units(text)))


def test_a_context_is_given_once_and_at_edges(spark, monkeypatch):
    rng = random.Random(17)
    passage = prose(rng, 60)
    rows = [(k, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for k in range(3)]
    rows += [(100 + k, rows[0][1]) for k in range(40)]
    made, table = {}, P.Table

    def kept(frame, purpose, **totals):
        made[purpose] = table(frame, purpose, **totals)
        return made[purpose]

    monkeypatch.setattr(P, "Table", kept)
    assert P.repeated_passages(frame(spark, rows).coalesce(1)).count() == 42
    contexts, edges, given = (made[f"passage-{name}"].rows for name in ("contexts", "edges", "outward"))
    places = sum(n == 16 for _, text in rows for n in P.units(text)[2])
    assert contexts <= given <= contexts * spark.sparkContext.defaultParallelism + edges < places


def test_tables_too_large_for_one_broadcast_go_in_parts(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id % 700 as uid", "id")
    table = P.Table(spark.range(0, 700, 3).selectExpr("id as uid", "id + 1 as more"), "parts")
    want = {how: sorted(map(str, rows.join(table.frame, "uid", how).collect())) for how in ("inner", "left", "left_semi")}
    monkeypatch.setattr(P, "BROADCAST_BYTES", table.rows * P.HASH_BYTES // 3)
    for how, expected in want.items():
        parts = list(P._joined(rows, table, "uid", P.HASH_BYTES, how))
        plans = [part._jdf.queryExecution().executedPlan().toString() for part in parts]
        assert len(parts) > 2 and not any("SortMergeJoin" in plan or "hashpartitioning" in plan for plan in plans)
        tables, joined = P._written(iter(parts), "parts")
        assert len(tables) == len(parts) and sorted(map(str, joined.collect())) == expected


def test_only_places_that_moved_take_another_step(spark, monkeypatch):
    def place(d):
        return (d, 7, 0)

    chain = [(d, 7, 0, 20, place(d - 1)) for d in range(2, 6)] + [(d, 7, 0, 20, place(50)) for d in range(60, 90)]
    chain.append((None, 7, 5, 20, place(90)))
    spans = spark.createDataFrame(chain, "doc_id bigint, _key bigint, start bigint, n bigint, _first struct<doc_id:bigint,_key:bigint,start:bigint>")
    made, table = [], P.Table

    def counted(*args, **totals):
        made.append(table(*args, **totals))
        return made[-1]

    monkeypatch.setattr(P, "Table", counted)
    got = {r._was.doc_id: r._stays for r in P._staying(spans).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 50: 50, 90: 90}
    assert [t.rows for t in made] == [6, 6, 3, 2, 1]


def test_edges(spark):
    rng = random.Random(8)
    text, long_text = prose(rng, 40), prose(rng, 40_000)
    rows = [(1, None), (2, ""), (3, "a b c"), (None, text), (4, text), (4, text), (5, long_text), (6, "w " * 300), (7, text + "\n" + text)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in P.repeated_passages(docs).collect()}
    assert {4, 7} <= set(got) <= {4, 6, 7}
    assert got[4].kept_in == []
    kept = P.drop_repeated_passages(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert P.repeated_passages(frame(spark, [])).collect() == []


def test_query(spark):
    rows = QUERIES["op7_passages"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in rows:
        assert 16 <= r.n_words <= len(texts[r.doc_id].split()) and r.n_spans >= 1 and r.kept_in
