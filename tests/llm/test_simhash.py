"""SimHash near duplicates against a brute-force version."""

import itertools
import random

import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import connected_components
from tidemark.llm.queries import QUERIES

from .conftest import SF_DIR, frame


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Component of each (doc_id, fp) by testing every pair."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, p), (b, q) in itertools.combinations(prints, 2):
        if (p ^ q).bit_count() <= 2:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: find(d) for d in root}


def test_query_against_every_pair(spark):
    rows = QUERIES["op10_simhash"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    prints = [(d, plain_fingerprint(t)) for d, t in texts.items()]
    classes = plain_classes(prints)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (d, f"{p:016x}", classes[d]) for d, p in prints
    }
    assert len(rows) == len(texts)


def test_links_connect_crowded_and_sparse_buckets(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(120)}
    for centre in [rng.getrandbits(64) for _ in range(4)]:
        for _ in range(80):  # a dense ball, crowded in each half
            p = centre
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                p ^= 1 << bit
            prints.add(p)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    unique = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    edges = simhash.links(unique)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count() == 0
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    got = {p: roots.get(p, p) for p in signed}
    mask = (1 << 64) - 1
    want = plain_classes([(p, p & mask) for p in signed])
    assert got == want


def test_edge_cases(spark):
    long_text = "word%d " * 3000 % tuple(range(3000))
    docs = frame(
        spark,
        [
            (5, None), (4, ""), (9, " \t\n"), (None, "a b c d"), (3, "A B c D"), (3, "A B c D"),
            (7, long_text), (6, long_text.upper()), (8, "ä Ä"), (10, "one two"),
        ],
    )
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(by[4]) == [4, 5, 9]
    assert by[3].count(3) == 2 and None in by[3]
    assert sorted(by[6]) == [6, 7]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 8, 10]


def test_every_component_keeps_a_document(spark):
    def text(k):
        return " ".join(random.Random(k).choices(["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op"], k=60))

    rows = [(None, text(k)) for k in range(5)] + [(None, text(0))]  # five texts without an id
    rows += [(1, text(10)), (1, text(11)), (2, text(11)), (3, text(11))]  # one id in two components
    rows += [(4, None), (4, ""), (7, text(12)), (7, text(12))]  # one document each
    kept = [(r.doc_id, r.text or "") for r in simhash.drop_near_duplicates(frame(spark, rows)).collect()]
    want = [(None, text(k)) for k in range(5)] + [(1, text(10)), (1, text(11)), (4, ""), (7, text(12))]
    assert sorted(kept, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.drop_near_duplicates(docs).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    edges += [(300, 200), (200, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert got == want
