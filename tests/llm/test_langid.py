"""Held-out accuracy, and the probabilities against a plain Kneser-Ney."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import langid
from tidemark.llm.queries import QUERIES

from .conftest import SCHEMA


def grams(words):
    padded = "  " + words
    return [padded[i : i + 4] for i in range(len(padded) - 3)]


def plain_model(text_words, characters):
    """Probability function of one language by the textbook formula."""
    counts = [None, None, None, None, Counter(g for w in text_words for g in grams(w))]
    for k in (3, 2, 1):
        counts[k] = Counter(g[-k:] for g in counts[k + 1])
    discount, totals, kinds = {}, {}, {}
    for k in (1, 2, 3, 4):
        c = Counter(counts[k].values())
        discount[k] = c[1] / (c[1] + 2 * c[2]) if c[1] and c[2] else 0.5
        totals[k], kinds[k] = defaultdict(float), defaultdict(int)
        for g, n in counts[k].items():
            totals[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1

    def chance(gram):
        k = len(gram)
        if k == 0:
            return 1 / characters
        ctx, rest = gram[:-1], chance(gram[1:])
        if not totals[k][ctx]:
            return rest
        return (
            max(counts[k][gram] - discount[k], 0) + discount[k] * kinds[k][ctx] * rest
        ) / totals[k][ctx]

    return chance


def test_probabilities_are_kneser_ney():
    rng = random.Random(2)
    texts = {lang: [" " + " ".join("".join(rng.choices(abc, k=rng.randint(1, 5))) for _ in range(60)) + " " for _ in range(3)]
             for lang, abc in (("x", "abcde"), ("y", "cdefgé"))}
    counted = []
    for lang in ("x", "y"):
        counted.append(np.unique(np.concatenate([langid.keys_of(w) for w in texts[lang]]), return_counts=True))
    model = langid.build(["x", "y"], counted)
    characters = len({c for ws in texts.values() for w in ws for g in grams(w) for c in g[-1]}) + 1
    probe = " abc gé zz fade cé "
    got = model.chances(langid.keys_of(probe))
    for column, lang in enumerate(("x", "y")):
        chance = plain_model(texts[lang], characters)
        assert np.allclose(got[:, column], [chance(g) for g in grams(probe)])
    ce = model.cross_entropies([probe, "", texts["y"][0]])
    assert math.isnan(ce[1, 0]) and ce[2, 1] < ce[2, 0]
    assert np.allclose(ce[0], -np.log(got).mean(axis=0))


def test_slices_change_nothing(monkeypatch):
    words = [langid.letters(t) for t in ("abc abd " * 50, "x", "", "bcd " * 200, "ab")]
    counted = [np.unique(np.concatenate([langid.keys_of(w) for w in words if w]), return_counts=True)]
    model = langid.build(["z"], counted)
    whole = model.cross_entropies(words)
    monkeypatch.setattr(langid, "SLICE", 7)
    assert np.allclose(whole, model.cross_entropies(words), equal_nan=True)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    got = QUERIES["op3_langid"](spark, sf_dir).toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    both = docs.merge(got[got["held_out"]], on="doc_id")
    assert len(both) > 150 and (both["lang"] == both["lang_pred"]).mean() > 0.97
    assert (both["rejected"]).mean() < 0.1


def test_edges(spark):
    def row(d, t, lang):
        return (d, t, lang, None, None, None, None, None)

    rows = [row(i, "the cat and the dog " * 3, "en") for i in range(6)] + [row(10 + i, "der hund und die katze", "de") for i in range(6)]
    rows += [row(30, None, "en"), row(31, "", "de"), row(32, "12 ² !?", "en"), row(None, "the dog", None), row(33, "the " * 90000, None)]
    rows += [row(34, "щука ёж 漢字 😀", None), row(34, "щука ёж 漢字 😀", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) and model.languages == ["de", "en"]
    by = {r.doc_id: r for r in got}
    assert [by[d].lang_pred for d in (30, 31, 32)] == ["und"] * 3 and by[None].lang_pred == "en"
    assert by[33].lang_pred == "en" and by[12].lang_pred == "de" and not by[12].rejected
    assert by[34].rejected and by[34].lang_pred in ("de", "en")
    nothing = langid.fit(docs.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).collect() == []


def test_parts_of_a_model_give_what_the_whole_gives(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(None, None), (None, "щука 漢字 😀"), (-1, ""), (-2, "the " * 9000)], "doc_id bigint, text string")
    asked = docs.select("doc_id", "text").union(extra)

    def found():
        fitted = langid.fit(docs)
        got = langid.predict(asked, fitted).toPandas().sort_values(["doc_id", "cross_entropy"])
        return fitted, got.reset_index(drop=True)

    whole, want = found()
    monkeypatch.setattr(langid, "PART_KEYS", 2000)
    cut, got = found()
    assert len(whole.ranges) == 1 and len(cut.ranges) > 2 and len(want) == asked.count()
    assert np.allclose(cut.limits, whole.limits)
    assert (got["lang_pred"] == want["lang_pred"]).all() and (got["rejected"] == want["rejected"]).all()
    for name in ("score", "cross_entropy"):
        assert np.allclose(got[name], want[name], equal_nan=True)


def test_every_counted_key_is_in_the_model(spark):
    rows = [(i, "abab abab abab " * 9 + "qrs" + chr(0x10400 + i), "en", None, None, None, None, None) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(docs).part(0)
    keys = np.unique(np.concatenate([langid.keys_of(langid.letters(r[1])) for r in rows]))
    assert (model.levels[0].grams == keys).all()
    # Letters beyond the basic plane stay apart.
    assert len({tuple(langid.keys_of(langid.letters(f"a{chr(0x10428 + i)}"))) for i in range(40)}) == 40
