"""Stages on documents whose extra columns are called like internal ones."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, line_dedup, mixing, passage_dedup, simhash, toxicity

INTERNAL = (
    "_starts", "_id", "_of", "_rate", "_copies", "_copy", "_membership", "_spans", "_row_sha", "_toxic_score", "_none",
    "_first", "_key", "_row", "_n_tokens", "_posteriors", "fp", "root", "key", "spans", "column0", "column2", "count", "a.b",
)
SENTENCE = "the quick brown fox number {} jumps over the lazy dog and runs through the green wood until night falls down"


@pytest.fixture(scope="module")
def plain(spark):
    repeated = "\n".join(SENTENCE.format(k) for k in ("one", "two", "three"))
    texts = {i: f"{SENTENCE.format(i)}\n{repeated}\n{SENTENCE.format(i * i)}" for i in range(12)}
    texts |= {20: texts[3], 21: texts[3].upper(), 22: None, 23: "", 24: "you stupid hateful idiot"}
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)


def labels(spark):
    rows = [(i, i % 2, int(i == 24)) for i in [*range(12), 24]]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def mixed(docs):
    spark = docs.sparkSession
    domains = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(12)], "doc_id bigint, domain string")
    two = docs.select("doc_id", "text")
    return mixing.mixed(docs, mixing.fit(two, domains, {"a": 0.7, "b": 0.3}))


STAGES = {
    "lines": line_dedup.drop_repeated_lines,
    "simhash": simhash.drop_near_duplicates,
    "passages": passage_dedup.drop_repeated_passages,
    "exact": exact_dedup.drop_exact_duplicates,
    "toxicity": lambda docs: toxicity.drop_toxic(docs, labels(docs.sparkSession)),
    "mixing": mixed,
}


@pytest.mark.parametrize("name", STAGES)
def test_extra_columns_stay_as_they_are(plain, name):
    stage = STAGES[name]
    value = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in INTERNAL}
    wide = plain.select(*[v.alias(c) for c, v in list(value.items())[:5]], "text", "doc_id",
                        *[v.alias(c) for c, v in list(value.items())[5:]])
    out = stage(wide)
    assert out.columns == wide.columns
    rows = out.collect()
    want = sorted((tuple(r) for r in stage(plain).collect()), key=repr)
    assert rows and sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == want
    for r in rows:
        assert all(r[c] == f"{c}{r['doc_id']}" for c in INTERNAL)
