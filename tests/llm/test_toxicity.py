"""Held-out accuracy of the toxicity model, and its edge cases."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES

from .conftest import frame

LABELS = "doc_id bigint, toxic int, quality int, text string"


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, sf_dir).toPandas()
    assert rows["score"].between(0, 1).all() and rows["doc_id"].is_unique
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(rows[rows["held_out"]], on="doc_id")
    toxic, found = labels["toxic"] == 1, labels["predicted"] == 1
    # Some labels are wrong on purpose; words decide for most.
    assert (toxic & found).sum() / found.sum() > 0.9
    assert (toxic & found).sum() / toxic.sum() > 0.7


def test_only_learnable_labels_count(spark):
    docs = frame(spark, [(i, "fine day nice text" if i % 2 else "awful slur text") for i in range(100)])
    marks = spark.createDataFrame([(i, int(i % 2 == 0), None, "x") for i in range(50)], LABELS)
    model = toxicity.fit(docs, marks)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 0) for i in range(100))
    none = toxicity.fit(docs, marks, F.col("doc_id") >= 50)
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "slur"), (3, "slur"), (None, "slur"), (4, "fine " * 50000), (5, "slur " + "fine " * 9)]
    docs = frame(spark, rows)
    marks = [(3, 1, 0, "a"), (3, 0, 0, "b"), (3, None, 0, "c"), (4, 0, 1, "d"), (None, 1, 1, "e"), (77, 1, 1, "f")]
    marks = spark.createDataFrame(marks, LABELS)
    model = toxicity.fit(docs, marks)
    scored = toxicity.score(docs, model)
    assert scored.columns == docs.columns + ["score"] and scored.count() == len(rows)
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    empty = toxicity.score(frame(spark, []), toxicity.fit(frame(spark, []), marks.limit(0)))
    assert empty.collect() == []


def test_negative_risk_is_kept_from_below_zero():
    toxic = [np.array([1, 9], np.int32)] * 30
    plain = [np.array([2, 9], np.int32)] * 70 + toxic
    model = toxicity._train(toxic, plain, 0.3)
    f = [float(model.weights[x].sum() + model.bias) for x in (toxic[0], plain[0])]
    assert f[0] > 0 > f[1]
