"""Rates against a plain projected gradient, and the edges of the table."""

import numpy as np
import pytest

from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES, WEIGHTS, domains_of

from .conftest import frame

SF_DIR = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, domain string, text string"


def plain_rates(n, p, targets, at_least=0.0):
    """Every rate by itself, in full precision, until nothing moves."""
    r, unit = np.ones(len(n)), n @ p
    for _ in range(3000):
        r = np.maximum(at_least, r - p @ (((r * n) @ p - targets) / unit))
    return r


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    return docs, domains_of(docs, labels)


def test_totals_meet_targets(spark, tables):
    docs, labelled = tables
    mixer = mixing.fit(docs, labelled, WEIGHTS)
    order = ["doc_id", "_n_tokens", "_posteriors", "_rate"]
    again, held = (f.select(*order).orderBy(*order[:2]).toPandas() for f in (mixer.rates(docs), mixer.rated))
    assert (again[["doc_id", "_n_tokens"]] == held[["doc_id", "_n_tokens"]]).all(axis=None)
    assert np.allclose(np.stack(again._posteriors), np.stack(held._posteriors)) and np.allclose(again._rate, held._rate)
    got = mixer.rates(docs).select("doc_id", "_n_tokens", "_posteriors", "_rate").toPandas()
    n, p, r = got["_n_tokens"].to_numpy(float), np.stack(got["_posteriors"]), got["_rate"].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and (r >= 0).all()
    assert np.allclose((r * n) @ p, mixer.reached, rtol=1e-6)
    want = plain_rates(n, p, mixer.targets)
    assert np.allclose((r * n) @ p, (want * n) @ p, rtol=0.02)
    assert np.allclose(mixer.targets.sum(), n.sum())
    words = {d.doc_id: len((d.text or "").split()) for d in docs.collect()}
    assert dict(zip(got["doc_id"], got["_n_tokens"])) == words


def test_languages_are_told_apart(spark, tables):
    docs, labelled = tables
    rows = QUERIES["op1_mixing"](spark, SF_DIR).toPandas()
    assert len(rows) == docs.count()
    known = labelled.toPandas().merge(rows, on="doc_id", suffixes=("_given", ""))
    assert (known["domain"].str[:2] == known["domain_given"].str[:2]).mean() > 0.95


def test_rates_of_one_at_least_keep_every_row(spark, tables):
    docs, labelled = tables
    good = tuple(d for d in WEIGHTS if d.endswith("-good"))
    mixer = mixing.fit(docs, labelled, WEIGHTS, good, at_least=1.0)
    rows = mixing.mixed(docs, mixer)
    assert rows.columns == docs.columns
    assert rows.select("doc_id").distinct().count() == docs.count() < rows.count()


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "red blue"), (3, "red blue"), (None, "red"), (4, "green " * 40000), (5, "red red")]
    docs = frame(spark, rows)
    marks = [(3, "r", "x"), (3, None, "x"), (4, "g", "x"), (4, "h", "x"), (None, "r", "x"), (5, "r", "x"), (99, "z", "x")]
    marks = spark.createDataFrame(marks, LABELS)
    mixer = mixing.fit(docs, marks, {"r": 0.5, "g": 0.5, "unknown": 1})
    assert mixer.classifier.domains == ["g", "r"]
    assert mixer.rates(docs).count() == len(rows)
    assert set(r.doc_id for r in mixing.mixed(docs, mixer).collect()) <= {1, 2, 3, 4, 5, None}
    one = mixing.fit(docs, marks.limit(0), {"r": 1})
    assert {r._rate for r in one.rates(docs).collect()} == {1.0}
    empty = frame(spark, [])
    assert mixing.mixed(empty, mixing.fit(empty, marks, {"r": 1})).collect() == []
