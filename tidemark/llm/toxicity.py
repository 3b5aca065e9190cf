"""Toxicity by non-negative positive-unlabelled learning on bags of words.

Only confirmed toxic documents count as examples; everything else is a sample
of unlabelled text.  The risk of the unlabelled text as negatives is corrected
by the class prior, and kept from going below zero.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, small_batches

WORD = re.compile(r"\w+")
DIMENSIONS = 1 << 20
#: Bounds of the training sample, in documents; of larger tables the lowest id hashes.
MAX_TOXIC = 4000
MAX_UNLABELLED = 12000
#: Words in fewer documents of the sample carry no weight.
MIN_DOCUMENTS = 8
ROUNDS = 300
STEP = 0.05
SHRINK = 3e-4  # of all weights towards zero, so that words without evidence get none


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float


def features(text: str | None) -> np.ndarray:
    """Hashed ids of the different words of the whole text, in lower case."""
    words = set(WORD.findall((text or "").lower()))
    ids = np.fromiter((zlib.crc32(w.encode()) % DIMENSIONS for w in words), np.int32, len(words))
    return np.unique(ids)


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    ``learn`` is a condition on doc_id that training rows must meet.  The prior is
    the share of toxic ones among the labelled rows.  A document labelled more
    than once is toxic if one label says so; NULL labels and ids say nothing.
    Without a toxic or an unlabelled example every score is 0.
    """
    if learn is not None:
        docs, labels = docs.where(learn), labels.where(learn)
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).first()
    prior = float(counts["k"] or 0) / max(counts["n"], 1)
    toxic = _sample(docs, marked.where("toxic = 1").select("doc_id"), MAX_TOXIC)
    unlabelled = _sample(docs, docs.where("doc_id is not null").select("doc_id").distinct(), MAX_UNLABELLED)
    if not toxic or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(DIMENSIONS, np.float32), -np.inf, prior)
    return _train(toxic, unlabelled, prior)


def _sample(docs: DataFrame, ids: DataFrame, most: int) -> list[np.ndarray]:
    """Features of at most ``most`` documents, chosen by the hash of their ids."""
    small_batches(docs.sparkSession)
    order = F.xxhash64("doc_id")
    chosen = ids.select("doc_id").orderBy(order, "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")

    @F.arrow_udf("array<int>")
    def hashed(text: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in text], pa.list_(pa.int32()))

    got = rows.select("doc_id", hashed("text").alias("f")).toPandas()
    got = got.sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    return [np.asarray(f, np.int32) for f in got["f"]]


def _train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Adam steps on the non-negative risk of a linear model with logistic loss."""
    rows = toxic + unlabelled
    seen = np.bincount(np.concatenate(rows), minlength=DIMENSIONS)
    used = np.flatnonzero(seen >= min(MIN_DOCUMENTS, max(1, len(rows) // 50)))
    place = np.full(DIMENSIONS, -1, np.int32)
    place[used] = np.arange(len(used))
    rows = [place[f] for f in rows]
    rows = [f[f >= 0] for f in rows]
    flat = np.concatenate([np.r_[f, len(used)] for f in rows])  # the last feature, in all rows, is the bias
    lengths = np.array([len(f) + 1 for f in rows])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    positive = np.arange(len(rows)) < len(toxic)

    w = np.zeros(len(used) + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, ROUNDS + 1):
        f = np.add.reduceat(w[flat], starts)
        p = 1 / (1 + np.exp(-f))
        as_toxic = np.where(positive, prior * (p - 1) / len(toxic), 0)
        as_clean = np.where(positive, -prior * p / len(toxic), p / len(unlabelled))
        loss = np.logaddexp(0, f)
        negative_risk = loss[~positive].mean() - prior * loss[positive].mean()
        slope = as_toxic + as_clean if negative_risk >= 0 else -as_clean
        g = np.bincount(flat, np.repeat(slope, lengths), len(w))
        g[:-1] += SHRINK * np.sign(w[:-1])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= STEP * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]), prior)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic, from the whole text of each row.

    NULL and empty texts have no words and get the score of the bias alone.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def toxic(text: pa.Array) -> pa.Array:
        weights, bias = shared.value
        sums = np.array([weights[features(t.as_py())].sum(dtype=np.float64) for t in text])
        with np.errstate(over="ignore"):
            return pa.array(1 / (1 + np.exp(-(sums + bias))), pa.float64())

    return docs.withColumn(name, toxic(docs["text"]))


@apart
def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored as toxic; all columns stay."""
    scored = score(docs, fit(docs, labels), "_toxic_score")
    return scored.where(F.col("_toxic_score") < threshold).drop("_toxic_score")
