"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives each document a probability for
every domain.  Documents get rates r >= 0 so that the expected tokens of each
domain, sum of r * tokens * probability, meet the target totals: nonnegative
least squares by projected gradient steps.  A step needs nothing but the totals
of the domains, which one distributed sum gives; the driver holds one number for
each domain and step.  As a rate follows from the probabilities and the steps,
it is recomputed where it is used instead of joined back.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, apart, small_batches

#: Bound of the labelled sample the classifier is fitted on, in documents of the lowest id hashes.
MAX_LABELLED = 4000
#: Words in fewer documents of the sample carry no weight.
MIN_DOCUMENTS = 5
ROUNDS = 120
STEP = 0.1
SHRINK = 1e-4
#: Gradient steps end when every domain is this close to its target, when they no longer
#: change the totals, or after so many.
TOLERANCE = 1e-3
MAX_PASSES = 60
#: Steps carried as an expression before the rates are written down.
CARRIED = 8


def features(text: str | None) -> set[str]:
    """The different words of the whole text, in lower case with what symbols stand by them."""
    return set((text or "").lower().split())


@dataclass(frozen=True)
class Classifier:
    """Softmax of the summed weights of known words, scaled by the root of their number."""

    domains: list[str]
    words: dict[str, int]
    weights: np.ndarray  # words x domains
    bias: np.ndarray

    def posteriors(self, text: str | None) -> np.ndarray:
        ids = sorted(self.words[w] for w in features(text) & self.words.keys())
        z = self.bias + self.weights[ids].sum(axis=0) / np.sqrt(max(1, len(ids)))
        e = np.exp(z - z.max())
        return e / e.sum()


def fit_classifier(docs: DataFrame, labelled: DataFrame) -> Classifier:
    """From ``docs`` (doc_id, text) and ``labelled`` (doc_id, domain).

    NULL ids and domains are no labels; of several labels of one document the
    smallest counts.  Without labels there is one domain, ``all``.
    """
    small_batches(docs.sparkSession)
    marked = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("_d"))
    known = docs.select("doc_id").where("doc_id is not null").distinct().join(marked, "doc_id")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)

    @F.arrow_udf("array<string>")
    def words(text: pa.Array) -> pa.Array:
        return pa.array([sorted(features(t.as_py())) for t in text], pa.list_(pa.string()))

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    got = rows.select("doc_id", "_d", words("text").alias("f")).dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    if not got.num_rows:
        return Classifier(["all"], {}, np.zeros((0, 1)), np.zeros(1))
    label = got.column("_d").to_pylist()
    domains = sorted(set(label))
    lists = got.column("f").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    seen = np.bincount(code, minlength=len(coded.dictionary))
    used = np.flatnonzero(seen >= min(MIN_DOCUMENTS, max(1, got.num_rows // 50)))
    place = np.full(len(seen), -1)
    place[used] = np.arange(len(used))
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))[:-1]
    short = [ids[ids >= 0] for ids in np.split(place[code], ends)]
    known = dict(zip(coded.dictionary.take(used).to_pylist(), range(len(used))))
    weights, bias = _softmax(short, np.searchsorted(domains, label), len(known), len(domains))
    return Classifier(domains, known, weights, bias)


def _softmax(rows: list[np.ndarray], label: np.ndarray, words: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial regression by Adam steps, with weights shrunk towards zero."""
    flat = np.concatenate([np.r_[f, words] for f in rows]).astype(np.int64)  # the last feature, in all rows, is the bias
    lengths = np.array([len(f) + 1 for f in rows])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    value = np.repeat(1 / np.sqrt(np.maximum(1, lengths - 1)), lengths)
    value[starts + lengths - 1] = 1
    truth = np.eye(count)[label]
    w, mean, square = (np.zeros((words + 1, count)) for _ in range(3))
    w[-1] = np.log(truth.mean(axis=0))
    for t in range(1, ROUNDS + 1):
        z = np.stack([np.add.reduceat(w[flat, c] * value, starts) for c in range(count)], axis=1)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        slope = (e / e.sum(axis=1, keepdims=True) - truth) / len(rows)
        g = np.stack([np.bincount(flat, np.repeat(slope[:, c], lengths) * value, words + 1) for c in range(count)], axis=1)
        g[:-1] += SHRINK * np.sign(w[:-1])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= STEP * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return w[:-1], w[-1]


@dataclass(frozen=True)
class Mixer:
    classifier: Classifier
    steps: np.ndarray  # passes x domains: what each pass took off the rate, by domain
    tokens: np.ndarray  # expected tokens of each domain before mixing
    targets: np.ndarray  # target tokens of each domain
    reached: np.ndarray  # expected tokens of each domain at the fitted rates
    at_least: float  # the smallest rate allowed
    rated: DataFrame  # doc_id, _n_tokens, _posteriors and _rate of every row that was fitted

    def rates(self, docs: DataFrame) -> DataFrame:
        """``docs`` with _n_tokens, _posteriors and _rate of every row."""
        return _scored(docs, self.classifier, self.steps, self.at_least)


def fit(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], whole: tuple[str, ...] = (),
        at_least: float = 0.0) -> Mixer:
    """Rates for ``docs`` that bring the domains of ``labelled`` to ``weights``.

    The targets add up to the tokens of the corpus; with ``whole``, to the least
    total at which none of those domains loses tokens.  Rates stay at ``at_least``
    (0 to 1) or more; where that rules a target out, the nearest totals are taken.  Weights of domains without
    a label, and domains without a weight, count as nothing.  NULL and empty texts
    have no tokens and the classifier's prior as probabilities.  Repeated rows
    count as often as they come.  Without tokens or weights every rate is 1.
    """
    classifier = fit_classifier(docs, labelled)
    d = len(classifier.domains)
    names = [f"p{k}" for k in range(d)]
    scored = _scored(docs.select("doc_id", "text"), classifier)
    flat = scored.select("doc_id", F.col("_n_tokens").alias("n"), *[F.get("_posteriors", F.lit(k)).alias(c) for k, c in enumerate(names)])
    state = Table(flat.withColumn("r", F.lit(1.0)), "mixing-rates")
    share = np.array([max(0.0, float(weights.get(name, 0))) for name in classifier.domains])
    tokens = _totals(state.frame, F.col("r"), names)
    if not tokens.sum() or not share.sum():
        rated = _rated(state.frame, names, F.col("r"))
        return Mixer(classifier, np.zeros((0, d)), tokens, tokens, tokens, at_least, rated)
    share /= share.sum()
    kept = [k for k, name in enumerate(classifier.domains) if name in whole and share[k] > 0]
    targets = share * (max(tokens[k] / share[k] for k in kept) if kept else tokens.sum())

    # In units of each domain's own tokens the second moments of the probabilities
    # have no eigenvalue above 1, so a step of 1 comes down at every pass.
    unit = np.maximum(tokens, tokens.sum() * 1e-9)
    reached, steps, carried = tokens, [], []
    slack = TOLERANCE * np.maximum(targets, tokens.sum() * TOLERANCE)
    moved, rate = slack, F.col("r")
    while len(steps) < MAX_PASSES and (np.abs(reached - targets) > slack).any() and (moved > slack / 20).any():
        steps.append((reached - targets) / unit)
        carried.append(steps[-1])
        rate = F.col("r")
        for step in carried:
            rate = F.greatest(F.lit(float(at_least)), rate - sum(F.col(c) * float(g) for c, g in zip(names, step)))
        if len(carried) == CARRIED:
            before, state = state, Table(state.frame.select("doc_id", "n", *names, rate.alias("r")), "mixing-rates")
            before.drop()
            carried, rate = [], F.col("r")
        last, reached = reached, _totals(state.frame, rate, names)
        moved = np.abs(reached - last)
    rated = _rated(state.frame, names, rate)
    return Mixer(classifier, np.array(steps).reshape(-1, d), tokens, targets, reached, at_least, rated)


def _rated(state: DataFrame, names: list[str], rate: Column) -> DataFrame:
    """The rows of a fit, from its table: no text is read again."""
    posteriors = F.array(*[F.col(c) for c in names]).alias("_posteriors")
    return state.select("doc_id", F.col("n").alias("_n_tokens"), posteriors, rate.alias("_rate"))


def _totals(state: DataFrame, rate: Column, names: list[str]) -> np.ndarray:
    """Expected tokens of each domain: one row to the driver."""
    parts = state.select(*names, (rate * F.col("n")).alias("_m"))
    row = parts.agg(*[F.sum(F.col("_m") * F.col(c)).alias(c) for c in names]).first()
    return np.array([float(x or 0) for x in row])


def _scored(docs: DataFrame, classifier: Classifier, steps: np.ndarray | None = None, least: float = 0.0) -> DataFrame:
    """``docs`` with _n_tokens (words) and _posteriors of every whole text; with ``steps`` also _rate.

    One function gives all, as each one more would hold one more Python worker a task.
    """
    small_batches(docs.sparkSession)
    taken = np.zeros((0, len(classifier.domains))) if steps is None else steps
    shared = docs.sparkSession.sparkContext.broadcast((classifier, taken))

    @F.arrow_udf("n bigint, p array<double>, r double")
    def membership(text: pa.Array) -> pa.Array:
        own, steps = shared.value
        n, p = [], np.zeros((len(text), len(own.domains)))
        for k, t in enumerate(text):
            words = t.as_py() or ""
            n.append(len(words.split()))
            p[k] = own.posteriors(words)
        rate = np.ones(len(p))
        for step in steps:
            rate = np.maximum(least, rate - p @ step)
        offsets = np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists, pa.array(rate)], ["n", "p", "r"])

    marked = docs.withColumn("_membership", membership(docs["text"]))
    return marked.select(
        *docs.columns,
        F.col("_membership.n").alias("_n_tokens"),
        F.col("_membership.p").alias("_posteriors"),
        *[F.col("_membership.r").alias("_rate")] * (steps is not None),
    )


@apart
def mixed(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """``docs``, each row as often as its rate says; all columns stay.

    A fraction of a rate becomes one more copy for that fraction of documents, by
    a hash of id and text, so that a repeated run gives the same rows.
    """
    rated = mixer.rates(docs)
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("mixing")), F.lit(1_000_000)) / 1e6
    copies = F.floor(F.round("_rate", 2) + chance).cast("int")
    rows = rated.withColumn("_copies", copies).where("_copies > 0")
    many = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return many.select(*docs.columns)
