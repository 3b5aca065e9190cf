"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, and every run of other characters than letters becomes one
space.  Four UTF-16 units make a 64-bit key, so keys never collide; characters
beyond the basic plane are two units.  Spark counts the keys of all training texts
by language, and the discounts and shortest grams from all of those.  The counts
become sorted arrays of keys with the smoothed probability under each language, so
one binary search gives a character's probability in all of them.

All that a probability is made of has the same last-but-one character: the grams of
two to four units and their contexts.  So a model of any size is cut by that
character into parts that each fit a worker, and texts are scored part by part.
The sums are those of the whole model.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, small_batches

UNDETERMINED = "und"
ORDER = 4
BITS = np.uint64(16)
OTHER = re.compile(r"[\W\d_]+")
#: Characters scored or counted at once.
SLICE = 1 << 18
#: Different keys that a task gathers before it passes counts on.
HELD = 1 << 20
#: Counted keys of a part of the model, and probabilities in its largest array, if the languages are many.
PART_KEYS = 1_200_000
PART_CELLS = 8_000_000
#: One in this many training documents sets the rejection limits, by a model that has not seen it.
CALIBRATION = 10
#: Share of them that a limit accepts, and what is added to it in nats a unit.
ACCEPTED = 0.995
SLACK = 0.25
#: Characters beyond which more text makes a score no surer.
SURE_CHARS = 100


def letters(text: str | None) -> str:
    """Words of letters with single spaces around them; empty if there is no letter."""
    plain = OTHER.sub(" ", (text or "").lower()).strip()
    return f" {plain} " if any(map(str.isalpha, plain)) else ""


def keys_of(words: str) -> np.ndarray:
    """The key of each unit after the first with the three before it; spaces stand before the text."""
    codes = np.frombuffer((" " * (ORDER - 2) + words).encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    key = codes[: len(codes) - ORDER + 1]
    for k in range(1, ORDER):
        key = (key << BITS) | codes[k : len(codes) - ORDER + 1 + k]
    return key


def count_keys(docs: DataFrame) -> DataFrame:
    """(lang, key, n) over every whole text of ``docs`` (lang, text)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                key, n = _summed(parts)
                columns = [pa.array([lang] * len(key)), pa.array(key.view(np.int64)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "key", "n"])
            held.clear()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.setdefault(lang, []).append(letters(text.as_py()))
            for lang, some in texts.items():
                for part in _groups(some):
                    keys = [keys_of(w) for w in part if w]
                    if keys:
                        held.setdefault(lang, []).append(np.unique(np.concatenate(keys), return_counts=True))
            for lang, parts in held.items():
                if len(parts) > 16:
                    held[lang] = [_summed(parts)]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from passed()
        yield from passed()

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about SLICE characters."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


@dataclass(frozen=True)
class Level:
    """One order of the models of all languages, in sorted keys."""

    grams: np.ndarray
    chance: np.ndarray  # grams x languages: smoothed probability of the last character
    contexts: np.ndarray
    backoff: np.ndarray  # contexts x languages: weight of the next shorter order


@dataclass(frozen=True)
class Whole:
    """What every part of a model needs to know of all counts."""

    discounts: np.ndarray  # orders, shortest first, x languages
    singles: list[tuple[np.ndarray, np.ndarray]]  # of each language: characters, and different ones before each


@dataclass(frozen=True)
class Model:
    """The models of all languages, for keys whose last-but-one character lies in a range."""

    languages: list[str]
    levels: list[Level]  # longest first
    rare: float  # probability of a character never seen
    low: int = 0
    high: int = 1 << 16

    def chances(self, key: np.ndarray, level: int = 0) -> np.ndarray:
        """keys x languages: probability of each key's last character after the others."""
        if level == len(self.levels):
            return np.full((len(key), len(self.languages)), self.rare)
        own = self.levels[level]
        at, known = _look_up(own.grams, key)
        out = own.chance[at]
        if not known.all():
            new = key[~known]
            ctx, seen = _look_up(own.contexts, new >> BITS)
            weight = np.where(seen[:, None], own.backoff[ctx], 1.0)
            shorter = np.uint64((1 << 16 * (ORDER - 1 - level)) - 1)
            out[~known] = weight * self.chances(new & shorter, level + 1)
        return out

    def sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """texts x languages: nats of the keys in this model's range; and the number of all keys of each text."""
        out = np.zeros((len(words), len(self.languages)))
        number = np.zeros(len(words), np.int64)
        at = 0
        for part in _groups(words):
            keys = [keys_of(w) if w else np.zeros(0, np.uint64) for w in part]
            sizes = np.array([len(k) for k in keys])
            flat, owner = np.concatenate(keys), np.repeat(np.arange(len(part)), sizes)
            number[at : at + len(part)] = sizes
            if self.low > 0 or self.high < 1 << 16:
                place = (flat >> BITS) & np.uint64(0xFFFF)
                inside = (place >= self.low) & (place < self.high)
                flat, owner = flat[inside], owner[inside]
            for low in range(0, len(flat), SLICE):  # a text may be longer than a slice
                logs = np.log(self.chances(flat[low : low + SLICE]))
                mine = owner[low : low + SLICE]
                starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                out[at + mine[starts]] -= np.add.reduceat(logs, starts, axis=0)
            at += len(part)
        return out, number

    def cross_entropies(self, words: list[str]) -> np.ndarray:
        """texts x languages: nats a unit; texts without letters give no number."""
        total, number = self.sums(words)
        return _per_unit(total, number)


def _per_unit(total: np.ndarray, number: np.ndarray) -> np.ndarray:
    return np.where(number[:, None] > 0, total / np.maximum(number, 1)[:, None], np.nan)


def _decided(
    languages: list[str], limits: np.ndarray, words: list[str], ce: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy and rejection of each text."""
    if not languages:
        return [UNDETERMINED] * len(words), np.zeros(len(words)), np.full(len(words), np.nan), np.ones(len(words), bool)
    none = np.isnan(ce[:, 0])
    ce[none] = 0
    best = ce.argmin(axis=1)
    least = ce[np.arange(len(ce)), best]
    length = np.minimum([len(w) for w in words], SURE_CHARS)
    score = 1 / np.exp(-(ce - least[:, None]) * length[:, None]).sum(axis=1)
    rejected = none | (least > limits[best])
    names = [UNDETERMINED if x else languages[b] for x, b in zip(none, best)]
    return names, np.where(none, 0.0, score), np.where(none, np.nan, least), rejected


def _look_up(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted array, and whether it is there."""
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


@dataclass(frozen=True)
class Fitted:
    """Counted keys of all languages in a table, the ranges of its parts, and the rejection limits."""

    languages: list[str]
    counts: Table
    whole: Whole
    ranges: list[tuple[int, int]]
    limits: np.ndarray  # highest accepted cross-entropy, by language

    def part(self, k: int) -> Model:
        """One part, of about PART_KEYS counted keys."""
        low, high = self.ranges[k]
        got = self.counts.frame.where((_last_but_one() >= low) & (_last_but_one() < high)).toArrow()
        of = np.asarray(got.column("lang").to_pylist(), object)
        key, n = got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy()
        return build(self.languages, [(key[of == x], n[of == x]) for x in self.languages], self.whole, low, high)


def _last_but_one() -> Column:
    """The last-but-one character of a counted key."""
    return F.shiftrightunsigned("key", 16).bitwiseAND(F.lit(0xFFFF))


def fit(docs: DataFrame, learn: Column | None = None) -> Fitted:
    """Model of all languages in ``docs`` (doc_id, text, lang) from every row with a text and a language.

    ``learn`` is a condition that training rows must meet.  Repeated rows count as
    often as they come.  Without such rows no language is known.

    The limits come from every tenth document, by the hash of its id, and a model of
    the others; a language without texts among them takes its limit from all its texts.
    """
    rows = docs.where("text is not null and lang is not null")
    rows = (rows if learn is None else rows.where(learn)).select("doc_id", "text", "lang")
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    some = Table(count_keys(rows.where(~apart)), "langid-counts")
    more = count_keys(rows.where(apart))
    every = Table(some.frame.union(more).groupBy("lang", "key").agg(F.sum("n").alias("n")), "langid-counts")
    fitted, others = _measured(every), _measured(some)
    limits = _limits(fitted, predict(rows.where(apart), others), np.full(len(fitted.languages), np.inf))
    bare = [x for x, limit in zip(fitted.languages, limits) if np.isinf(limit)]
    if bare:
        limits = _limits(fitted, predict(rows.where(F.col("lang").isin(bare)), fitted), limits)
    some.drop()
    return replace(fitted, limits=limits)


def _limits(fitted: Fitted, scored: DataFrame, known: np.ndarray) -> np.ndarray:
    """Limits of the languages that have none, from the cross-entropies of texts found to be theirs."""
    heard = scored.where("not isnan(cross_entropy)").groupBy("lang_pred")
    got = dict(heard.agg(F.percentile_approx("cross_entropy", ACCEPTED, 10000)).collect())  # a row a language
    return np.array([got.get(x, limit) + SLACK if np.isinf(limit) else limit for x, limit in zip(fitted.languages, known)])


def _measured(counts: Table) -> Fitted:
    """Languages, discounts, shortest grams and parts of a table of counts, worked out by Spark."""
    orders = [counts.frame]
    for k in range(ORDER - 1, 0, -1):
        # A shorter gram counts once for each different character before it.
        short = F.col("key").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("key")
        orders.append(orders[-1].groupBy("lang", short).agg(F.count(F.lit(1)).alias("n")))
    orders = orders[::-1]
    seen = [
        grams.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
        .withColumn("place", F.lit(k))
        for k, grams in enumerate(orders)
    ]
    rows = reduce(DataFrame.union, seen).collect()  # one row for each order and language
    languages = sorted({r["lang"] for r in rows})
    discounts = np.full((ORDER, len(languages)), 0.5)
    for r in rows:
        discounts[r["place"], languages.index(r["lang"])] = _discount(r["once"], r["twice"])
    single = orders[0].toArrow()  # at most 65,536 rows a language
    of = np.asarray(single.column("lang").to_pylist(), object)
    key, n = single.column("key").to_numpy().view(np.uint64), single.column("n").to_numpy()
    whole = Whole(discounts, [(key[of == x], n[of == x]) for x in languages])
    sizes = counts.frame.groupBy(_last_but_one().alias("place")).count().orderBy("place").collect()  # at most 65,536 rows
    most, held, cuts = min(PART_KEYS, PART_CELLS // max(1, len(languages))), 0, [0]
    for r in sizes:
        if held and held + r["count"] > most:
            cuts.append(r["place"])
            held = 0
        held += r["count"]
    ranges = list(zip(cuts, [*cuts[1:], 1 << 16]))
    return Fitted(languages, counts, whole, ranges, np.full(len(languages), np.inf))


def _discount(once: float, twice: float) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def build(
    languages: list[str],
    counts: list[tuple[np.ndarray, np.ndarray]],
    whole: Whole | None = None,
    low: int = 0,
    high: int = 1 << 16,
) -> Model:
    """Interpolated Kneser-Ney probabilities of all orders from counted keys of each language.

    Without ``whole`` the counts are all there are; with it they are those of a range.
    """
    tables = []  # of each language, shortest order first: (grams, counts)
    for key, n in counts:
        order = np.argsort(key)
        grams, seen = key[order], n[order].astype(float)
        mine = [(grams, seen)]
        for k in range(ORDER - 1, 0, -1):
            grams, places = np.unique(grams & np.uint64((1 << 16 * k) - 1), return_counts=True)
            mine.append((grams, places.astype(float)))
        tables.append(mine[::-1])
    if whole is None:
        found = [[_discount((n == 1).sum(), (n == 2).sum()) for _, n in mine] for mine in tables]
        whole = Whole(np.array(found).T, [mine[0] for mine in tables])
    for mine, (single, n) in zip(tables, whole.singles):
        order = np.argsort(single)
        mine[0] = (single[order], n[order].astype(float))
    characters = len(np.unique(np.concatenate([mine[0][0] for mine in tables]))) + 1
    model = Model(languages, [], 1 / characters, low, high)
    for k in range(ORDER):
        grams = np.unique(np.concatenate([mine[k][0] for mine in tables]))
        contexts = np.unique(grams >> BITS)
        chance = np.zeros((len(grams), len(languages)))
        backoff = np.ones((len(contexts), len(languages)))
        shorter = model.chances(grams & np.uint64((1 << 16 * k) - 1))
        context_of = np.searchsorted(contexts, grams >> BITS)
        for column, mine in enumerate(tables):
            own, seen = mine[k]
            discount = whole.discounts[k, column]
            at = np.searchsorted(contexts, own >> BITS)
            total = np.bincount(at, seen, len(contexts))
            kinds = np.bincount(at, minlength=len(contexts))
            known = total > 0
            backoff[known, column] = discount * kinds[known] / total[known]
            left = np.zeros(len(grams))
            left[np.searchsorted(grams, own)] = seen - discount
            chance[:, column] = left / np.where(known, total, 1)[context_of] + backoff[context_of, column] * shorter[:, column]
        model = replace(model, levels=[Level(grams, chance, contexts, backoff), *model.levels])
    return model


def predict(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of every whole text.

    lang_pred is the language of the lowest cross-entropy a unit, the first by
    name of equal ones; ``und`` if there is no letter, the text is NULL or no
    language is known.  score is its share among the languages.  rejected: the
    cross-entropy is above what texts of that language have, so it may be another.

    A model of several parts takes a pass over the texts for each; the sums go along
    with the texts, so nothing is joined.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    languages, limits = fitted.languages, fitted.limits
    done: Table | None = None
    for k in range(len(fitted.ranges)):
        last = k == len(fitted.ranges) - 1
        shared = spark.sparkContext.broadcast(fitted.part(k) if languages else None)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                words = [letters(t.as_py()) for t in batch.column(1)]
                total, number = own.sums(words) if own else (np.zeros((len(words), 1)), np.zeros(len(words)))
                if batch.num_columns > 2 and len(words):
                    total = total + np.array(batch.column(2).to_pylist())
                if last:
                    names, *numbers = _decided(languages, limits, words, _per_unit(total, number))
                    columns = [batch.column(0), pa.array(names, pa.string()), *map(pa.array, numbers)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])
                else:
                    sums = pa.array(list(total), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sums], ["doc_id", "text", "sums"])

        if last:
            schema = f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
            return rows.mapInArrow(run, schema)
        before, done = done, Table(rows.mapInArrow(run, f"doc_id {kind}, text string, sums array<double>"), "langid-sums")
        shared.unpersist()
        if before:
            before.drop()
        rows = done.frame
    raise AssertionError("a model has one part at least")
