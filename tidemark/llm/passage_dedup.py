"""Repeated passages: paragraphs by MinHash banding, exact Jaccard, removal by components.

A paragraph is a line of at least MIN_WORDS words.  Passages also repeat inside
longer lines and over shorter ones, so each text has sub-paragraphs too, whatever
its line ends: runs of MIN_WORDS words whose hash is the lowest of some WINDOW runs
in a row, and the stretches from each of them to the end of the next.  Two texts
that share MIN_WORDS + WINDOW - 1 words in a row have a run of them in common, and
all stretches between the first and the last such run; fewer than WINDOW words are
left on either side, and those are compared word by word.

Lines are compared by MinHash: rows of a signature are banded for high recall,
colliding lines are joined, and five-word shingles give the exact Jaccard
similarity.  A sub-paragraph has too few shingles for one to differ at 0.8 or
more and has a single band of its whole word sequence.  Classes are components
of what matches; of a class the first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_BYTES, SPACES, Table, apart, small_batches
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
MIN_WORDS = 16
#: Runs in a row of which the lowest is a place, so that passages of 37 words or more have one.
WINDOW = 22
#: 6 bands of 2 rows find a pair of similarity 0.8 with probability 0.998.
BANDS, ROWS = 6, 2
SEED = 42  # as in Spark's xxhash64
HASH_BYTES = 24
#: Of a document's id and text hash, and of a class with its first place, broadcast likewise.
DOC_BYTES, FIRST_BYTES = 32, 64
#: Parts in which a table may be broadcast where it is too large for one; the rows are read once for each.
PARTS = 8
#: Words of texts that are hashed at once, or one text.
HELD_WORDS = 1 << 15
#: Of a pair of places that is broadcast.
PLACES_BYTES = 160
#: Contexts whose hashes a task knows it has given; beyond that it gives them again.
HELD_CONTEXTS = 200_000
#: Contexts of a run and side that are compared in one row; of more, each hash is a row.
GROUP_CONTEXTS = 64

_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return tuple(rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words, by its first."""
    out = np.zeros(max(0, len(words) - length + 1), np.uint64)
    for k in range(length):
        out = _mixed(out + words[k : k + len(out)])
    return out


def units(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """uid, first word, number of words and bands of every paragraph and sub-paragraph of a whole text.

    Bands are 0 for sub-paragraphs.
    """
    return _units([_split(text)])[1:]


def _split(text: str | None) -> tuple[list[bytes], list[list[bytes]]]:
    """Lines of a text and the words of each."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    return lines, [line.split() for line in lines]


def _units(texts: list[tuple[list[bytes], list[list[bytes]]]]) -> tuple[np.ndarray, ...]:
    """Which of the texts, and ``units`` of it, in the order of texts: their words stand one after the other, apart."""
    digest = xxhash.xxh64_intdigest
    size = np.array([sum(map(len, split)) for _, split in texts], np.int64)
    base = np.cumsum(size + WINDOW) - size - WINDOW
    words = np.zeros(int((size + WINDOW).sum()), np.uint64)
    whole, first, sizes, of = [], [], [], []
    for k, (lines, split) in enumerate(texts):
        if size[k] < MIN_WORDS:
            continue
        words[base[k] : base[k] + size[k]] = np.fromiter(map(digest, chain.from_iterable(split)), np.uint64, int(size[k]))
        counts = np.array([len(w) for w in split])
        long = np.flatnonzero(counts >= MIN_WORDS)
        whole += [digest(lines[i], SEED) for i in long]
        first.append((np.cumsum(counts) - counts)[long] + base[k])
        sizes.append(counts[long])
        of.append(np.full(len(long), k))
    if not of:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none, np.zeros((0, BANDS), np.uint64)
    first, sizes, of = (np.concatenate(part) for part in (first, sizes, of))

    powers = _powers(len(words))
    sums = np.r_[np.uint64(0), np.cumsum(words * powers[0][: len(words)], dtype=np.uint64)]

    def hashed(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[begin]) * powers[1][begin]) ^ _mixed((end - begin).astype(np.uint64))

    places = _places(words, hashed, base, size - MIN_WORDS + 1)
    text = np.searchsorted(base, places, "right") - 1
    next_to = np.flatnonzero(text[:-1] == text[1:])
    begin = np.r_[places, places[next_to]]
    end = np.r_[places, places[next_to + 1]] + MIN_WORDS
    bands = np.r_[_bands(words, first, sizes), np.zeros((len(begin), BANDS), np.uint64)]
    uid = np.r_[np.array(whole, np.uint64), hashed(begin, end)]
    of = np.r_[of, text, text[next_to]]
    order = np.argsort(of, kind="stable")
    of = of[order]
    return of, uid[order], np.r_[first, begin][order] - base[of], np.r_[sizes, end - begin][order], bands[order]


def _places(words: np.ndarray, hashed: Callable, base: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places whose run has the lowest hash of WINDOW in a row, or of all ``counts`` of a text if they are fewer."""
    runs = np.zeros(len(words) + 1, np.int64)
    long = counts > 0
    runs[base[long]] += 1
    runs[(base + counts)[long]] -= 1
    runs = np.flatnonzero(np.cumsum(runs))
    low = np.full(len(words) + WINDOW, np.iinfo(np.uint64).max)
    low[runs] = hashed(runs, runs + MIN_WORDS)
    starts = np.zeros(len(words) + 1, np.int64)
    starts[base[long]] += 1
    starts[(base + np.maximum(counts - WINDOW + 1, 1))[long]] -= 1
    lowest = np.where(np.cumsum(starts)[:-1] > 0, _sliding(np.minimum, low, WINDOW)[: len(words)], 0)
    highest = _sliding(np.maximum, np.r_[np.zeros(WINDOW - 1, np.uint64), lowest], WINDOW)
    return runs[highest[runs] == low[runs]]


def _sliding(choose: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """``choose`` of each ``window`` values in a row."""
    size = 1
    while 2 * size <= window:
        values = choose(values[:-size], values[size:])
        size *= 2
    rest = window - size
    return choose(values[: len(values) - rest], values[rest:])


def _bands(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Band hashes of the lines that begin at words ``first``."""
    if not len(first):
        return np.zeros((0, BANDS), np.uint64)
    shingles = _runs(words, SHINGLE_WORDS)
    spans = np.stack([first, first + sizes - SHINGLE_WORDS + 1], axis=1).ravel()
    spans[-1] = min(spans[-1], len(shingles))
    cut = spans if spans[-1] < len(shingles) else spans[:-1]
    a, b = _multipliers()
    signature = np.stack([np.minimum.reduceat(_mixed(shingles * x + y), cut)[::2] for x, y in zip(a, b)], axis=1)
    bands = np.zeros((len(first), BANDS), np.uint64)
    for row in range(ROWS):
        bands = _mixed(bands + signature[:, row::ROWS])
    return _mixed(bands + np.arange(BANDS, dtype=np.uint64))


_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 to the 64."""
    if not _POWERS or len(_POWERS[0]) <= size:
        base = 0x5851F42D4C957F2D
        length = 1 << max(16, int(size).bit_length())
        _POWERS[:] = [
            np.cumprod(np.r_[np.uint64(1), np.full(length, x, np.uint64)], dtype=np.uint64)
            for x in (base, pow(base, -1, 1 << 64))
        ]
    return _POWERS[0], _POWERS[1]


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, uid, start, n, bands) of every unit of every whole text; bands only for lines."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.xxhash64("text").alias("_key"), "text").where("text is not null")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "_key", "uid", "start", "n", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held, words = [], [], 0
            for row in range(batch.num_rows):
                held.append(_split(batch.column(2)[row].as_py()))
                words += sum(map(len, held[-1][1]))
                if words >= HELD_WORDS or row + 1 == batch.num_rows:
                    of, *rest = _units(held)
                    found.append((of + row + 1 - len(held), *rest))
                    held, words = [], 0
            of, uid, start, n, bands = (np.concatenate(part) for part in zip(*found))
            if not len(of):
                continue
            of, full = pa.array(of), bands.any(axis=1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(np.where(full, BANDS, 0))], pa.int32()), pa.array(bands[full].view(np.int64).ravel())
            )
            columns = [batch.column(0).take(of), batch.column(1).take(of), pa.array(uid.view(np.int64)),
                       pa.array(start, pa.int64()), pa.array(n, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, f"doc_id {kind}, _key bigint, uid bigint, start bigint, n bigint, bands array<bigint>")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, spans, kept_in) of the documents that repeat a passage, _key being the text's hash.

    spans are the first word and number of words of what is to go, merged where
    they meet; kept_in has the ids of the documents where its first occurrence
    stays (its own id if a document repeats itself; NULL ids are not listed).  First is by doc_id, text
    hash and place; NULL ids come first.  NULL, empty and short texts have no
    paragraphs.  Rows that repeat both id and text are one document.  An empty
    table gives an empty result.
    """
    units = Table(occurrences(docs), "passage-units")
    every = units.frame
    lines = every.where(F.size("bands") > 0)
    near = Table(_near_lines(docs, lines).withColumnRenamed("node", "uid"), "passage-near")
    twice = every.groupBy("uid").count().where("count > 1").select("uid")
    seen = Table(twice.union(near.frame.select("uid")).distinct(), "passage-repeated")
    columns = ["uid", "doc_id", "_key", "start", "n", (F.size("bands") > 0).alias("line")]
    parts = (part.select(*columns) for part in _joined(every, seen, "uid", HASH_BYTES, "left_semi"))
    places, some = _written(parts, "passage-occurrences")
    _free(docs, units, seen)
    classes = some.join(near.hinted(HASH_BYTES), "uid", "left")
    classes = classes.select(F.coalesce("root", "uid").alias("class"), *some.columns)
    first = Table(classes.groupBy("class").agg(F.min(_place()).alias("_first")), "passage-first")
    moved = ~_place().eqNullSafe(F.col("_first"))
    parts = (part.where(moved).select(*some.columns, "_first") for part in _joined(classes, first, "class", FIRST_BYTES))
    _, later = _written(parts, "passage-later")
    _free(docs, first, near)
    more = _extensions(docs, some, later)
    _free(docs, *places)
    spans = later.select("doc_id", "_key", "start", "n", "_first").union(more)
    stays = _staying(spans, _passed(spans))
    found = spans.join(stays, F.col("_first").eqNullSafe(F.col("_was"))).groupBy("doc_id", "_key").agg(
        F.collect_list(F.struct("start", "n")).alias("spans"), F.array_sort(F.collect_set("_stays")).alias("kept_in")
    )
    return found.mapInArrow(_with_merged_spans, found.schema)


def _free(docs: DataFrame, *tables: Table) -> None:
    """Delete tables whose readers are written, and the shuffle files of jobs that are done.

    Spark deletes shuffle files once the driver's memory manager finds that nothing
    refers to them, which may take half an hour; asking for it keeps the disk to what
    is still read.
    """
    for table in tables:
        table.drop()
    docs.sparkSession._jvm.System.gc()


def _joined(rows: DataFrame, table: Table, key: str, bytes_per_row: int, how: str = "inner") -> Iterator[DataFrame]:
    """``rows`` joined with a table by ``key``, in parts that need no shuffle of the rows if a few broadcasts hold the table."""
    parts = -(-table.rows * bytes_per_row // BROADCAST_BYTES)
    if not 1 < parts <= PARTS:
        yield rows.join(table.hinted(bytes_per_row), key, how)
        return
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    for k in range(parts):
        yield rows.where(part == k).join(F.broadcast(table.frame.where(part == k)), key, how)


def _written(parts: Iterator[DataFrame], purpose: str) -> tuple[list[Table], DataFrame]:
    """Tables of the parts, and all their rows; one after the other, so that the driver holds one broadcast at a time."""
    tables = []
    for part in parts:
        tables.append(Table(part, purpose))
        _free(part)
    spark, schema = tables[0].spark, tables[0].frame.schema
    return tables, spark.read.schema(schema).parquet(*[table.path for table in tables])


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_of"))


def _passed(spans: DataFrame) -> DataFrame:
    """The spans of documents where something of ``spans`` was first: no other can be met on the way there."""
    firsts = spans.select(F.col("_first.doc_id").alias("_id"), F.col("_first._key").alias("_of")).distinct()
    firsts = Table(firsts, "passage-first-documents")
    met = Table(spans.join(firsts.hinted(DOC_BYTES), _same_document(), "left_semi"), "passage-passed")
    _free(spans, firsts)
    return met.frame


def _staying(spans: DataFrame, passed: DataFrame | None = None) -> DataFrame:
    """(_was, _stays): for each _first of ``spans`` the document where its words stay.

    A place chosen in one text need not be one in an earlier text with the same
    words, so a first place may lie in words that go; it is followed to where those
    were first.  Every step leads to an earlier place, and only places that moved
    take another.  ``passed`` has all spans that steps may meet, if not all are given.
    """
    passed = spans if passed is None else passed
    places = spans.select(F.col("_first").alias("_was")).distinct()
    now = Table(places.select("_was", F.col("_was").alias("_now")), "passage-staying")
    moving, steps = now.hinted(PLACES_BYTES), []
    here = F.col("_now.start") - F.col("start")
    met = (F.col("doc_id").eqNullSafe(F.col("_now.doc_id")) & (F.col("_key") == F.col("_now._key"))
           & (here >= 0) & (here < F.col("n")))
    to = F.struct("_first.doc_id", "_first._key", (F.col("_first.start") + here).alias("start"))
    while True:
        found = moving.join(passed, met).select("_was", "_now", to.alias("_to"))
        found = found.unionByName(moving.select("_was", "_now"), allowMissingColumns=True)
        found = found.groupBy("_was", "_now").agg(F.min("_to").alias("_to"))
        seen = F.col("_to").isNotNull()
        after = Table(found.select("_was", F.coalesce("_to", "_now").alias("_now"), seen.alias("_seen")),
                      "passage-staying", _moved=F.count_if("_seen"))
        if not steps:
            now.drop()
        steps.append(after.path)
        moved = after.totals.get("_moved") or 0
        if not moved:
            ended = spans.sparkSession.read.schema(after.frame.schema).parquet(*steps).where("not _seen")
            return ended.select("_was", F.col("_now.doc_id").alias("_stays"))
        moving = after.frame.where("_seen").select("_was", "_now")
        if moved * PLACES_BYTES <= BROADCAST_BYTES:
            moving = F.broadcast(moving)


def _place() -> Column:
    return F.struct("doc_id", "_key", "start")


def _extensions(docs: DataFrame, some: DataFrame, later: DataFrame) -> DataFrame:
    """(doc_id, _key, start, n, _first): words before and after runs that repeat with them.

    Only runs at the edges of what runs and stretches cover have such words.  The
    words beside a run, outwards, are its context.  Places with the same context are
    one from then on, so copies cost as much as one text; contexts that begin alike
    have the hash of what they have in common.  Of each hash the first place
    stays, so the longest of any earlier text counts and no pairs of texts are made.
    """
    inner = later.where("not line").groupBy("doc_id", "_key")
    edges = _edges(inner.agg(F.collect_list(F.struct("uid", "start", "n")).alias("_units")))
    edges = Table(edges, "passage-edges")
    wanted = Table(edges.frame.select("uid", "side").distinct(), "passage-edge-runs")
    ask = some.where(~F.col("line") & (F.col("n") == MIN_WORDS)).join(wanted.hinted(HASH_BYTES), "uid")
    ask = ask.withColumn("edge", F.lit(False)).unionByName(edges.frame.withColumn("edge", F.lit(True)), allowMissingColumns=True)
    ask = ask.groupBy("doc_id", "_key").agg(
        F.collect_set(F.struct("uid", "start", "side")).alias("_asked"),
        F.collect_set(F.when(F.col("edge"), F.struct("start", "side"))).alias("_edges"),
    )
    ask = Table(ask.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_of"), "_asked", "_edges"), "passage-asked")
    texts = docs.select("doc_id", F.xxhash64("text").alias("_key"), "text")
    if ask.small(DOC_BYTES):  # texts that nothing is asked of need no shuffle
        texts = texts.join(F.broadcast(ask.frame.select("_id", "_of")), _same_document(), "left_semi")
    texts = texts.join(ask.frame, _same_document())
    outward = Table(_outward(texts.select("doc_id", "_key", "text", "_asked", "_edges")), "passage-outward")
    _free(docs, edges, wanted, ask)

    of = ["uid", "side", "context"]
    contexts = outward.frame.groupBy(*of).agg(F.min(_place()).alias("_first"), F.max("hashes").alias("_hashes"))
    contexts = Table(contexts, "passage-contexts")
    _free(docs)
    sizes = contexts.frame.groupBy("uid", "side").agg(F.count(F.lit(1)).alias("_of"))
    crowds = Table(sizes.where(F.col("_of") > GROUP_CONTEXTS).select("uid", "side"), "passage-crowds")
    reached = _compared(contexts.frame.join(crowds.hinted(HASH_BYTES), ["uid", "side"], "left_anti"))
    if crowds.rows:
        crowded = contexts.frame.join(crowds.hinted(HASH_BYTES), ["uid", "side"], "left_semi")
        reached = reached.unionByName(_dealt(crowded))
    whole = F.when(F.col("_words") == F.col("_n"), F.col("_least")).otherwise(F.col("_first"))
    reached = reached.withColumn("_whole", whole)
    # A place that is not the first of its context repeats all of it.
    here = outward.frame.where("edge").drop("hashes").join(reached, of)
    whole = ~_place().eqNullSafe(F.col("_first"))
    words = F.when(whole, F.col("_n")).otherwise(F.col("_words"))
    first = F.when(whole, F.col("_whole")).otherwise(F.col("_least"))
    longest = here.select("doc_id", "_key", "start", "side", words.cast("bigint").alias("n"), first.alias("_first"))
    begin = F.when(F.col("side") < 0, F.col("start") - F.col("n")).otherwise(F.col("start") + MIN_WORDS)
    more = longest.where("n is not null").select("doc_id", "_key", begin.alias("start"), "n", "_first")
    more = Table(more, "passage-extensions")
    _free(docs, outward, contexts, crowds)
    return more.frame


def _compared(contexts: DataFrame) -> DataFrame:
    """(uid, side, context, _first, _n, _words, _least) of contexts, few for each run and side.

    _words is how many words a context has in common with an earlier one, at most,
    and _least the first place of these; both are NULL if there are none.
    """
    kind = contexts.schema["_first"].dataType["doc_id"].dataType.simpleString()
    place = f"struct<doc_id:{kind},_key:bigint,start:bigint>"
    names = ["uid", "side", "context", "_first", "_n", "_words", "_least"]
    steps = np.arange(WINDOW - 1)
    groups = contexts.groupBy("uid", "side").agg(
        F.array_sort(F.collect_list(F.struct("_first", "context", "_hashes"))).alias("_group")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column(2)
            rows = group.flatten()
            first, lists = rows.field("_first"), rows.field("_hashes")
            of = np.repeat(np.arange(batch.num_rows), group.value_lengths().to_numpy())
            sizes = lists.value_lengths().to_numpy()
            hashes = _begun(lists)
            words, least = np.zeros(len(of), np.int32), np.zeros(len(of), np.int64)
            for k in steps:
                at = np.flatnonzero(sizes > k)
                at = at[np.lexsort((hashes[at, k], of[at]))]  # stable, so earlier ones stay first
                new = np.r_[True, (np.diff(of[at]) != 0) | (np.diff(hashes[at, k]) != 0)][: len(at)]
                leading = at[new][np.cumsum(new) - 1]
                later = leading != at
                words[at[later]], least[at[later]] = k + 1, leading[later]
            of, none = pa.array(of), words == 0
            columns = [batch.column(0).take(of), batch.column(1).take(of), rows.field("context"), first,
                       pa.array(sizes, pa.int32()), pa.array(words, mask=none), first.take(pa.array(least, mask=none))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return groups.mapInArrow(
        run, f"uid bigint, side int, context bigint, _first {place}, _n int, _words int, _least {place}"
    )


def _begun(lists: pa.ListArray) -> np.ndarray:
    """Hashes of the first word, the first two, ... of lists of word hashes, a row each."""
    steps = np.arange(WINDOW - 1)
    hashes = np.zeros((len(lists), len(steps)), np.int64)
    hashes[steps < lists.value_lengths().to_numpy()[:, None]] = lists.flatten().to_numpy()
    words, value = hashes.view(np.uint64), np.zeros(len(lists), np.uint64)
    for k in steps:
        words[:, k] = value = _mixed(value + words[:, k])
    return hashes


def _dealt(contexts: DataFrame) -> DataFrame:
    """What ``_compared`` gives, for any number of contexts for a run and side: each hash is a row."""
    of, node = ["uid", "side", "context"], ["uid", "side", "k", "hash"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            inside = np.arange(WINDOW - 1) < lists.value_lengths().to_numpy()[:, None]
            begun = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(inside.sum(axis=1))], pa.int32()), pa.array(_begun(lists)[inside])
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], begun], batch.schema.names)

    chosen = contexts.select(*of, "_first", "_hashes")
    begun = chosen.mapInArrow(run, chosen.schema).select(*of, "_first", F.posexplode("_hashes").alias("k", "hash"))
    # A place has one context, so the first place and its context are one choice.
    least = F.min(F.struct("_first", "context")).alias("_least")
    shared = begun.groupBy(*node).agg(least, F.count(F.lit(1)).alias("_of")).where("_of > 1").drop("_of")
    met = begun.drop("_first").join(shared, node).where(F.col("_least.context") != F.col("context"))
    longest = F.max(F.struct((F.col("k") + 1).alias("words"), F.col("_least._first").alias("least")))
    met = met.groupBy(*of).agg(longest.alias("_longest"))
    return contexts.join(met, of, "left").select(
        *of, "_first", F.size("_hashes").alias("_n"), F.col("_longest.words").alias("_words"), F.col("_longest.least").alias("_least")
    )


def _outward(texts: DataFrame) -> DataFrame:
    """(uid, doc_id, _key, start, side, context, edge, hashes) of the words next to places asked for.

    hashes are those of up to WINDOW - 1 words outwards, one by one, and context
    stands for all of them.  Of the places in a batch with the same context the
    first is given, and those at edges.  A task gives hashes with the first places
    of a context, and NULL with most others.  Places at the end of a text have no
    such words and are left out.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["uid", "doc_id", "_key", "start", "side", "context", "edge", "hashes"]
    steps = np.arange(WINDOW - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        given: set[int] = set()
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                split = batch.column(2)[row].as_py().encode("utf-8", "surrogatepass").split()
                words = np.fromiter(map(digest, split), np.uint64, len(split))
                asked, edges = (batch.column(c).slice(row, 1).flatten() for c in (3, 4))
                uid, start, side = (asked.field(f).to_numpy() for f in ("uid", "start", "side"))
                at = np.where(side < 0, start - 1, start + MIN_WORDS)[:, None] + side[:, None] * steps
                counts = ((at >= 0) & (at < len(words))).sum(axis=1)
                some = counts > 0
                edge = np.isin(2 * start + (side > 0), 2 * edges.field("start").to_numpy() + (edges.field("side").to_numpy() > 0))
                beside = words[np.clip(at[some], 0, len(words) - 1)]
                found.append((np.full(len(beside), row), uid[some], start[some], side[some], counts[some], edge[some], beside))
            if not found:
                continue
            of, uid, start, side, counts, edge, beside = (np.concatenate(part) for part in zip(*found))
            hashes, value = np.zeros_like(beside), np.zeros(len(beside), np.uint64)
            for k in steps:
                hashes[:, k] = value = _mixed(value + beside[:, k])
            context = _mixed(hashes[np.arange(len(of)), counts - 1] + counts.astype(np.uint64))
            marks = _mixed(context ^ uid.view(np.uint64)) + (side > 0).astype(np.uint64)
            rank = np.zeros(batch.num_rows, np.int64)
            ids = pa.table({"id": batch.column(0), "key": batch.column(1)})
            order = pc.sort_indices(ids, sort_keys=[("id", "ascending"), ("key", "ascending")], null_placement="at_start")
            rank[order.to_numpy()] = np.arange(len(rank))
            order = np.lexsort((start, rank[of], marks))
            new = np.zeros(len(of), bool)
            new[order[np.r_[True, np.diff(marks[order]) != 0][: len(order)]]] = True
            given_here = np.flatnonzero(new | edge)
            of, uid, start, side, counts, edge, beside, context, marks, new = (
                part[given_here] for part in (of, uid, start, side, counts, edge, beside, context, marks, new)
            )
            for place in np.flatnonzero(new).tolist():
                mark = int(marks[place])
                new[place] = mark not in given
                given.add(mark)
            if len(given) > HELD_CONTEXTS:
                given.clear()
            sizes = np.where(new, counts, 0)
            inside = steps < sizes[:, None]
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[~new, False])
            lists = pa.ListArray.from_arrays(offsets, pa.array(beside[inside].view(np.int64)))
            of = pa.array(of)
            columns = [pa.array(uid), batch.column(0).take(of), batch.column(1).take(of), pa.array(start),
                       pa.array(side), pa.array(context.view(np.int64)), pa.array(edge), lists]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(
        run,
        f"uid bigint, doc_id {kind}, _key bigint, start bigint, side int, context bigint, edge boolean, hashes array<bigint>",
    )


def _merged(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of spans in order, those of a row that overlap or touch made one."""
    of = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
    start, n = (spans.flatten().field(f).to_numpy() for f in ("start", "n"))
    order = np.lexsort((start, of))
    order = order[n[order] > 0]
    of, start, end = of[order], start[order], (start + n)[order]
    apart = of * (end.max(initial=0) + 1)  # rows never meet
    reached = np.maximum.accumulate(end + apart)
    first = np.flatnonzero(np.r_[True, (start + apart)[1:] > reached[:-1]][: len(of)])
    last = np.r_[first[1:], len(of)] - 1
    return of[first], start[first], (reached - apart)[last]


def _with_merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        of, start, end = _merged(batch.column("spans"))
        merged = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start)], ["start", "n"])
        offsets = np.searchsorted(of, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), merged)
        columns = [lists if name == "spans" else batch.column(name) for name in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _edges(repeated: DataFrame) -> DataFrame:
    """(uid, doc_id, _key, start, side) of the runs at the edges of what a document's _units cover."""
    kind = repeated.schema["doc_id"].dataType.simpleString()
    names = ["uid", "doc_id", "_key", "start", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2)
            uid, start, n = (units.flatten().field(f).to_numpy() for f in ("uid", "start", "n"))
            row = np.repeat(np.arange(len(units)), units.value_lengths().to_numpy())
            of, begin, end = _merged(units)
            apart = end.max(initial=0) + 1
            first = np.isin(start + row * apart, begin + of * apart) & (n == MIN_WORDS)
            last = np.isin(start + n + row * apart, end + of * apart) & (n == MIN_WORDS)
            at = np.r_[np.flatnonzero(first), np.flatnonzero(last)]
            side = np.repeat(np.array([-1, 1], np.int32), [first.sum(), last.sum()])
            docs = pa.array(row[at])
            columns = [pa.array(uid[at]), batch.column(0).take(docs), batch.column(1).take(docs), pa.array(start[at]), pa.array(side)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return repeated.mapInArrow(run, f"uid bigint, doc_id {kind}, _key bigint, start bigint, side int")


def _near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(node, root) of different lines that are similar, directly or through others."""
    unique = lines.groupBy("uid").agg(F.first("bands").alias("bands"))
    banded = unique.select("uid", F.explode("bands").alias("band"))
    crowd = banded.groupBy("band").agg(F.count(F.lit(1)).alias("_n"), F.min("uid").alias("pivot")).where("_n > 1")
    crowd = Table(crowd.select("band", "pivot"), "passage-bands")
    banding = Table(banded.join(crowd.hinted(HASH_BYTES), "band"), "passage-members")
    members = banding.frame
    shingled = Table(_texts(docs, members.select("uid").distinct()), "passage-lines")
    texts = shingled.frame
    _free(docs, crowd)

    sketches = texts.select("uid", *SKETCH)

    # Every line is compared with the first of its band.  What then is in one
    # component needs no more comparing; the rest is compared across components.
    stars = members.where("uid <> pivot").select(F.col("pivot").alias("a"), F.col("uid").alias("b")).distinct()
    stars = stars.join(_named(sketches, "a"), "a").join(_named(sketches, "b"), "b").where(_may_be_similar())
    links = Table(_verified(stars.select("a", "b"), texts), "passage-links")
    linked = links.frame
    _free(docs)
    roots = Table(connected_components(linked), "passage-roots").frame
    placed = members.join(roots, members["uid"] == roots["node"], "left").select(
        "band", "uid", F.coalesce("root", "uid").alias("root")
    )
    mixed = placed.groupBy("band").agg(F.min("root").alias("_l"), F.max("root").alias("_h")).where("_l <> _h")
    open_bands = Table(mixed.select("band"), "passage-open")
    rest = placed.join(open_bands.hinted(HASH_BYTES), "band", "left_semi").join(sketches, "uid")
    open_lines = Table(rest, "passage-rest")
    rest = open_lines.frame
    left = _named(rest, "a").withColumnRenamed("root", "_r")
    right = _named(rest, "b").withColumnRenamed("root", "_s")
    across = (left["band"] == right["band"]) & (F.col("_r") < F.col("_s")) & _may_be_similar()
    pairs = left.join(right, across).select("a", "b").distinct()
    near = connected_components(linked.union(_verified(pairs, texts)))
    _free(docs, banding, shingled, links, open_bands, open_lines)
    return near


#: Number of shingles, and the parity of how many fall on each of 256 places.
SKETCH = ["n", "p0", "p1", "p2", "p3"]


def _named(sketches: DataFrame, side: str) -> DataFrame:
    """Sketch columns with the side of a pair they stand on."""
    others = [c for c in sketches.columns if c not in ("uid", *SKETCH)]
    return sketches.select(F.col("uid").alias(side), *others, *[F.col(c).alias(f"{c}_{side}") for c in SKETCH])


def _may_be_similar() -> Column:
    """False only for pairs that can't reach SIMILARITY.

    Places with different parity hold at least one shingle that only one line has,
    so there are no more of them than such shingles; and a similarity of s allows
    (1 - s) / (1 + s) of both sizes together.
    """
    apart = sum(F.bit_count(F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b"))) for k in range(4))
    return apart * (1 + SIMILARITY) <= (F.col("n_a") + F.col("n_b")) * (1 - SIMILARITY) + 1e-6


def _texts(docs: DataFrame, uids: DataFrame) -> DataFrame:
    """(uid, shingles, and their SKETCH) of the lines asked for."""
    wanted = Table(uids, "passage-wanted")
    lines = docs.select(F.explode(F.split("text", "\n")).alias("_line"))
    lines = lines.select(F.xxhash64("_line").alias("uid"), "_line")
    lines = lines.join(wanted.hinted(HASH_BYTES), "uid", "left_semi").groupBy("uid").agg(F.first("_line").alias("_line"))
    words = lines.select("uid", F.array_remove(F.split("_line", SPACES), "").alias("_words"))
    starts = F.sequence(F.lit(1), F.size("_words") - SHINGLE_WORDS + 1)
    runs = F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, SHINGLE_WORDS)))
    shingles = words.select("uid", F.array_distinct(runs).alias("shingles"))

    def parity(word: int) -> Column:
        here = F.filter("shingles", lambda h: F.shiftright(h, 6).bitwiseAND(3) == word)
        return F.aggregate(here, F.lit(0).cast("bigint"), lambda acc, h: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(63).cast("int"))))

    return shingles.select("uid", "shingles", F.size("shingles").alias("n"), *[parity(k).alias(f"p{k}") for k in range(4)])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingles have a Jaccard similarity of SIMILARITY or more."""
    left = texts.select(F.col("uid").alias("a"), F.col("shingles").alias("_x"))
    right = texts.select(F.col("uid").alias("b"), F.col("shingles").alias("_y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_x", "_y"))
    return both.where(common >= SIMILARITY * (F.size("_x") + F.size("_y") - common)).select("a", "b")


@apart
def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the words of repeated passages; all columns stay.

    Lines that lose words have single spaces between the rest; lines that lose all
    go, other lines are as they were.
    """
    small_batches(docs.sparkSession)
    found = repeated_passages(docs).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_of"), "spans")
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"]) == found["_of"])
    joined = docs.join(found, same, "left").select(*[docs[c] for c in docs.columns], found["spans"].alias("_spans"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_without(t, s) for t, s in zip(text, spans)])

    rest = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans"))
    return joined.withColumn("text", rest).select(*docs.columns)


def _without(text: str | None, spans: list | None) -> str | None:
    if text is None or spans is None:
        return text
    gone = {k for s in spans for k in range(s["start"], s["start"] + s["n"])}
    at, out = 0, []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        stay = [w for k, w in enumerate(words, at) if k not in gone]
        if len(stay) == len(words):
            out.append(line)
        elif stay:
            out.append(b" ".join(stay))
        at += len(words)
    return b"\n".join(out).decode("utf-8", "surrogatepass")
