"""Near duplicates by SimHash: fingerprints, deletion-variant candidates, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, apart, small_batches
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Hashes whose bits are counted at once.
SLICE = 1 << 16
#: Buckets with more members are linked through neighbouring fingerprints instead of pairs.
CROWDED = 16
KEY_BYTES = 64


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the whole text, as a signed number; no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of ASCII letters and spaces only
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE_WORDS))))
    digest = xxhash.xxh64_intdigest
    total = max(1, len(words) - SHINGLE_WORDS + 1)
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, total)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, SLICE):
        part = hashes[at : at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, fp) of every row of ``docs``, _key being the text's hash."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", _key(F.col("text")).alias("_key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "_key", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind}, _key bigint, fp bigint")


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row.

    Fingerprints with at most two differing bits are linked, and component_id is
    the smallest doc_id of all that are linked, directly or through others.
    NULL and empty texts have fingerprint 0 and are linked like any other.  NULL
    ids are never chosen unless a component has no other.  Repeated rows come out
    as often as they go in.
    """
    prints, roots = _components(docs)
    chosen = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = roots.join(chosen, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of ``docs``, and (fp, first_id, _first, root) of each one: its
    smallest doc_id, the first document that has it, and the smallest it is linked to."""
    prints = Table(fingerprints(docs), "simhash-prints").frame
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_key")).alias("_first")
    unique = Table(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), first), "simhash-unique").frame
    roots = connected_components(links(unique.select("fp")))
    roots = unique.join(roots, unique["fp"] == roots["node"], "left").select(
        "fp", "first_id", "_first", F.coalesce("root", "fp").alias("root")
    )
    return prints, Table(roots, "simhash-roots").frame


@apart
def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that of component_id.

    A document is an id and a text.  Of several with the id, or with NULL ids only,
    the first by the text's hash stays.  Rows that repeat both come out once.
    """
    chosen = _components(docs)[1].groupBy("root").agg(F.min("_first").alias("_first"))
    chosen = chosen.select(F.col("_first.doc_id").alias("_id"), F.col("_first._key").alias("_of"))
    key = _key(F.col("text"))
    twice = docs.groupBy("doc_id", key.alias("_of")).count().where("count > 1")
    twice = Table(twice.select(F.col("doc_id").alias("_id"), "_of"), "simhash-repeated")
    met = F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_of"))
    rows = docs.join(chosen, met, "left_semi")
    if not twice.rows:
        return rows
    row = F.min_by(F.struct(*[F.col(c) for c in docs.columns]), F.xxhash64(*docs.columns))
    first = rows.join(twice.frame, met, "left_semi").groupBy("doc_id", key).agg(row.alias("_row"))
    return rows.join(twice.frame, met, "left_anti").union(first.select("_row.*"))


def links(unique: DataFrame) -> DataFrame:
    """(a, b) between different fingerprints of ``unique`` (fp), enough to connect all within two bits.

    Two halves of 32 bits: of two differing bits at most one falls in one of the
    halves.  Each half is indexed as it is, and with each of its bits left out;
    a variant only joins a set bit with a clear one, so a pair meets once.
    Candidates are verified on all 64 bits.

    Members of a bucket with more than CROWDED entries are linked without pairs:
    fingerprints are within two bits of each other exactly if some 64-bit value
    is within one bit of both, so each of them links to the smallest of those
    around every such value.
    """
    variants = _variants(unique)
    # Clear bits are counted in the low half of the sum, set bits in the high half.
    counted = variants.groupBy("key").agg(F.sum(F.expr("if(bit = 1, 4294967296L, 1L)")).alias("_sum"))
    counted = counted.select(
        "key", F.expr("_sum & 4294967295L").alias("_clear"), F.expr("shiftrightunsigned(_sum, 32)").alias("_set")
    )
    exact = F.expr("shiftrightunsigned(key, 32) >= 64")
    live = counted.where((exact & (F.col("_clear") > 1)) | (~exact & (F.col("_clear") > 0) & (F.col("_set") > 0)))
    live = live.select("key", (F.col("_clear") + F.col("_set") > CROWDED).alias("crowded"))
    live = Table(live, "simhash-buckets")
    members = Table(variants.join(live.hinted(KEY_BYTES), "key"), "simhash-members").frame

    few = members.where("not crowded")
    left = few.where("bit = 0").select("key", F.col("fp").alias("a"))
    right = few.where((F.col("bit") == 1) | exact).select("key", F.col("fp").alias("b"))
    met = left.join(right, "key").where(~exact | (F.col("a") < F.col("b")))
    pairs = met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")

    dense = members.where("crowded").select("fp").distinct()
    around = dense.withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(64)))).select(
        "fp", F.expr("if(_bit = 64, fp, fp ^ shiftleft(1L, _bit))").alias("centre")
    )
    nearest = around.groupBy("centre").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    stars = around.join(nearest, "centre").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars)


def _variants(unique: DataFrame) -> DataFrame:
    """(key, fp, bit): 66 keys a fingerprint, of bucket kind and remaining bits; bit is the one left out."""
    kinds = unique.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(65))))
    half = F.expr("if(_k = 65 or (_k >= 32 and _k < 64), shiftrightunsigned(fp, 32), fp & 4294967295L)")
    halves = kinds.select("fp", "_k", half.alias("_half"))
    left_out: Column = F.expr("if(_k < 64, shiftleft(1L, _k % 32), 0L)")
    return halves.select(
        F.expr("shiftleft(cast(_k as bigint), 32)").bitwiseOR(
            F.col("_half").bitwiseAND(F.bitwise_not(left_out))
        ).alias("key"),
        "fp",
        F.when(F.col("_half").bitwiseAND(left_out) != 0, 1).otherwise(0).alias("bit"),
    )


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
