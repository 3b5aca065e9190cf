"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, apart, ascii_lower

PREFIX_CHARS = 64
GROUP_BYTES = 48  # of a length and a prefix hash in a broadcast relation
LENGTH_BYTES = 32  # of a length alone


def exact_duplicates(docs: DataFrame, digest_all: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every document.

    Texts are equal if they are the same after lower-casing A-Z; the largest
    doc_id of equal texts stays.  Lengths that occur once end there, then
    prefixes that occur once; only the rest is normalised and hashed as a whole.
    text_sha256 is NULL where no full hash was needed, unless ``digest_all``.

    NULL text counts as empty.  NULL ids come before all others.  Rows that
    repeat both id and text are one document: one row here, each of them counted
    in group_size.  An empty table gives an empty result.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    keys = [
        F.octet_length(text).alias("_length"),
        F.xxhash64(ascii_lower(F.substring(text, 1, PREFIX_CHARS))).alias("_prefix"),
    ]
    narrow = Table(docs.select(*keys), "exact-keys").frame
    # A length may hold most rows, so few lengths are broadcast rather than shuffled on.
    lengths = Table(narrow.groupBy("_length").count().where("count > 1").select("_length"), "exact-lengths")
    open_rows = narrow.join(lengths.hinted(LENGTH_BYTES), "_length", "left_semi")
    groups = open_rows.groupBy("_length", "_prefix").count().where("count > 1").drop("count")
    groups = Table(groups.withColumn("_open", F.lit(True)), "exact-groups")

    keyed = docs.select(docs["doc_id"], text.alias("_text"), *keys)
    digest = F.sha2(ascii_lower(F.col("_text")), 256)
    wanted = F.lit(True) if digest_all else F.col("_open")
    if groups.small(GROUP_BYTES):
        keyed = keyed.join(F.broadcast(groups.frame), ["_length", "_prefix"], "left")
        hashed = keyed.select("doc_id", "_length", "_open", F.when(wanted, digest).alias("text_sha256"))
    else:
        # Beyond that, hashes are moved instead of texts.
        hashed = keyed.select("doc_id", "_length", "_prefix", digest.alias("text_sha256"))
        hashed = hashed.join(groups.frame, ["_length", "_prefix"], "left")
        hashed = hashed.select("doc_id", "_length", "_open", F.when(wanted, F.col("text_sha256")).alias("text_sha256"))
    hashed = Table(hashed, "exact-hashes").frame

    single = hashed.where("_open is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256"
    )
    members = hashed.where("_open").groupBy("_length", "text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = (
        hashed.where("_open")
        .groupBy("_length", "text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    grouped = members.join(kept, ["_length", "text_sha256"]).select("doc_id", "keep_id", "group_size", "text_sha256")
    return single.union(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


@apart
def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text a larger doc_id has too; all columns stay."""
    kept = exact_duplicates(docs, digest_all=True).where("kept")
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    sha = F.sha2(ascii_lower(F.coalesce(docs["text"], F.lit(""))), 256)
    here = docs.withColumn("_row_sha", sha)
    same = here["doc_id"].eqNullSafe(kept["_id"]) & (here["_row_sha"] == kept["_sha"])
    rows = here.join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "_row_sha"]).drop("_row_sha")
