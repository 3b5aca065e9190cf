"""Repeated passages of lines: overlapping windows of three lines, later occurrences removed.

Lines end at each line feed.  Three consecutive lines with a word among them are
a window; of equal windows in all documents the first stays, by doc_id, text hash
and position, and the lines of all others are removed.  Lines covered by several
removed windows are removed once; what is left is joined by line feeds again.

Texts of fewer than three lines, NULL and empty ones stay as they are.  NULL ids
come first.  Rows that repeat both id and text are one document and are treated
alike.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_BYTES, Table, apart

WINDOW = 3
WINDOW_BYTES = 96  # of a repeated window in a broadcast relation


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text, kept_text, n_lines, n_removed) of every row; NULL texts have no lines."""
    marked = _marked(docs.select("doc_id", "text"))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    removed = F.when(F.col("_starts").isNull(), 0).otherwise(F.size(_covered()))
    return marked.select(
        "doc_id",
        "text",
        _remaining().alias("kept_text"),
        lines.cast("bigint").alias("n_lines"),
        removed.cast("bigint").alias("n_removed"),
    )


@apart
def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the remaining texts; documents of which nothing remains go."""
    marked = _marked(docs).withColumn("text", _remaining())
    gone = F.col("_starts").isNotNull() & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return marked.where(~gone).select(*docs.columns)


def _marked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_starts``: where in its lines removed windows begin, or NULL."""
    found = _removals(docs.select("doc_id", "text"))
    few = (found.totals.get("bytes") or 0) <= BROADCAST_BYTES
    removals = F.broadcast(found.frame) if few else found.frame
    same = docs["doc_id"].eqNullSafe(removals["_id"]) & (F.xxhash64(docs["text"]) == removals["_key"])
    return docs.join(removals, same, "left").select(*[docs[c] for c in docs.columns], "_starts")


def _removals(docs: DataFrame) -> Table:
    """(_id, _key, _starts) of the documents with windows that came before, _key being the text's hash."""
    windows = _windows(docs)
    place = F.struct("_id", "_key", "_at")
    first = windows.groupBy("_h", "_g").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    first = Table(first.where("_n > 1").drop("_n"), "line-windows")
    later = windows.join(first.hinted(WINDOW_BYTES), ["_h", "_g"]).where(~place.eqNullSafe(F.col("_first")))
    starts = later.groupBy("_id", "_key").agg(F.collect_set("_at").alias("_starts"))
    return Table(starts, "line-removals", bytes=F.sum(F.size("_starts") * 4 + 64))


def _windows(docs: DataFrame) -> DataFrame:
    """(_id, _key, _at, _h, _g): a 128-bit hash of every window of every document."""
    lines = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), F.split("text", "\n").alias("_lines")
    ).where(F.size("_lines") >= WINDOW)
    placed = lines.select("_id", "_key", F.posexplode(_runs(F.col("_lines"))).alias("_at", "_w"))
    worded = placed.where(F.exists("_w", lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    backwards = [F.col("_w")[k] for k in reversed(range(WINDOW))]
    return worded.select("_id", "_key", "_at", F.xxhash64("_w").alias("_h"), F.xxhash64(F.lit(WINDOW), *backwards).alias("_g"))


def _runs(lines: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(lines) - (WINDOW - 1))
    return F.transform(starts, lambda i: F.slice(lines, i, WINDOW))


def _covered() -> Column:
    """Positions of removed lines, each once."""
    spans = F.transform("_starts", lambda s: F.array(*[s + k for k in range(WINDOW)]))
    return F.array_distinct(F.flatten(spans))


def _remaining() -> Column:
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), _covered())
    cut = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return F.when(F.col("_starts").isNull(), F.col("text")).otherwise(cut)
