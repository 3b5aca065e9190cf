"""Integer vectors, and the pairing of stated queries with all vectors in tiles.

A search compares every query with every vector.  The vectors are dealt into shards
and the queries into blocks, both by hash, and a task gets one shard and one block
at a time: it indexes the shard once and answers the block's queries as they stream
in.  Shards and blocks have a size of their own, so a task's memory does not grow
with the tables; there are only more tiles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table

#: Largest size of a component; sums of 2**13 products of two stay exact in doubles.
LARGEST = 1 << 20
#: Tiles beyond this many share partitions.
MOST_PARTITIONS = 20_000


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & finite


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double; a result past LARGEST fails the job."""

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * scale)
        small = F.abs(x.cast("double") * scale) < LARGEST
        return F.when(small, value).otherwise(F.raise_error(F.lit("vector component out of range"))).cast("int")

    return F.transform(vector, whole)


def integer_vectors(rows: DataFrame, scale: int, *others: str) -> DataFrame:
    """(vec_id, vector, others) of the rows of ``rows`` (vec_id, embedding) that take part.

    Rows without an id or a usable vector are left out.  Rows that repeat an id count
    once: the least vector stays, then the least of the other columns.
    """
    taking = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    row = F.struct(scaled(F.col("embedding"), scale).alias("vector"), *others)
    return taking.groupBy("vec_id").agg(F.min(row).alias("_row")).select("vec_id", "_row.*")


def matrix(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros, and so does all beyond ``width``."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    longest = int(sizes.max(initial=0))
    if len(sizes) and (sizes == longest).all():
        rows = values.reshape(len(sizes), longest)
    else:
        rows = np.zeros((len(sizes), longest))
        starts = np.cumsum(sizes) - sizes
        rows[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(starts, sizes)] = values
    if width is None or width == longest:
        return rows
    fitted = np.zeros((len(rows), width))
    fitted[:, : min(width, longest)] = rows[:, :width]
    return fitted


def tiled(
    vectors: Table,
    queries: Table,
    index: Callable[[pa.Table], Any],
    answer: Callable[[Any, pa.RecordBatch], pa.RecordBatch],
    schema: str,
    shard_rows: int,
    block_rows: int,
) -> DataFrame:
    """What ``answer`` gives for each block of queries and the ``index`` of each shard of vectors.

    Both tables have vec_id and vector.  A lost executor costs its tiles only: they
    are dealt by hash and come out the same again.
    """
    shards = max(1, math.ceil(vectors.rows / shard_rows))
    blocks = max(1, math.ceil(queries.rows / block_rows))
    partitions = min(shards * blocks, MOST_PARTITIONS)
    shard, block = F.pmod(F.xxhash64("vec_id"), F.lit(shards)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks))
    held = vectors.frame.select(
        "*", F.lit(0).alias("_role"), shard.alias("_shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    )
    asked = queries.frame.select(
        "*", F.lit(1).alias("_role"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), block.alias("_block")
    )
    rows = held.unionByName(asked, allowMissingColumns=True)
    rows = rows.withColumn("_tile", F.col("_shard").cast("bigint") * blocks + F.col("_block")).drop("_shard", "_block")
    dealt = rows.repartitionById(partitions, F.pmod("_tile", F.lit(partitions)).cast("int"))
    return dealt.sortWithinPartitions("_tile", "_role", "vec_id").mapInArrow(_Tiles(index, answer), schema)


class _Tiles:
    """Runs over sorted rows: a tile's vectors first, then its queries."""

    def __init__(self, index: Callable, answer: Callable):
        self.index, self.answer = index, answer

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, built = None, [], None
        for batch in batches:
            tiles, roles = batch["_tile"].to_numpy(), batch["_role"].to_numpy()
            turns = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(roles) != 0)) + 1
            for start, end in zip([0, *turns], [*turns, batch.num_rows]):
                if start == end:
                    continue
                if tiles[start] != tile:
                    tile, held, built = tiles[start], [], None
                part = batch.slice(start, end - start)
                if roles[start] == 0:
                    held.append(part)
                elif held:
                    if built is None:
                        built = self.index(pa.Table.from_batches(held))
                    yield self.answer(built, part)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids, ties to the smaller id, best first."""
    if len(scores) > 4 * k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]
