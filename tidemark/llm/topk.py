"""Exact top-k search by inner product with MaxScore.

The dimensions are the terms and a vector's components its weights: signed, so a
term's bound is the most that any vector's weight of either sign can add, and zero
if none adds anything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Table
from tidemark.llm.vectors import best, matrix, tiled

SHARD_ROWS = 16_384
BLOCK_ROWS = 1_024
#: Vectors with bounds of their own within a shard.
SEGMENT_ROWS = 4_096
#: A posting list with more of its segment's vectors is kept as an array over all of them.
DENSE_SHARE = 0.25


class Postings:
    """The posting lists of a segment, a bound above and below for each, and the weights for probing."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids = ids
        self.weights = np.ascontiguousarray(rows.T)
        self.most = self.weights.max(axis=1, initial=0.0)
        self.least = self.weights.min(axis=1, initial=0.0)
        self.lists = [np.flatnonzero(w) for w in self.weights]
        self.lists = [None if len(p) > DENSE_SHARE * len(ids) else p for p in self.lists]

    def search(self, own: int, query: np.ndarray, k: int, found: tuple[np.ndarray, np.ndarray]):
        """``found`` (scores, ids) with what this segment has that belongs among the first k.

        Terms whose bounds together stay under the k-th score so far are not
        essential: a vector in none but their lists can't be among the first k.  The
        other lists are traversed; the rest is probed, highest bound first, for
        vectors that can still reach the k-th score.  One that equals it stays, as
        its id may be smaller.
        """
        limit = found[0][-1] if len(found[0]) == k else -np.inf
        terms = np.flatnonzero(query)
        weights = query[terms]
        bounds = np.maximum(weights * self.most[terms], weights * self.least[terms])
        order = np.argsort(bounds, kind="stable")
        terms, weights, bounds = terms[order], weights[order], bounds[order]
        sums = np.cumsum(bounds)
        split = int(np.searchsorted(sums, limit, side="left"))
        rest = sums[split - 1] if split else 0.0

        total, scratch = np.zeros(len(self.ids)), np.empty(len(self.ids))
        for term, weight in zip(terms[split:], weights[split:]):
            listed = self.lists[term]
            if listed is None:
                total += np.multiply(self.weights[term], weight, out=scratch)
            else:
                total[listed] += self.weights[term][listed] * weight

        competing = np.flatnonzero(total >= limit - rest)
        competing = competing[self.ids[competing] != own]
        scores = total[competing]
        for at in range(split - 1, -1, -1):
            if not len(competing):
                return found
            scores += self.weights[terms[at]][competing] * weights[at]
            rest = sums[at - 1] if at else 0.0
            able = scores >= limit - rest
            if not able.all():
                competing, scores = competing[able], scores[able]
        return best(np.concatenate([found[0], scores]), np.concatenate([found[1], self.ids[competing]]), k)


def _index(rows: pa.Table) -> list[Postings]:
    ids = rows["vec_id"].to_numpy()
    values = matrix(rows["vector"].combine_chunks())
    return [Postings(ids[at : at + SEGMENT_ROWS], values[at : at + SEGMENT_ROWS]) for at in range(0, len(ids), SEGMENT_ROWS)]


class _Answer:
    def __init__(self, k: int):
        self.k = k

    def __call__(self, segments: list[Postings], queries: pa.RecordBatch) -> pa.RecordBatch:
        of, ids, scores = [], [], []
        asked = matrix(queries["vector"], len(segments[0].weights))
        for own, query in zip(queries["vec_id"].to_pylist(), asked):
            found = (np.empty(0), np.empty(0, np.int64))
            for segment in segments:
                found = segment.search(own, query, self.k, found)
            of.append(np.full(len(found[1]), own, np.int64))
            scores.append(found[0].astype(np.int64))
            ids.append(found[1])
        columns = [pa.array(np.concatenate(c)) for c in (of, ids, scores)]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k other vectors with the highest inner product.

    ``vectors`` has unique ids (vec_id bigint, vector array<int>), as ``integer_vectors``
    gives them; ``is_query`` picks the queries among them.  Ranks count from 1; equal
    scores go by the smaller vec_id.  A query with fewer than k others gets all, one
    alone nothing, whatever the sign of the scores.  Components a shorter vector lacks
    count as 0, so an empty vector scores 0 with all.
    """
    rows = Table(vectors.select("vec_id", "vector"), "topk-vectors")
    queries = Table(rows.frame.where(is_query), "topk-queries")
    found = tiled(
        rows, queries, _index, _Answer(k), "query_id bigint, vec_id bigint, score bigint", shard_rows, block_rows
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
