"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

Every round broadcasts the tree of that round's centroids, whose number and width are
the caller's and checked, and moves nothing of the vectors: tasks send sums, one row
for each cluster and component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_BYTES, Table

#: Centroids in a leaf of the tree.
LEAF_CENTROIDS = 2
#: Share by which rounding may move a distance.
ROUNDING = 1e-9


class VantageTree:
    """Centroids by their distance from vantage points, which are centroids themselves.

    A node has a vantage point and two children, one for the nearer half of its other
    centroids and one for the rest, each with the range of its distances from the
    vantage point; a leaf has a few centroids.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(centroids)))

    def _grow(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(members) <= LEAF_CENTROIDS:
            self.nodes[at] = (members, ())
            return at
        vantage, others = members[0], members[1:]
        gaps = np.sqrt(_squares(self.centroids[others], self.centroids[vantage]))
        order = np.argsort(gaps, kind="stable")
        halves = [h for h in np.array_split(order, 2) if len(h)]
        children = [(gaps[h].min(), gaps[h].max(), self._grow(others[h])) for h in halves]
        self.nodes[at] = (members[:1], tuple(children))
        return at

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row its nearest centroid and the squared distance; ties go to the smaller number.

        Each row searches best first: of its open nodes it takes the one with the
        lowest bound, and it is done when that is beyond its best distance.  A node at
        just that distance is searched, as it may have a smaller number.  Rows that
        take the same node go through it together.
        """
        square = np.full(len(rows), np.iinfo(np.int64).max)
        cluster = np.zeros(len(rows), np.int64)
        bounds = np.full((len(rows), len(self.nodes)), np.inf)
        bounds[:, 0] = 0.0
        live = np.arange(len(rows))
        while len(live):
            turn = bounds[live].argmin(axis=1)
            reach = np.sqrt(square[live].astype(np.float64))
            going = bounds[live, turn] <= reach * (1 + ROUNDING) + ROUNDING
            live, turn = live[going], turn[going]
            for node in np.unique(turn):
                self._visit(node, live[turn == node], rows, square, cluster, bounds)
        return cluster, square

    def _visit(self, node, at, rows, square, cluster, bounds) -> None:
        members, children = self.nodes[node]
        floor = bounds[at, node]
        bounds[at, node] = np.inf
        for centroid in members:
            found = _squares(rows[at], self.centroids[centroid])
            better = (found < square[at]) | ((found == square[at]) & (centroid < cluster[at]))
            square[at[better]], cluster[at[better]] = found[better], centroid
        if children:
            away = np.sqrt(found.astype(np.float64))
            for low, high, child in children:
                bounds[at, child] = np.maximum(floor, np.maximum(low - away, away - high) - ROUNDING * (away + high))


def _squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers."""
    apart = rows - point
    return np.einsum("ij,ij->i", apart, apart)


def _integers(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), width)


def _nearest_rows(sent: Broadcast, id_column: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        for batch in batches:
            cluster, square = tree.nearest(_integers(batch["vector"], tree.centroids.shape[1]))
            columns = [batch[id_column], pa.array(cluster.astype(np.int32)), pa.array(square)]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "cluster", "distance"])

    return run


def _sums(sent: Broadcast) -> Callable:
    """One row for each cluster and component that a task has met: count and sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        many, width = tree.centroids.shape
        counts, sums = np.zeros(many, np.int64), np.zeros((many, width), np.int64)
        for batch in batches:
            rows = _integers(batch["vector"], width)
            cluster, _ = tree.nearest(rows)
            counts += np.bincount(cluster, minlength=many)
            for c in np.unique(cluster):
                sums[c] += rows[cluster == c].sum(axis=0)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(met, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(met))),
                pa.array(np.repeat(counts[met], width)),
                pa.array(sums[met].ravel()),
            ],
            ["cluster", "component", "n", "total"],
        )

    return run


class Clusters:
    """The vectors (id, vector) on disk and their centroids, by number."""

    def __init__(self, rows: Table, centroids: np.ndarray):
        self.rows, self.centroids = rows, centroids

    def assigned(self) -> DataFrame:
        """(id, cluster, distance): the nearest centroid and its squared distance."""
        frame = self.rows.frame
        name, kind = frame.dtypes[0]
        sent = frame.sparkSession.sparkContext.broadcast(VantageTree(self.centroids))
        run = _nearest_rows(sent, name)
        return frame.mapInArrow(run, f"{name} {kind}, cluster int, distance bigint")


def cluster(vectors: DataFrame, first: Column, many: int, rounds: int, width: int) -> Clusters:
    """Lloyd's rounds over ``vectors`` (an id, then ``vector`` of ``width`` whole numbers).

    The first centroids are the ``many`` vectors lowest by ``first``, then id, then
    vector (fewer vectors: all).  A round assigns every vector to the nearest centroid,
    ties to the smaller number, and moves each centroid to the exact floor of its
    vectors' mean; one without vectors stays.  Repeated rows count as often as they
    come; no vectors give no centroids.
    """
    if many * width * 8 > BROADCAST_BYTES:
        raise ValueError(f"{many} centroids of {width} components are too many to broadcast")
    name = vectors.columns[0]
    rows = Table(vectors.select(name, "vector"), "centroid-vectors")
    start = rows.frame.orderBy(first.asc_nulls_last(), F.col(name).asc_nulls_last(), "vector").limit(many)
    centroids = np.array([r.vector for r in start.collect()], np.int64).reshape(-1, width)
    for _ in range(rounds if len(centroids) else 0):
        sent = rows.spark.sparkContext.broadcast(VantageTree(centroids))
        summed = rows.frame.select("vector").mapInArrow(_sums(sent), "cluster int, component int, n bigint, total bigint")
        # At most one row for each cluster and component comes to the driver.
        totals = summed.groupBy("cluster", "component").agg(
            F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        )
        centroids = centroids.copy()
        for r in totals.collect():
            centroids[r.cluster, r.component] = int(r.total) // r.n
        sent.destroy()
    return Clusters(rows, centroids)
