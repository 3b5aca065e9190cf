"""Hard negatives: vectors of another label that score a set share of a positive's score.

Candidates are indexed by cover trees.  Each vector gets one more component that
brings all to one length, so that the inner product with an anchor follows from the
distance, and a node's centre and covering radius bound the scores of all below it.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Table
from tidemark.llm.vectors import best, matrix, tiled

SHARD_ROWS = 8_192
BLOCK_ROWS = 512
#: Covering radii shrink by this factor at least from level to level.
BASE = 1.3
#: Nodes with no more vectors are not split.
LEAF_ROWS = 128
#: Children with fewer vectors than this are no nodes: their vectors are kept together with their parent.
CHILD_ROWS = 16
#: A node has one centre tried for so many of its vectors; what is left then is kept with it too.
ROWS_PER_CENTRE = 32
#: Share of the vectors' length by which rounding may move a distance.
ROUNDING = 1e-6


class CoverTree:
    """A cover tree over vectors of integers, each lengthened by one component to one norm.

    A node has a centre, the radius that covers all below it, children with smaller
    radii, and a span of vectors of its own: those of a leaf, or those without
    enough near neighbours to make a child.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        squares = (rows * rows).sum(axis=1)
        self.square = float(squares.max(initial=0.0))
        self._points = np.column_stack([rows, np.sqrt(self.square - squares)])
        self._blur = ROUNDING * np.sqrt(self.square)
        centre, radius, first, last, start, end, order = [0], [], [], [], [], [], []
        placed = 0
        # Nodes are taken in the order they are made, so a node's children stand side by side.
        waiting = deque([np.arange(len(ids))])
        while waiting:
            members = waiting.popleft()
            distances = self._distances(members)
            reach = float(distances.max(initial=0.0))
            radius.append(reach + self._blur)
            children, own = self._split(members, distances, reach)
            start.append(placed)
            first.append(len(centre))
            for child in children:
                centre.append(child[0])
                waiting.append(child)
            last.append(len(centre))
            order.append(own)
            placed += len(own)
            end.append(placed)
        self.radius, self.centre = np.array(radius), rows[centre]
        self.children, self.span = list(zip(first, last)), list(zip(start, end))
        order = np.concatenate(order)
        self.ids, self.labels, self.rows = ids[order], labels[order], np.ascontiguousarray(rows[order])
        del self._points

    def _distances(self, members: np.ndarray) -> np.ndarray:
        """From the first member to each."""
        products = self._points[members] @ self._points[members[0]]
        return np.sqrt(np.maximum(2 * (self.square - products), 0.0))

    def _split(self, members: np.ndarray, distances: np.ndarray, reach: float) -> tuple[list[np.ndarray], np.ndarray]:
        """Members by centres further apart than the next level's radius, and those that stay with the node.

        Equal vectors can't be told apart and stay in one leaf.
        """
        if len(members) <= LEAF_ROWS or reach <= 2 * self._blur:
            return [], members
        parts, staying, radius = [], [], reach / BASE
        for _ in range(max(2, len(members) // ROWS_PER_CENTRE)):
            near = distances <= radius
            (parts if near.sum() >= CHILD_ROWS else staying).append(members[near])
            members = members[~near]
            if not len(members):
                break
            distances = self._distances(members)
        return parts, np.concatenate([*staying, members])

    def leaves(self, query: np.ndarray, wanted: Callable) -> Iterator[tuple[int, int]]:
        """Spans of vectors that may hold a match, by falling upper bound of their nodes.

        ``wanted(low, high)`` tells which nodes are, from bounds on their scores; it is
        asked when a node is met and again when its turn comes.
        """
        square = float(query @ query)
        length, both = np.sqrt(square), self.square + square
        blur = 1e-9 * both + 1e-6

        def bounds(nodes: slice) -> tuple[np.ndarray, np.ndarray]:
            products, radius = self.centre[nodes] @ query, self.radius[nodes]
            away = np.sqrt(np.maximum(both - 2 * products, 0.0))
            high = np.minimum((both - np.maximum(away - radius, 0.0) ** 2) / 2, products + length * radius)
            low = np.maximum((both - (away + radius) ** 2) / 2, products - length * radius)
            slack = blur + self._blur * (away + length)
            return low - slack, high + slack

        low, high = bounds(slice(0, 1))
        heap = [(-high[0], 0, low[0])]
        while heap:
            minus, node, low = heapq.heappop(heap)
            if not wanted(low, -minus):
                continue
            start, end = self.span[node]
            if start < end:
                yield start, end
            first, last = self.children[node]
            if first == last:
                continue
            lows, highs = bounds(slice(first, last))
            for at in np.flatnonzero(wanted(lows, highs)):
                heapq.heappush(heap, (-highs[at], first + int(at), lows[at]))


def _index(rows: pa.Table) -> CoverTree:
    return CoverTree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["vector"].combine_chunks()))


class _Positives:
    """The first rows of an anchor's label in a shard."""

    def __init__(self, most: int):
        self.most = most

    def __call__(self, tree: CoverTree, anchors: pa.RecordBatch) -> pa.RecordBatch:
        of, ids, scores = [], [], []
        asked = matrix(anchors["vector"], tree.rows.shape[1])
        for own, label, query in zip(anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), asked):
            found = (np.empty(0), np.empty(0, np.int64))
            limit = -np.inf
            for start, end in tree.leaves(query, lambda low, high: high >= limit):
                values = tree.rows[start:end] @ query
                here = np.flatnonzero((values >= limit) & (tree.labels[start:end] == label) & (tree.ids[start:end] != own))
                found = best(
                    np.concatenate([found[0], values[here]]), np.concatenate([found[1], tree.ids[start:end][here]]), self.most
                )
                limit = found[0][-1] if len(found[0]) == self.most else -np.inf
            of.append(np.full(len(found[1]), own, np.int64))
            ids.append(found[1])
            scores.append(found[0].astype(np.int64))
        columns = [pa.array(np.concatenate(c)) for c in (of, ids, scores)]
        return pa.RecordBatch.from_arrays(columns, ["anchor_id", "positive_id", "positive_score"])


class _Negatives:
    """The first rows of other labels in each of an anchor's windows, in a shard."""

    def __init__(self, most: int, least_percent: int, most_percent: int):
        self.most, self.least_percent, self.most_percent = most, least_percent, most_percent

    def __call__(self, tree: CoverTree, anchors: pa.RecordBatch) -> pa.RecordBatch:
        columns = [[] for _ in range(5)]
        asked = matrix(anchors["vector"], tree.rows.shape[1])
        rows = zip(
            *[anchors[c].to_pylist() for c in ("vec_id", "label", "positive_ids", "positive_scores")], asked
        )
        for own, label, positives, scores, query in rows:
            windows = sorted(set(scores))
            found = dict(zip(windows, self._windows(tree, label, query, windows)))
            for positive, score in zip(positives, scores):
                values, ids = found[score]
                for column, part in zip(columns, (own, positive, ids, score, values.astype(np.int64))):
                    column.append(np.broadcast_to(np.asarray(part, np.int64), ids.shape))
        names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names)

    def _windows(self, tree: CoverTree, label: int, query: np.ndarray, scores: list[int]) -> list:
        """The first (values, ids) of each positive score's window, from one descent for all of them."""
        # The least and greatest whole numbers inside.
        floors = [-(-self.least_percent * score // 100) for score in scores]
        ceilings = np.array([self.most_percent * score // 100 for score in scores], np.float64)
        needs = np.where(floors <= ceilings, floors, np.inf)
        found = [(np.empty(0), np.empty(0, np.int64))] * len(scores)

        def wanted(low, high):
            return ((np.asarray(high)[..., None] >= needs) & (np.asarray(low)[..., None] <= ceilings)).any(axis=-1)

        for start, end in tree.leaves(query, wanted):
            values = tree.rows[start:end] @ query
            other = np.flatnonzero((values >= needs.min()) & (values <= ceilings.max()))
            other = other[tree.labels[start:end][other] != label]
            values, ids = values[other], tree.ids[start:end][other]
            inside = (values >= needs[:, None]) & (values <= ceilings[:, None])
            for at in np.flatnonzero(inside.any(axis=1)):
                here = inside[at]
                found[at] = best(
                    np.concatenate([found[at][0], values[here]]), np.concatenate([found[at][1], ids[here]]), self.most
                )
                if len(found[at][0]) == self.most:
                    needs[at] = found[at][0][-1]
        return found


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has unique ids (vec_id bigint, vector array<int>, label, a whole
    number); ``is_anchor`` picks the anchors among them.  A score is the inner product
    with the anchor; higher ones come first, then smaller ids.  An anchor's positives
    are the first other rows of its label, and a positive's negatives the first rows
    of other labels with a score from ``least_percent`` to ``most_percent`` of the
    positive's, both included; fewer where there are fewer.  A positive with a
    negative score has an empty window and gives no rows, as does an anchor alone with
    its label.  Rows without a label take no part.  Components a shorter vector lacks
    count as 0.
    """
    known = vectors.where("label is not null").select("vec_id", "vector", F.col("label").cast("bigint").alias("label"))
    rows = Table(known, "negatives-vectors")
    anchors = Table(rows.frame.where(is_anchor), "negatives-anchors")
    found = tiled(
        rows, anchors, _index, _Positives(positives),
        "anchor_id bigint, positive_id bigint, positive_score bigint", shard_rows, block_rows,
    )
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id"))
    first = found.withColumn("_place", place).where(F.col("_place") <= positives)
    # At most ``positives`` rows an anchor.
    windows = first.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("_of")
    )
    windows = windows.select(
        "vec_id", F.col("_of.positive_id").alias("positive_ids"), F.col("_of.positive_score").alias("positive_scores")
    )
    asking = Table(anchors.frame.join(windows, "vec_id"), "negatives-windows")
    found = tiled(
        rows, asking, _index, _Negatives(negatives, least_percent, most_percent),
        "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint",
        shard_rows, block_rows,
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
