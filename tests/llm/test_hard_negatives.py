"""Cover-tree mining against every score."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.hard_negatives import CoverTree, hard_negatives
from tidemark.llm.queries import QUERIES
from tidemark.llm.vectors import integer_vectors

from .test_topk import SCHEMA


def plain(rows, anchors, positives=5, negatives=3):
    """Rows are {id: (vector, label)}."""
    out = set()
    for a in anchors:
        vector, label = rows[a]
        scores = sorted((-sum(x * y for x, y in zip(vector, v)), i, k) for i, (v, k) in rows.items() if i != a)
        for minus, p, _ in [s for s in scores if s[2] == label][:positives]:
            ps = -minus
            inside = [(i, -m) for m, i, k in scores if k != label and 50 * ps <= -100 * m <= 95 * ps]
            out |= {(a, p, n, i, ps, s) for n, (i, s) in enumerate(inside[:negatives], 1)}
    return out


def mined(frame, divisor, **sizes):
    rows = hard_negatives(frame, F.col("vec_id") % divisor == 0, **sizes).collect()
    assert len(rows) == len({(r.anchor_id, r.positive_id, r.rank) for r in rows})
    return {tuple(r) for r in rows}


def clustered(count, seed=1):
    """Groups around centres of different lengths, copies and loose vectors."""
    rng = random.Random(seed)
    centres = [[rng.randint(-200, 200) for _ in range(6)] for _ in range(8)]
    rows = {}
    for i in range(count):
        centre = rng.choice(centres)
        kind = i % 5
        if kind < 3:
            v = [c + rng.randint(-6, 6) for c in centre]
        elif kind == 3:
            v = list(centre)
        else:
            v = [rng.randint(-250, 250) for _ in range(6)]
        rows[i] = (v, rng.choice((0, 0, 0, 0, 1, 2, 3)))
    return rows


def test_against_every_score(spark):
    rows = clustered(1500)
    frame = spark.createDataFrame([(i, v, k) for i, (v, k) in rows.items()], "vec_id bigint, vector array<int>, label int")
    want = plain(rows, [i for i in rows if i % 30 == 0])
    assert len(want) > 300
    assert mined(frame, 30) == want
    assert mined(frame, 30, shard_rows=400, block_rows=20) == want


def test_tree_covers_and_bounds_all():
    rows = clustered(2000, seed=4)
    values = np.array([v for v, _ in rows.values()], float)
    tree = CoverTree(np.arange(2000), np.zeros(2000, int), values)
    assert sorted(tree.ids.tolist()) == list(range(2000))
    assert len(tree.span) > 8
    assert sum(end - start for start, end in tree.span) == 2000
    for query in values[::97]:
        best = max(values @ query)
        seen = []

        def wanted(low, high):
            return high >= best

        for start, end in tree.leaves(query, wanted):
            seen.extend((tree.rows[start:end] @ query).tolist())
        assert max(seen) == best
        assert len(seen) < 2000  # some nodes were left out
        assert seen.count(best) == (values @ query).tolist().count(best)


def test_equal_and_zero_vectors_stay_in_one_leaf():
    same = np.ones((5000, 3))
    tree = CoverTree(np.arange(5000), np.zeros(5000, int), same)
    assert len(tree.span) == 1
    zero = CoverTree(np.arange(300), np.zeros(300, int), np.zeros((300, 2)))
    assert [span for span in zero.leaves(np.array([1.0, 2.0]), lambda low, high: high >= 0)] == [(0, 300)]


def test_rows_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.4, 0.1], 2), (3, None, 2), (4, [float("nan"), 1.0], 2),
        (5, [0.45, 0.0], None), (6, [], 3), (None, [0.4, 0.0], 2), (7, [0.475, 3.0], 2), (8, [0.25], 2),
        (2, [0.4, 0.1], 2), (9, [-1.0, 0.0], 4), (10, [-0.5, 0.0], 4),
    ]
    wide = spark.createDataFrame([(i, e, k, "x", 7, "r", 1) for i, e, k in rows], SCHEMA)
    frame = integer_vectors(wide.where("label is not null"), 256, "label")
    known = {r.vec_id: (r.vector, r.label) for r in frame.collect()}
    assert set(known) == {0, 1, 2, 6, 7, 8, 9, 10}
    got = mined(frame, 1)
    assert got == plain(known, list(known))
    assert {r[3] for r in got if r[0] == 0} == {2, 7, 8}  # 50 % and 95 % are inside
    # An anchor alone with its label, and positives with negative scores, give nothing.
    assert not [r for r in got if r[0] in (6,)]
    assert mined(frame.limit(0), 1) == set()


def test_query_against_every_score(spark):
    from .conftest import SF_DIR

    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = {}
    for r in table.collect():
        if r.label is not None and r.embedding is not None:
            label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
            rows[r.vec_id] = ([int(np.floor(256 * x)) for x in r.embedding], label)
    got = {tuple(r) for r in QUERIES["op11_hard_negatives"](spark, SF_DIR).collect()}
    assert got == plain(rows, [i for i in rows if i % 50 == 0])
