"""MaxScore search against every score."""

import random

from pyspark.sql import functions as F

from tidemark.llm.queries import QUERIES
from tidemark.llm.topk import top_k
from tidemark.llm.vectors import integer_vectors

#: An embeddings table with columns named like internal ones.
SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, _tile int, _role string, _row int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, e, None, "x", 7, "r", 1) for i, e in rows], schema)


def plain(vectors, queries, k):
    """Every query against all other vectors, {id: list of ints}."""
    rows = set()
    for q in queries:
        scores = [(-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q]
        rows |= {(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return rows


def searched(frame, divisor, k, **sizes):
    rows = top_k(frame, F.col("vec_id") % divisor == 0, k, **sizes).collect()
    assert len(rows) == len({(r.query_id, r.rank) for r in rows})
    return {tuple(r) for r in rows}


def test_against_every_score_over_many_tiles(spark):
    rng = random.Random(5)
    vectors = {}
    for i in range(700):
        if i % 3 == 0:  # sparse, so that posting lists are short and some vectors meet no essential one
            v = [rng.choice((0, 0, 0, 0, 0, 0, 0, rng.randint(-9, 9))) for _ in range(16)]
        elif i % 3 == 1:
            v = [rng.randint(-40, 40) for _ in range(16)]
        else:  # few values, many equal scores
            v = [rng.choice((-1, 0, 1)) for _ in range(16)]
        vectors[i] = v
    for i in range(700, 760):  # copies
        vectors[i] = vectors[rng.randrange(50)]
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, vector array<int>")
    want = plain(vectors, [i for i in vectors if i % 4 == 0], 7)
    assert searched(frame, 4, 7) == want
    assert searched(frame, 4, 7, shard_rows=90, block_rows=40) == want


def test_segments_raise_the_threshold(spark, monkeypatch):
    from tidemark.llm import topk

    rng = random.Random(6)
    ids = list(range(300))
    rows = [[rng.randint(-20, 20) for _ in range(8)] for _ in ids]
    vectors = dict(zip(ids, rows))
    import numpy as np

    found = (np.empty(0), np.empty(0, np.int64))
    for at in range(0, 300, 25):
        segment = topk.Postings(np.array(ids[at : at + 25]), np.array(rows[at : at + 25], float))
        found = segment.search(8, np.array(vectors[8], float), 5, found)
    assert {(8, n, int(i), int(s)) for n, (s, i) in enumerate(zip(*found), 1)} == plain(vectors, [8], 5)


def test_vectors_that_take_no_part_and_short_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (1, [0.5]), (2, []), (3, None), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (None, [1.0, 1.0]), (7, [-1.0, -1.0, 9.0]), (0, [1.0, 0.5]), (0, [2.0, 2.0]), (8, [-0.01, 0.26]),
    ]
    frame = integer_vectors(table(spark, rows), 4)
    vectors = {r.vec_id: r.vector for r in frame.collect()}
    assert vectors == {0: [4, 2], 1: [2], 2: [], 7: [-4, -4, 36], 8: [-1, 1]}
    assert searched(frame, 1, 3) == plain(vectors, list(vectors), 3)
    assert searched(frame, 1, 20, shard_rows=2, block_rows=2) == plain(vectors, list(vectors), 20)


def test_none_and_one(spark):
    none = integer_vectors(table(spark, []), 64)
    assert searched(none, 1, 5) == set()
    one = integer_vectors(table(spark, [(20, [1.0])]), 64)
    assert searched(one, 20, 5) == set()


def test_query_against_every_score(spark):
    from .conftest import SF_DIR

    rows = {tuple(r) for r in QUERIES["op12_topk"](spark, SF_DIR).collect()}
    whole = integer_vectors(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), 64)
    vectors = {r.vec_id: r.vector for r in whole.collect()}
    assert rows == plain(vectors, [i for i in vectors if i % 20 == 0], 20)
