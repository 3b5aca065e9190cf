"""Clustering against plain rounds over all distances."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.centroids import VantageTree, cluster
from tidemark.llm.queries import QUERIES


def first():
    return F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)


def nearest(vector, centroids):
    return min((sum((a - b) ** 2 for a, b in zip(vector, c)), k) for k, c in enumerate(centroids))


def plain(rows, many, rounds):
    """Rows are a list of (id, vector); gives the rows' (id, cluster, distance) and the centroids."""

    def order(row):
        if row[0] is None:
            return (1, "", 0, row[1])
        return (0, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest(), row[0], row[1])

    centroids = [list(v) for _, v in sorted(rows, key=order)[:many]]
    for _ in range(rounds):
        groups = {}
        for _, v in rows:
            groups.setdefault(nearest(v, centroids)[1], []).append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else c for k, c in enumerate(centroids)]
    found = [(i, *reversed(nearest(v, centroids))) for i, v in rows]
    return sorted(found, key=repr), centroids


def clustered(spark, rows, many, rounds, width):
    found = cluster(spark.createDataFrame(rows, "vec_id bigint, vector array<int>"), first(), many, rounds, width)
    return sorted([tuple(r) for r in found.assigned().collect()], key=repr), found.centroids.tolist()


@pytest.mark.parametrize("many", [1, 2, 8, 23])
def test_against_plain_rounds(spark, many):
    rng = random.Random(many)
    rows = [(i, [rng.randint(-6, 6) for _ in range(3)]) for i in range(400)]  # many ties
    rows += [(i, rows[3][1]) for i in range(400, 460)]
    assert clustered(spark, rows, many, 6, 3) == plain(rows, many, 6)


def test_ties_repeats_and_empty_clusters(spark):
    # Equal starting centroids: the smaller number gets all, the others stay empty where they are.
    rows = [(i, [5, -5]) for i in range(6)] + [(6, [-7, 3]), (6, [-7, 3]), (None, [1, 1]), (9, [-8, -8])]
    assert clustered(spark, rows, 4, 3, 2) == plain(rows, 4, 3)
    assert clustered(spark, rows, 50, 3, 2) == plain(rows, 50, 3)  # more centroids than vectors
    assert clustered(spark, [], 4, 3, 2) == ([], [])


def test_too_many_centroids_are_refused(spark):
    with pytest.raises(ValueError, match="too many"):
        cluster(spark.createDataFrame([], "vec_id bigint, vector array<int>"), first(), 1 << 20, 1, 64)


def test_tree_takes_the_smaller_number_at_equal_distance():
    rng = np.random.default_rng(2)
    centroids = rng.integers(-3, 4, (60, 4))
    centroids[40:50] = centroids[:10]
    rows = rng.integers(-4, 5, (3000, 4))
    clusters, squares = VantageTree(centroids).nearest(rows)
    every = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (squares == every.min(axis=1)).all()
    assert (clusters == every.argmin(axis=1)).all()


def test_query_on_rows_that_take_no_part(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)], 1) for i in range(40)]
    odd = [(50, None, 1), (51, [], 1), (52, [0.5] * 63, 1), (53, [0.5] * 65, 1)]
    odd += [(54, [float("nan")] * 64, 1), (55, [None] + [0.1] * 63, 1), (56, [float("inf")] * 64, 1)]
    schema = "vec_id bigint, embedding array<float>, label int"
    spark.createDataFrame(rows + odd, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op13_centroids"](spark, str(tmp_path)).collect()
    kept = spark.read.parquet(str(tmp_path / "embeddings.parquet")).where("vec_id < 50").collect()
    want, centroids = plain([(r.vec_id, [int(np.floor(1024 * x)) for x in r.embedding]) for r in kept], 8, 10)
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=repr) == want
    assert {r.inertia for r in got} == {sum(d for _, _, d in want)}
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert QUERIES["op13_centroids"](spark, str(tmp_path / "none")).collect() == []
