from __future__ import annotations

import hashlib

import numpy as np
import pytest

from perkflow.llm import centroid_clusters as cc
from perkflow.llm.queries import op12_centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance long, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "v") for i, v in rows], SCHEMA)


def brute_force(rows, k=16, rounds=3):
    """All distances to all centroids with Python integers."""
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centroids = [v for _, v in start[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        return [(row.index(min(row)), min(row)) for row in far]

    for _ in range(rounds):
        labels = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (label, _) in zip(kept, labels) if label == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    labels = assign()
    inertia = {c: sum(d for label, d in labels if label == c) for c, _ in labels}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (c, d) in zip(kept, labels))


def clustered(spark, rows):
    vectors = frame(spark, rows)
    return sorted(tuple(r) for r in cc.with_totals(spark, *cc.cluster(vectors)).collect())


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_nearest_equals_all_distances_with_ties(spread):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread + 1, (16, 8))
    centroids[5] = centroids[2]
    vectors = rng.integers(-spread, spread + 1, (500, 8))
    label, distance = cc.Lists(centroids).nearest(vectors)
    far = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
    assert (label == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_the_walk_stops_early():
    """A vector beside one of many far centroids is settled before all lists are walked."""
    rng = np.random.default_rng(1)
    centroids = rng.permuted(np.arange(0, 64_000, 1000)[:, None] + np.zeros((64, 4), int), axis=0)
    lists = cc.Lists(centroids)
    steps = []
    lists.centroids = Counted(centroids, steps)
    label, distance = lists.nearest(centroids + 1)
    assert (label == np.arange(64)).all() and (distance == 4).all()
    assert sum(steps) < 64 * 64 / 4


class Counted:
    """The centroids, counting the rows that are compared exactly."""

    def __init__(self, rows, steps):
        self.rows, self.steps, self.shape = rows, steps, rows.shape

    def __getitem__(self, at):
        self.steps.append(len(at))
        return self.rows[at]


def test_large_components_are_exact():
    top = cc.LIMIT
    centroids = np.array([[top] * 64, [-top] * 64, [top - 1] * 64])
    label, distance = cc.Lists(centroids).nearest(np.array([[-top] * 64, [top - 1] * 64, [-top + 1] * 64]))
    assert label.tolist() == [1, 2, 1] and distance.tolist() == [0, 0, 64]


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(i % 7, 0.4, 64).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # one very common vector
    rows += [(5, rng.normal(0, 1, 64).tolist()), (5, rows[5][1])]  # repeated ids
    assert clustered(spark, rows) == brute_force(rows)


def test_edge_cases(spark):
    good = [0.5] * 64
    rows = [
        (1, good), (2, None), (3, []), (4, good[:63]), (5, good + [1.0]), (6, [None] + good[1:]),
        (7, [float("nan")] + good[1:]), (8, [float("-inf")] + good[1:]), (9, [-0.001] * 64), (1, good),
    ]
    assert clustered(spark, rows) == brute_force(rows)
    assert {r[0] for r in clustered(spark, rows)} == {1, 9}
    assert clustered(spark, []) == [] == clustered(spark, [(1, None)])
    with_null = clustered_ids(spark, [(None, good), (3, good)])
    assert with_null == [None, 3]
    with pytest.raises(Exception, match="vec_id 3"):
        clustered(spark, [(3, [3e6] * 64)])


def clustered_ids(spark, rows):
    found = cc.with_totals(spark, *cc.cluster(frame(spark, rows))).collect()
    return sorted((r.vec_id for r in found), key=lambda i: (i is not None, i))


def test_vectors_do_not_move(spark, sf_dir):
    """A round shuffles sums, one row per task, cluster and dimension."""
    table = cc.kept_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    found = cc.assigned(table, np.zeros((16, 64), np.int64))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op12_centroid_clusters(spark, sf_dir).collect()) == brute_force(rows)
