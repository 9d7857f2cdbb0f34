from __future__ import annotations

import math

import numpy as np
import pytest

from perkflow.llm import embedding_dedup
from perkflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def brute(rows):
    """(vec_id, n_links, component_id) from all pairs."""
    ids = [i for i, _ in rows]
    unit = np.stack([np.asarray(v, np.float64) / np.linalg.norm(v) for _, v in rows])
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        new = np.array([min(label[i], label[row].min() if row.any() else label[i]) for i, row in enumerate(linked)])
        if (new == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), label)}
        label = new


def clusters(rng, sizes, dim=32, noise=0.02):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        rows += [centre + noise * rng.standard_normal(dim) for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(i), np.float32(rows[i]).tolist()) for i in order]


def test_query_links_only_true_pairs_and_most_of_them(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{big}/embeddings.parquet").collect()]
    truth = brute(rows)
    found = QUERIES["op6_embedding_dedup"](spark, big).collect()
    assert len(found) == len(rows)
    assert all(r.n_links <= truth[r.vec_id][0] and r.kept == (r.vec_id == r.component_id) for r in found)
    assert sum(r.n_links for r in found) >= 0.9 * sum(n for n, _ in truth.values())


def test_clusters_and_a_large_one(spark):
    rng = np.random.default_rng(3)
    rows = clusters(rng, [300, *[3] * 60, *[1] * 200])
    truth, found = brute(rows), embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    links = sum(r.n_links for r in found)
    assert links >= 0.9 * sum(n for n, _ in truth.values())
    assert all(r.n_links <= truth[r.vec_id][0] for r in found)
    assert np.mean([r.component_id == truth[r.vec_id][1] for r in found]) > 0.98


def test_windows_go_on_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "WINDOW", 4)
    rng = np.random.default_rng(4)
    rows = clusters(rng, [2] * 150, noise=0.01)
    found = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert {r.n_links for r in found} == {1}


def test_edge_cases(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one), (2, one), (2, one), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0] * 3), (7, [1.0, None, 2.0]),
            (8, [1.0, math.nan, 2.0]), (9, [math.inf, 1.0, 1.0]), (10, [1.0, 2.0]), (None, one), (11, [-1.0, -2.0, -3.0]),
            (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30])]
    out = embedding_dedup.near_duplicates(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = sorted(map(tuple, out.collect()), key=repr)
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)]
    near = [(1, 6, 1, True), (2, 6, 1, False), (2, 6, 1, False), (3, 6, 1, False), (12, 6, 1, False), (13, 6, 1, False)]
    near.append((None, 6, 1, False))  # a row without id is a vector like others
    assert found == sorted(alone + near, key=repr)
    assert len(found) == len(rows)
    assert embedding_dedup.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("cosine", [0.9499, 0.9501])
def test_threshold_in_double_precision(spark, cosine):
    rows = [(1, [1.0, 0.0]), (2, [cosine, math.sqrt(1 - cosine**2)])]
    frame_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.n_links for r in embedding_dedup.near_duplicates(frame_).collect()} == {int(cosine >= 0.95)}


@pytest.mark.parametrize("noise", [0.01, 0.2])
def test_tight_and_loose_clusters_larger_than_all_windows_keep_all_links(spark, noise):
    rng = np.random.default_rng(6)
    rows = clusters(rng, [4500, *[1] * 50], noise=noise)
    unit = np.stack([np.asarray(v, np.float64) / np.linalg.norm(v) for _, v in rows])
    truth = {i: int(n) - 1 for (i, _), n in zip(rows, (unit @ unit.T >= 0.95).sum(axis=1))}
    found = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows) and all(r.n_links <= truth[r.vec_id] for r in found)
    assert sum(r.n_links for r in found) >= 0.999 * sum(truth.values()) > 0.4 * 4500**2


def test_passes_grow_with_the_table():
    assert embedding_dedup.passes(10_000) == 16 < embedding_dedup.passes(10**6) < embedding_dedup.passes(10**8)


def test_rows_that_repeat_an_id_with_other_vectors_keep_both(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0])]
    found = embedding_dedup.near_duplicates(frame(spark, rows)).collect()
    assert [r.n_links for r in found] == [1] * 4
