from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkflow.llm import vector_topk
from perkflow.llm.queries import op13_vector_topk

SCHEMA = "vec_id long, embedding array<float>, label int, query int, row long, score long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], SCHEMA)


def brute_force(rows, k=5, every=50):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (query, v) in enumerate(kept):
        if query is None or query % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i)
                  for n, (i, w) in enumerate(kept) if n != at and len(w) == len(v)]
        out += [(query, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    got = vector_topk.search(frame(spark, rows).repartition(6), F.col("vec_id") % 50 == 0, 5, **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("queries", [4096, 3])
def test_equals_brute_force(spark, queries):
    """Also over several blocks of queries and with partial scores of both signs."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.1, 64).tolist()) for i in range(600)]
    assert found(spark, rows, queries=queries) == brute_force(rows)


def test_ties_and_a_very_common_vector(spark):
    """A query has hundreds of best scores; the smallest ids win."""
    rng = np.random.default_rng(5)
    same = rng.normal(0, 0.1, 64).tolist()
    rows = [(i, same if i % 3 else rng.normal(0, 0.1, 64).tolist()) for i in range(500)]
    rows += [(50, same), (50, same), (None, same), (700, [-x for x in same])]
    assert found(spark, rows) == brute_force(rows)


def test_few_values(spark):
    """Small integers: nearly all scores tie with others."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-1, 2, 6) / 256).tolist()) for i in range(300)]
    assert found(spark, rows) == brute_force(rows)


def test_edge_cases(spark):
    good = [0.25, -0.5, 1.0]
    rows = [
        (0, good), (50, None), (100, []), (1, []), (150, [None, 1.0, 2.0]), (200, [float("nan"), 1.0, 0.0]),
        (250, [float("inf"), 1.0, 0.0]), (300, [0.5]), (2, good), (3, [0.0, 0.0, 0.0]), (350, [0.1] * 7), (None, good),
    ]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == []
    assert found(spark, [(50, good)]) == []
    with pytest.raises(ValueError, match="53 bits"):
        found(spark, [(50, [1e9, 1.0])])


def test_float64_where_float32_is_too_short(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 90, 64).tolist()) for i in range(120)]
    assert found(spark, rows) == brute_force(rows)


def test_the_uniform_threshold_keeps_what_can_reach_the_cutoff_and_drops_others():
    rng = np.random.default_rng(9)
    vectors = np.floor(256 * rng.normal(0, 0.125, (3000, 64)))
    block = vector_topk.Block(np.arange(20), vectors[:20] + 1)
    scores, _ = block.parts(slice(0, 20), vectors, np.arange(3000) + 5000)
    total = scores.sum(axis=0)
    cut = np.sort(total, axis=1)[:, -5]
    query, vector = vector_topk.reaching(scores, cut, scores.min(axis=2).T)
    kept = set(zip(query.tolist(), vector.tolist()))
    assert {(q, v) for q, v in zip(*np.nonzero(total >= cut[:, None]))} <= kept
    assert len(kept) < 0.5 * total.size  # random vectors, the worst case


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in op13_vector_topk(spark, sf_dir).collect()), key=repr) == brute_force(rows)
