from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from perkflow.llm import toxicity
from perkflow.llm.queries import QUERIES
from tests.llm.conftest import sentence

BAD = ["idiot", "moron", "stupid", "worthless", "disgusting"]


@pytest.fixture(scope="module")
def model():
    import random

    rng = random.Random(1)
    texts = [sentence(rng, rng.randint(20, 200), [rng.choice(BAD)] * 2 if i % 4 == 0 else ()) for i in range(600)]
    return toxicity.fit(texts, [int(i % 4 == 0) for i in range(600)])


def scores(model, texts):
    return [toxicity.probability(model, t, {}) for t in texts]


def test_finds_unseen_misspellings_and_leaves_clean_texts(model, rng):
    clean = [sentence(rng, n) for n in (10, 50, 300, 2000)]
    assert max(scores(model, clean)) < 0.5
    for word in [*BAD, "idioot", "stupidd", "worthles", "disgustingg"]:
        assert min(scores(model, [sentence(rng, n, [word] * 2) for n in (15, 60)])) > 0.5, word
    assert scores(model, [sentence(rng, 5000) + " stupid idiot"])[0] > 0.5  # in a very long text


def test_empty_texts_and_missing_classes(model):
    assert max(scores(model, [None, "", "  ...", "!!"])) < 0.5
    one_class = toxicity.fit(["a b", "c d"], [1, 1])
    assert scores(one_class, ["a", None])[0] < 0.01
    assert scores(toxicity.fit([], []), ["a"])[0] < 0.01


def test_cache_bound_does_not_change_scores(model, rng, monkeypatch):
    texts = [sentence(rng, 100) for _ in range(5)]
    wanted = scores(model, texts)
    monkeypatch.setattr(toxicity, "_CACHE", 7)
    assert scores(model, texts) == wanted


def test_columns_nulls_repeats_and_empty_tables(spark, make_docs, model):
    docs = make_docs([(1, "a stupid idiot", "en"), (1, "a stupid idiot", "en"), (None, None, None), (2, "", "x")])
    rows = toxicity.score(docs, model).collect()
    assert sorted((r.doc_id is None, r.predicted) for r in rows) == [(False, 0), (False, 1), (False, 1), (True, 0)]
    assert toxicity.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(None, 1, 1), (1, None, None), (7, 0, 5)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels).bias == toxicity.train(docs.limit(0), labels.limit(0)).bias == -50.0


def test_query_learns_and_holds_out(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES["op10_toxicity"](spark, big).toPandas()
    docs = spark.read.parquet(f"{big}/documents.parquet")
    assert len(rows) == docs.count()
    fold = rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (rows.held_out == fold).all() and rows.score.between(0, 1).all()
    marked = rows[fold].merge(spark.read.parquet(f"{big}/labels.parquet").toPandas(), on="doc_id")
    assert np.mean(marked.predicted == marked.toxic) > 0.9


def test_sample_is_bounded_and_skips_the_held_out_fold(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    rows = toxicity.training_rows(docs, labels, per_class=20).collect()
    assert sum(r._toxic for r in rows) == 20 and len(rows) == 80
    assert all(zlib.crc32(r.text.encode()) % 5 for r in rows)


def test_repeated_ids_and_long_texts_do_not_enlarge_the_sample(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("bad "), F.col("id").cast("string")).alias("text"))
    docs = docs.union(docs).union(spark.range(1, 60).select("id", F.repeat(F.lit("x" * 9 + " "), 200)))
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    rows = toxicity.training_rows(docs, labels, per_class=10).collect()
    assert len(rows) <= 40 and len({(r.doc_id, r.text) for r in rows}) == len(rows)
    rows = toxicity.training_rows(docs, labels, per_class=1000, most_bytes=9_000).collect()
    assert 0 < sum(len(r.text) for r in rows) <= 9_000
