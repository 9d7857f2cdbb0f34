from __future__ import annotations

import ast
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from perkflow.llm import bpe, decontamination, language, ngram_join, toxicity
from perkflow.llm.queries import QUERIES, RANKS
from tests.llm.conftest import sentence

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture
def tables(spark, make_docs, tmp_path, rng):
    """Documents with every case that a stage has to catch, and the tables beside them."""
    rows = []
    for i in range(300):
        bad = [rng.choice(["idiot", "moron", "stupid"])] * 3 if i % 5 == 0 else ()
        rows.append((i, sentence(rng, 60, bad), "en"))
    item = sentence(rng, 30)
    near = rows[1][1].split()
    near[30] = "changed"
    rows += [(1001, rows[1][1], "en"), (1002, " ".join(near), "en"), (1003, f"{sentence(rng, 40)} {item} {sentence(rng, 20)}", "en"),
             (1004, "12 34 !!", None), (1005, None, None), (1006, "", None), (2, rows[2][1], "en"), (None, sentence(rng, 50), "en")]
    folder = str(tmp_path)
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_each_stage_takes_what_it_should_and_no_more(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
        steps[name] = sorted((r.doc_id for r in docs.collect()), key=repr)
        assert name == "bpe" or docs.columns == columns
    toxic = {i for i in range(0, 300, 5)}
    clean = [i for i, _, _ in rows if i not in toxic]
    assert steps["toxicity"] == sorted(clean, key=repr)
    told = [i for i in clean if i not in (1004, 1005, 1006)]
    assert steps["language"] == sorted(told, key=repr)
    first = [i for i in told if i not in (1001, 1002)]
    first.remove(2)  # the row that was there twice
    assert steps["near_duplicates"] == sorted(first, key=repr)
    last = [i for i in first if i != 1003]
    assert steps["decontamination"] == steps["bpe"] == sorted(last, key=repr)


def test_the_language_stage_fills_in_languages_and_can_choose(spark, tables, monkeypatch):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    found = corpus_pipeline.drop_unknown_language(spark, docs, folder)
    assert {r.lang for r in found.collect()} == {"en"} and found.columns == docs.columns
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ["fr"])
    assert corpus_pipeline.drop_unknown_language(spark, docs, folder).count() == 0


def test_run_equals_the_operators_by_hand(spark, sf_dir):
    """The stages over the given tables, from the operators' own results."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {i: t for i, t in kept.items() if toxicity.probability(model, t, {}) < 0.5}

    def left():
        return docs.filter(docs.doc_id.isin(list(kept)))

    found = language.identify(left(), language.train(left())).collect()
    kept = {r.doc_id: kept[r.doc_id] for r in found if r.lang_pred != "und"}
    found = ngram_join.similarity_join(left()).collect()
    kept = {r.doc_id: kept[r.doc_id] for r in found if r.doc_id == r.class_id}
    leaks = decontamination.contamination(left(), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()
    kept = {i: t for i, t in kept.items() if i not in {r.doc_id for r in leaks}}
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    wanted = bpe.digests(bpe.encode(left(), ranks, public_tokenizers.PATTERN), ranks).collect()
    rows = corpus_pipeline.run(spark, sf_dir)
    got = rows.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    assert all(len(r.ids) == r.n_tokens for r in rows.collect())


def test_empty_tables(spark, make_docs, tmp_path):
    folder = str(tmp_path)
    make_docs([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_there_is_a_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "bpe"]


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("perkflow/**/*.py"), *ROOT.glob("checks/*.py"), *ROOT.glob("*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" in path.parts or path.name in ("corpus_pipeline.py", "__spark_entry__.py"):
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not [n for n in names if "llm" in n.split(".")], path
