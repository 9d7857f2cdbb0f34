"""Documents to token ids: toxicity, language, near duplicates, benchmark leaks, BPE.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before kept and returns the
columns of documents; the last one adds the ids. Stages are written as Parquet in the shared scratch
folder and read again, so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm import bpe, decontamination, language, ngram_join, toxicity
from perkflow.llm.common import read_table
from perkflow.llm.queries import RANKS
from perkflow.sources.scratch import materialise

#: Languages whose documents stay; None for all that the table's labels name.
LANGUAGES: list[str] | None = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more; the model learns from the labelled ones."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(spark, model)(F.col("text")) < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of no language or of one not in LANGUAGES; a missing `lang` is filled in.

    A table without any labelled language keeps all its documents.
    """
    model = language.train(docs)
    if not model.languages:
        return docs
    key = "found_language"
    while key in docs.columns:
        key += "_"
    told = docs.withColumn(key, language.identify_column(spark, model)(F.col("text"))["lang_pred"])
    told = told.filter(F.col(key).isin(LANGUAGES or model.languages))
    return told.withColumn("lang", F.coalesce("lang", key)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return ngram_join.first_of_each_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a benchmark item is found."""
    return decontamination.uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the whole text, their number and the digests of ids and decoded bytes."""
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    coded = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, ["doc_id"])
    return coded.select(
        "doc_id",
        F.col("tokens.ids").alias("ids"),
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(F.col("tokens.packed"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("tokens.ids"), ranks), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: Learned models, posterior pruning and BPE cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
