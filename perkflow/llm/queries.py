"""One query per operator of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm import (
    bpe,
    centroid_clusters,
    decontamination,
    embedding_dedup,
    html_text,
    language,
    license_scan,
    lm_scoring,
    ngram_join,
    prefix_trie,
    toxicity,
    vector_topk,
    warc,
)
from perkflow.llm.common import bucket_of, read_table
from perkflow.llm.oracle import SQL

Query = Callable[[SparkSession, str], DataFrame]
RANKS = "byte_bpe_50k.tiktoken"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled of good quality. Losses are rounded, so that engines agree on them."""
    documents = read_table(spark, sf_dir, "documents")
    target = read_table(spark, sf_dir, "labels").filter("quality = 1")
    scored = lm_scoring.score(documents, lm_scoring.train(documents, target))
    return scored.withColumns({name: F.round(name, 6) for name in ("loss_target", "loss_background", "ce_diff")})


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(read_table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return decontamination.contamination(documents, read_table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    found = language.identify(documents, language.train(documents))
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(documents, ranks, public_tokenizers.PATTERN, ["doc_id"]), ranks)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = toxicity.train(documents, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(bucket_of(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = toxicity.score(documents, model).withColumn("held_out", held_out)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = prefix_trie.rebuilt_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(rebuilt).select(prefix_trie.COLUMNS)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = centroid_clusters.cluster(read_table(spark, sf_dir, "embeddings"))
    return centroid_clusters.with_totals(spark, found, centroids)


def op13_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


QUERIES: dict[str, Query] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_ngram_join": op2_ngram_join,
    "op3_html_text": op3_html_text,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_bpe": op8_bpe,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_vector_topk": op13_vector_topk,
}

__all__ = ["QUERIES", "RANKS", "SQL"]
