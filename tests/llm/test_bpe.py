from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perkflow.llm import bpe
from perkflow.llm.queries import QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN
RANK = bpe.load_ranks(public_tokenizers.path(RANKS))
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANK, special_tokens={})


def digests(text):
    ids = np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()
    data = (text or "").encode()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(data).hexdigest()


def test_query_equals_the_library(spark, sf_dir):
    rows = QUERIES["op8_bpe"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(texts[row.doc_id])


TEXTS = [
    None, "", " ", "\n\n  x", "it's we'll 'S", "don’t", "a" * 5000, " " * 3000 + "b", "é́中文\U0001f600",
    "  x　y\u0085z", "tab\t\r\nend ", "0123456789" * 30, "<|endoftext|>", "word " * 20_000, "\x00\x01",
    "abcDEFghi" * 700,
]


def test_edge_cases(spark, make_docs):
    docs = make_docs([(i, t, None) for i, t in enumerate(TEXTS)] + [(None, "x", None), (1, "", None)])
    rows = bpe.digests(bpe.encode(docs, RANK, PATTERN), RANK).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = "x" if row.doc_id is None else TEXTS[row.doc_id]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(text), text
    assert bpe.digests(bpe.encode(docs.limit(0), RANK, PATTERN), RANK).count() == 0


def test_spark_folds_like_the_library(spark):
    words = [" thndandere", "Äußerung", "zzzzz", " 中文字", "'''''", "Q", " inter", "\x00\x01", "é"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    folded = frame.select("word", bpe.fold_merges(F.col("word"), bpe.rank_literal(RANK)).alias("ids"))
    for row in folded.collect():
        # The library takes a word that is a token as it is; so does the operator, before folding.
        if row.word.encode() not in RANK:
            assert row.ids == LIBRARY.encode_ordinary(row.word), row.word


def test_decoding_concatenates_pieces(spark):
    frame = spark.createDataFrame([([0, 50255, 1000],), ([],)], "ids array<int>")
    by_rank = {rank: piece for piece, rank in RANK.items()}
    found = [bytes(r.d) for r in frame.select(bpe.decode(F.col("ids"), RANK).alias("d")).collect()]
    assert found == [by_rank[0] + by_rank[50255] + by_rank[1000], b""]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text("abcdefgh xyz", min_size=1, max_size=80), st.text(max_size=30), st.binary(max_size=100).map(lambda b: b.decode("latin-1"))))
def test_merging_words_like_the_library(text):
    if text and text.isascii() and text.isalpha():  # one match of the pattern
        assert bpe.merge(text.encode(), RANK) == LIBRARY.encode_ordinary(text)
    data = text.encode()
    if data and data not in RANK and len(data) > 1:
        assert bpe._merge_long(data, RANK) == bpe.merge(data[: bpe.LONGEST], RANK) if len(data) <= bpe.LONGEST else True


def test_bounded_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "_CACHE", 2)
    known = bpe._Words(RANK, {})
    for word in (" abcx", " defx", " ghix", " abcx"):
        assert np.frombuffer(known[word], "<u4").tolist() == LIBRARY.encode_ordinary(word)
        known.limit()
    assert len(known) <= 3


@pytest.mark.parametrize("share", [2e-6, 0.2])
def test_the_share_of_common_words_changes_nothing(spark, make_docs, monkeypatch, share):
    monkeypatch.setattr(bpe, "COMMON", share)
    docs = make_docs([(1, "blorptang blorptang quizzlewump the of", None), (2, "blorptang", None)])
    rows = bpe.digests(bpe.encode(docs, RANK, PATTERN), RANK).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {
        1: len(LIBRARY.encode_ordinary("blorptang blorptang quizzlewump the of")),
        2: len(LIBRARY.encode_ordinary("blorptang"))}
