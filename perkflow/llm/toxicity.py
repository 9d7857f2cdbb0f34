"""Toxicity: averaged subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed character n-grams, so a misspelling that was never
seen still shares most of its vectors with the word it stands for. A segment of `SEGMENT` words is
the mean of its words, and a softmax over two classes reads it. A text is as toxic as its most toxic
segment: a few bad words in a very long text are not averaged away. Embeddings and softmax learn
together from that maximum.

Defined results: null and empty texts have no words and score softmax(bias); a table without labels
of both classes gives the model that scores every text 0.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm.common import bounded_texts, bucket_of, learned

SEGMENT = 16
SCALE = 32.0  # of the mean, so that one word among SEGMENT can decide
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIM = 8
_WORD = re.compile(r"[^\W_]+")
_CACHE = 300_000


@dataclass(frozen=True)
class Model:
    """Score of each n-gram bucket (its vector times the softmax weights) and the bias."""

    scores: np.ndarray
    bias: float


def subwords(word: str) -> list[int]:
    """Buckets of the whole word and of its character n-grams, with marked ends."""
    marked = f"<{word}>"
    found = [marked]
    for n in GRAMS:
        found += [marked[i : i + n] for i in range(len(marked) - n + 1)] if n < len(marked) else []
    return [zlib.crc32(gram.encode()) % BUCKETS for gram in found]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)


def fit(
    texts: list[str], toxic: list[int], rounds: int = 80, rate: float = 3.0, decay: float = 1e-3,
    least_z: float = 4.0,
) -> Model:
    """Embeddings (buckets x DIM) and softmax weights by gradient descent with momentum.

    Labels may be noisy. Plain gradients move what many texts agree on much faster than what one text
    could be told by; only buckets whose share of toxic texts differs from the rest by `least_z`
    standard errors take part, starting from their log odds; vectors decay, and every fifth text only
    measures the loss: the round that did best there is the result.
    """
    none = Model(np.zeros(BUCKETS, np.float32), -50.0)
    index: dict[str, int] = {}
    docs = [
        np.fromiter((index.setdefault(w, len(index)) for w in _WORD.findall(t.lower())), np.int32)
        for t in texts
    ]
    y = np.asarray([label for label, doc in zip(toxic, docs) if len(doc)], np.float64)
    docs = [doc for doc in docs if len(doc)]
    if not len(y) or y.min() == y.max():
        return none
    flat, sizes = array("i"), array("i")
    for word in index:
        found = subwords(word)
        flat.extend(found)
        sizes.append(len(found))
    words = len(index)
    index.clear()
    gram_ids, gram_n = np.frombuffer(flat, np.int32), np.frombuffer(sizes, np.int32)
    gram_at = _starts(gram_n)
    seen = np.zeros((2, BUCKETS))
    for doc, label in zip(docs, y):
        own = np.unique(doc)
        n = gram_n[own]
        at = np.repeat(gram_at[own] - _starts(n), n) + np.arange(n.sum())
        seen[int(label), np.unique(gram_ids[at])] += 1
    size = np.array([[(y == 0).sum()], [(y == 1).sum()]])
    share = (seen.sum(axis=0) + 1) / (len(y) + 2)
    z = (seen[1] / size[1] - seen[0] / size[0]) / np.sqrt(share * (1 - share) * (1 / size).sum())
    live_bucket = np.abs(z) >= least_z
    odds = np.log((seen + 0.5) / (size - seen + 0.5))
    start = np.where(live_bucket, odds[1] - odds[0], 0) / 4
    # Only the n-grams that take part are kept; the mean of a word is over all of its n-grams.
    word_of = np.repeat(np.arange(words, dtype=np.int32), gram_n)[live_bucket[gram_ids]]
    gram_ids = gram_ids[live_bucket[gram_ids]]
    live_n = np.bincount(word_of, minlength=words)
    live_at = _starts(live_n)
    tokens, doc_n = np.concatenate(docs), np.array([len(doc) for doc in docs])
    parts = -(-doc_n // SEGMENT)
    doc_of, doc_at = np.repeat(np.arange(len(docs)), parts), _starts(parts)
    nth = np.arange(len(doc_of)) - doc_at[doc_of]
    seg_n = np.minimum(SEGMENT, doc_n[doc_of] - nth * SEGMENT)
    seg_at = _starts(seg_n)
    rng = np.random.default_rng(7)
    # Two softmax columns of which only the difference matters; kept as one vector and one bias.
    weights = rng.choice([-1.0, 1.0], DIM) / np.sqrt(DIM)
    table = start[:, None] * weights
    table += np.where(live_bucket[:, None], rng.normal(0, 0.01, (BUCKETS, DIM)), 0)
    used = np.flatnonzero(np.bincount(gram_ids, minlength=BUCKETS).astype(bool) & live_bucket)
    bias = float(np.log(y.mean() / (1 - y.mean())))
    teach = np.arange(len(docs)) % 5 > 0
    push, pull, drift = np.zeros((len(used), DIM)), np.zeros(DIM), 0.0
    best, best_loss = none, np.inf
    for step in range(1, rounds + 1):
        bucket_score = table @ weights
        word_score = np.bincount(word_of, bucket_score[gram_ids], words) / gram_n
        seg_score = SCALE * np.add.reduceat(word_score[tokens], seg_at) / seg_n
        top = np.maximum.reduceat(seg_score, doc_at)
        prob = 1 / (1 + np.exp(-np.clip(top + bias, -30, 30)))
        loss = -np.log(np.where(y > 0, prob, 1 - prob) + 1e-9)
        measured = loss[~teach].mean() if len(y) >= 50 else loss.mean()
        if measured < best_loss:
            best_loss, best = measured, Model(bucket_score.astype(np.float32), float(bias))
        is_top = np.flatnonzero((seg_score == top[doc_of]) & teach[doc_of])
        chosen = is_top[np.unique(doc_of[is_top], return_index=True)[1]]
        slope = ((prob - y) / teach.sum())[doc_of[chosen]]
        # Back to the words of the chosen segments, then to their buckets.
        size = seg_n[chosen]
        at = np.repeat(seg_at[chosen] - _starts(size), size) + np.arange(size.sum())
        per_word = np.bincount(tokens[at], np.repeat(SCALE * slope / size, size), words)
        hit = np.flatnonzero(per_word)
        n = live_n[hit]
        where = np.repeat(live_at[hit] - _starts(n), n) + np.arange(n.sum())
        per_gram = np.repeat(per_word[hit] / gram_n[hit], n)
        per_bucket = np.bincount(gram_ids[where], per_gram, BUCKETS)[used]
        push = 0.9 * push - rate * per_bucket[:, None] * weights
        pull = 0.9 * pull - 0.1 * (per_bucket @ table[used])
        drift = 0.9 * drift - 0.3 * slope.sum()
        table[used] += push - decay * table[used]
        weights, bias = weights + pull, bias + drift
    return best


def probability(model: Model, text: str | None, cache: dict[str, float]) -> float:
    """Of the toxic class. `cache` holds word scores and is emptied when it grows too large."""
    values = []
    for word in _WORD.findall((text or "").lower()):
        value = cache.get(word)
        if value is None:
            if len(cache) >= _CACHE:
                cache.clear()
            value = cache[word] = float(model.scores[subwords(word)].mean())
        values.append(value)
    top = 0.0
    if values:
        scores = np.asarray(values)
        at = np.arange(0, len(scores), SEGMENT)
        top = SCALE * float((np.add.reduceat(scores, at) / np.diff(np.append(at, len(scores)))).max())
    return float(1 / (1 + np.exp(-np.clip(top + model.bias, -50, 50))))


def training_rows(
    documents: DataFrame, labels: DataFrame, per_class: int = 1_000, most_bytes: int = 64 << 20
) -> DataFrame:
    """doc_id, text and _toxic of the rows that teach, outside the held-out fold.

    The sample is bounded: `per_class` toxic documents and three times as many others, those with the
    smallest hash of their id, and `most_bytes` of text. Rows without id, text or label do not teach.
    """
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("_toxic"))
    marked = marked.filter(F.col("doc_id").isNotNull() & F.col("_toxic").isin(0, 1))
    marked = marked.filter(bucket_of(F.col("doc_id"), 5) != 0).distinct()
    rank = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = None
    for value, most in ((1, per_class), (0, 3 * per_class)):
        part = marked.filter(F.col("_toxic") == value).orderBy(*rank).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 4 * per_class pairs of numbers: a bounded broadcast.
    return bounded_texts(documents, chosen, ["doc_id"], 4 * per_class, most_bytes)


def _fit_rows(rows: list[dict]) -> Model:
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["_toxic"]))
    return fit([r["text"] for r in rows], [r["_toxic"] for r in rows])


def train(documents: DataFrame, labels: DataFrame, per_class: int = 1_000) -> Model:
    """Fit on the bounded sample of labelled rows, in one task."""
    return learned(training_rows(documents, labels, per_class), _fit_rows)


def score_column(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Column function: the score of a whole text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache: dict[str, float] = {}
        for texts in batches:
            found = [probability(shared.value, text.as_py(), cache) for text in texts]
            yield pa.array(found, pa.float64())

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted for every document, whole texts."""
    run = score_column(documents.sparkSession, model)
    scored = documents.select("doc_id", run(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
