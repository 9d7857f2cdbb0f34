"""Language identification by a string kernel.

Blended-spectrum presence kernel: two texts are as alike as the number of character 1-, 2- and
3-grams that both contain, divided by the root of the product of their own numbers. Nystroem
landmarks turn it into a short vector, one-versus-rest kernel ridge regression reads that vector, and
batches of texts are scored by two matrix products.

Grams are made of the real letters of any script, all other characters being one blank, and are hashed
into `_SPACE` features; grams that fall together count as one.

Defined results: a text that is null or has no letter is `und` with score 0, and so is every text
when there is no labelled row to learn from.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perkflow.llm.common import bounded_texts, bucket_of, learned

UNKNOWN = "und"
_BITS = 20
_SPACE = 1 << _BITS
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 20  # characters


@dataclass(frozen=True)
class Model:
    languages: list[str]
    letter_ids: np.ndarray  # code point -> itself for letters, else 0
    features: np.ndarray  # hashed n-grams that occur in a landmark
    landmarks: np.ndarray  # landmark x feature, presence over the root of the landmark's n-grams
    weights: np.ndarray  # landmark x language


def letter_table() -> np.ndarray:
    """Code points of letters, 0 for all other characters."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(0x110000)], np.int32)


def presence(text: str, table: np.ndarray) -> np.ndarray:
    """One flag per feature that a 1-, 2- or 3-gram of letters falls on. Long texts go piece by piece."""
    flags = np.zeros(_SPACE, np.uint8)
    text = text.lower()
    for at in range(0, len(text), _PIECE):
        # Two characters of the piece before complete the grams across the cut; they may set flags again.
        points = np.frombuffer(text[max(0, at - 2) : at + _PIECE].encode("utf-32-le", "replace"), np.uint32)
        ids = table[points].astype(np.uint64)
        codes = ids
        for n in range(1, 4):
            # Grams of blanks only say nothing about a language.
            kept = codes[codes > 0] + np.uint64(n << 62 & (1 << 64) - 1)
            kept = (kept ^ (kept >> np.uint64(31))) * _MIX
            flags[((kept ^ (kept >> np.uint64(29))) * _MIX) >> np.uint64(64 - _BITS)] = 1
            if n < 3:
                codes = (codes[:-1] << np.uint64(21)) + ids[n:]
    return flags


def fit(texts: list[str], langs: list[str], landmarks: int = 48, ridge: float = 1e-3) -> Model:
    """`landmarks` texts per language; the texts come in an order that does not depend on language."""
    names = sorted(set(langs))
    table = letter_table()
    # The grams of a text take little room as numbers; flags for all texts at once would not.
    grams = [np.flatnonzero(presence(text, table)).astype(np.int32) for text in texts]
    usable = [i for i, found in enumerate(grams) if len(found)]
    langs, grams = [langs[i] for i in usable], [grams[i] for i in usable]
    taken: Counter[str] = Counter()
    chosen = []
    for i, lang in enumerate(langs):
        if taken[lang] < landmarks:
            taken[lang] += 1
            chosen.append(i)
    if not chosen:
        return Model([], table, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros((0, 0)))
    features = np.unique(np.concatenate([grams[i] for i in chosen])).astype(np.int64)
    column = np.full(_SPACE, -1, np.int32)
    column[features] = np.arange(len(features))

    def bags(part: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(part), len(features)), np.float32)
        for row, found in zip(out, part):
            own = column[found]
            row[own[own >= 0]] = 1 / np.sqrt(len(found))
        return out

    marks = bags([grams[i] for i in chosen])
    kernel = np.concatenate(
        [bags(grams[at : at + 128]) @ marks.T for at in range(0, len(grams), 128)]
    ).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = kernel @ root
    wanted = np.where(np.asarray(langs)[:, None] == np.asarray(names)[None], 1.0, -1.0)
    gram = mapped.T @ mapped + ridge * len(langs) * np.eye(mapped.shape[1])
    return Model(names, table, features, marks, root @ np.linalg.solve(gram, mapped.T @ wanted))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    bags = np.zeros((len(texts), len(model.features)), np.float32)
    known = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        flags = presence(text or "", model.letter_ids)
        n = np.count_nonzero(flags)
        if n and model.languages:
            known[i] = True
            bags[i] = flags[model.features] / np.sqrt(n)
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    kernel = bags @ model.landmarks.T
    values = kernel.astype(np.float64) @ model.weights
    best = values.argmax(axis=1)
    top = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
    langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return langs, [float(t) if k else 0.0 for t, k in zip(top, known)]


def training_rows(documents: DataFrame, per_language: int = 300, most_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, lang and text of the rows that teach, outside the held-out fold.

    The sample is bounded: per language the `per_language` rows with the smallest hash of their id, and
    `most_bytes` of text in all. Ids are chosen first, so only the chosen texts move.
    """
    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.filter(F.col("doc_id").isNotNull() & (bucket_of(F.col("doc_id"), 4) != 2))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("doc_id", "lang").withColumn("_n", F.row_number().over(order))
    ids = ids.filter(F.col("_n") <= per_language).select("doc_id", "lang").distinct()
    return bounded_texts(rows, ids, ["doc_id", "lang"], 100 * per_language, most_bytes)


def _fit_rows(rows: list[dict]) -> Model:
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), r["lang"], r["text"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def train(documents: DataFrame, per_language: int = 300) -> Model:
    """Fit on the bounded sample of rows that name a language, in one task."""
    return learned(training_rows(documents, per_language), _fit_rows)


def hash_order(doc_id: object) -> int:
    """An order of ids, numbers or text, that tells nothing about the row."""
    return zlib.crc32(str(doc_id).encode()) * 0x9E3779B97F4A7C15 % (1 << 64)


def identify_column(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Column function: struct of lang_pred and score of a whole text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            langs: list[str] = []
            scores: list[float] = []
            for at in range(0, len(texts), 128):
                found = predict(shared.value, texts.slice(at, 128).to_pylist())
                langs += found[0]
                scores += found[1]
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["lang_pred", "score"],
            )

    return run


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for every document, from its whole text alone."""
    run = identify_column(documents.sparkSession, model)
    found = documents.select("doc_id", run(F.col("text")).alias("found"))
    return found.select("doc_id", "found.lang_pred", "found.score")
