"""Byte-level BPE encoding and decoding with given ranks.

Words are the matches of the split pattern. A word that is a token is its own id. For the other words
Spark higher-order functions fold the ranked merges over the array of the word's bytes, with the rank
map as a literal; this runs once per distinct word, for every word that makes up at least `COMMON` of
all words of the table (at most 1 / COMMON words by arithmetic, so the result may be broadcast).
Texts are then encoded in place, without a shuffle: Arrow tasks look words up and fold the rarer ones
themselves, with a bounded cache. Decoding concatenates the pieces of the ids by higher-order
functions.

Bytes stand as Latin-1 text where Spark maps need comparable keys: one character per byte.

Defined results: null is encoded as empty; ids outside the vocabulary cannot arise. Only doc_id and
text are read.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.llm.common import slices
from perkflow.sources.scratch import materialise

COMMON = 2e-6
LONGEST = 64  # bytes of a word that Spark folds; longer ones merge with a heap
PLAN_TEXT = 1 << 16
_NO_BOUND = "2147483632"  # the default
_MAPS = 1 << 14
_CACHE = 500_000
_LATIN = "ISO-8859-1"
_NONE = 1 << 30  # rank of neighbours that do not merge


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and number per line. Read on the driver."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def java_pattern(pattern: str) -> str:
    """The split pattern with Unicode white space, as other regex engines read it."""
    return f"(?U){pattern}"


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """array<map<string,int>> constant: maps by crc32 of the token, so a lookup scans a few keys."""
    maps: list[dict[str, int]] = [{} for _ in range(_MAPS)]
    for token, rank in ranks.items():
        maps[zlib.crc32(token) % _MAPS][token.decode("latin-1")] = rank
    kind = T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))
    return F.from_json(F.lit(json.dumps(maps)), kind)


def token_literal(ranks: dict[bytes, int]) -> Column:
    """array<string> constant: the piece of every id."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    return F.from_json(F.lit(json.dumps(pieces)), T.ArrayType(T.StringType()))


def rank_of(table: Column, piece: Column) -> Column:
    place = F.crc32(F.encode(piece, _LATIN)) % _MAPS
    return F.element_at(F.element_at(table, (place + 1).cast("int")), piece)


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of a word: merge the leftmost neighbours of lowest rank until no merge has a rank."""
    text = F.decode(F.encode(word, "UTF-8"), _LATIN)
    pieces = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, 1))

    def merged(parts: Column, at: Column) -> Column:
        pair = F.concat(F.element_at(parts, at), F.element_at(parts, at + 1))
        return F.concat(
            F.slice(parts, F.lit(1), at - 1), F.array(pair), F.slice(parts, at + 2, F.size(parts))
        )

    def step(state: Column, _: Column) -> Column:
        parts = state["parts"]
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(parts) - 1),
            lambda i: rank_of(table, F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))),
        )
        # A one-element array binds the ranks, which are used twice.
        after = F.transform(
            F.array(pairs),
            lambda r: F.struct(
                F.coalesce(
                    merged(parts, F.array_position(r, F.array_min(r)).cast("int")), parts
                ).alias("parts"),
                F.array_min(r).isNull().alias("done"),
            ),
        )[0]
        return F.when(state["done"] | (F.size(parts) < 2), state).otherwise(after)

    start = F.struct(pieces.alias("parts"), F.lit(False).alias("done"))
    last = F.aggregate(F.sequence(F.lit(1), F.length(text)), start, step, lambda s: s["parts"])
    return F.transform(last, lambda piece: rank_of(table, piece))


def short_plans(spark: SparkSession) -> None:
    """Cut plan descriptions, which would spell out the literals, at PLAN_TEXT characters.

    The driver makes several of each plan and keeps them for its status store. A session with a bound of its
    own keeps that.
    """
    if spark.conf.get("spark.sql.maxPlanStringLength").startswith(_NO_BOUND):
        spark.conf.set("spark.sql.maxPlanStringLength", str(PLAN_TEXT))


def common_words(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """word and ids of the common words, each folded once; ids are null for words that are tokens."""
    short_plans(documents.sparkSession)
    found = F.regexp_extract_all(
        F.coalesce(F.col("text"), F.lit("")), F.lit(java_pattern(pattern)), F.lit(0)
    )
    counts = documents.select(F.explode(found).alias("word")).groupBy("word").count()
    counts = materialise(counts, "word_counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    frequent = counts.filter(F.col("count") >= COMMON * total)
    plain = F.decode(F.encode("word", "UTF-8"), _LATIN)
    small = frequent.filter(F.octet_length("word") <= LONGEST).select("word").repartition("word")
    # An array of one element binds the literal, which the plan would otherwise hold for each use.
    ids = F.transform(
        F.array(rank_literal(ranks)),
        lambda table: F.when(rank_of(table, plain).isNull(), fold_merges(F.col("word"), table)),
    )
    return small.select("word", F.get(ids, F.lit(0)).alias("ids"))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word, for words that the table of common words does not hold."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONGEST:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = ranks.get
    pairs = [rank(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) < _NONE:
        at = pairs.index(low)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = rank(parts[at - 1] + parts[at], _NONE)
        if at < len(pairs):
            pairs[at] = rank(parts[at] + parts[at + 1], _NONE)
    return [ranks[part] for part in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of candidate merges and links between the parts left."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < len(parts):
            pair = parts[at] + parts[after[at]]
            rank = ranks.get(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, at, pair))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, at, pair = heapq.heappop(heap)
        if parts[at] is None or after[at] >= len(parts) or parts[at] + parts[after[at]] != pair:
            continue
        gone = after[at]
        parts[at], parts[gone], after[at] = pair, None, after[gone]
        if after[at] < len(parts):
            before[after[at]] = at
        offer(at)
        offer(before[at])
    return [ranks[part] for part in parts if part is not None]


class _Words(dict[str, bytes]):
    """Packed ids of words: the common ones, and others as they come, up to a bound.

    It is broadcast, so a Python worker keeps what it learned for its next task that encodes the same
    documents, and lets go of it with the broadcast at its first task of another kind.
    """

    def __init__(self, ranks: dict[bytes, int], common: dict[str, bytes]) -> None:
        super().__init__(common)
        self.ranks, self.common = ranks, common

    def __missing__(self, word: str) -> bytes:
        packed = np.array(merge(word.encode(), self.ranks), "<u4").tobytes()
        if len(word) <= LONGEST:
            self[word] = packed
        return packed

    def limit(self) -> None:
        if len(self) > len(self.common) + _CACHE:
            self.clear()
            self.update(self.common)


def encode(
    documents: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str] | None = None
) -> DataFrame:
    """The documents' columns (or those to `keep`) with `tokens`, of the whole text.

    `tokens` holds ids, and packed, the same as little-endian unsigned 32-bit numbers. Common words are folded
    first; texts are then encoded some at a time, so memory does not follow the size of Arrow batches.
    """
    rows = common_words(documents, ranks, pattern).collect()  # at most 1 / COMMON
    common = {r.word: np.array(r.ids, "<u4").tobytes() for r in rows if r.ids is not None}
    shared = documents.sparkSession.sparkContext.broadcast(_Words(ranks, common))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        known = shared.value
        for batch in slices(batches, 256):
            found = []
            for text in batch.column(batch.num_columns - 1):
                words = split(text.as_py() or "")
                found.append(np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4"))
                known.limit()
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, "<u4"), *found]).astype(np.int32)
            tokens = pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                ],
                names=["ids", "packed"],
            )
            names = [*batch.schema.names[:-1], "tokens"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], names=names)

    kept = [name for name in keep or documents.columns if name != "tokens"]
    tokens = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("packed", T.BinaryType())
    schema = T.StructType([*documents.select(*kept).schema.fields, T.StructField("tokens", tokens)])
    return documents.select(*kept, F.col("text").alias("_text")).mapInArrow(run, schema)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes of the ids' pieces in order."""
    pieces = F.transform(ids, lambda i: F.element_at(token_literal(ranks), i + 1))
    return F.encode(F.array_join(pieces, ""), _LATIN)


def digests(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    return encoded.select(
        "doc_id",
        F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(F.col("tokens.packed"), 256).alias("ids_sha256"),
        F.sha2(decode(F.col("tokens.ids"), ranks), 256).alias("decoded_sha256"),
    )
