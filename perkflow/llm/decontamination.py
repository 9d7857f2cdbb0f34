"""Benchmark decontamination by the CGK embedding, bit-sampling LSH and exact edit distance.

Texts are sequences of words. A CGK walk reads a window of an item's size: at step j it writes the
word under its pointer and moves on or not by a random bit of (j, word). Two windows with few word
edits fall into step again after each edit, so edit distance becomes Hamming distance. LSH samples
`SAMPLE` coordinates of the walk, `SETS` times for each of `WALKS` walks, from the first part of the
embedding and from all of it. Six coordinates stand on about five words; with a fifth of the words
edited they agree with probability 0.8^5, so 8 samples reach a recall of 0.96 in one window, and a
passage holds several windows.

Windows of a document start at every `STRIDE`-th word. The items are indexed from every word offset
over their whole length, so some window starts exactly at an indexed word of the passage, wherever in
the item its edits are. A window reaches over `LEVELS` words at most; a longer item has more of them. Items
shorter than `SHORT` words are searched with windows at every word and one coordinate, the first: their
first half has more words than may be edited. Hits whose starts differ by no more than the allowed edits
are verified together, by the exact word edit distance between the whole item and the document around the windows,
free at both ends.

The documents are read once per block of at most `ITEMS` items and, from the second item on, `WORDS` words, and nothing is shuffled. Defined results: null
texts, texts and items without words match nothing; equal items each get their row; a document gets
one row per item, for the first place found. Only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm.common import word_hashes

SHARE = 0.2  # of the item's words that may be edited
SAMPLE, SETS, WALKS = 6, 4, 2
LEVELS = (1, 8, 16, 32)  # words that the sampled coordinates may reach over; 1 is for short items
STRIDE, SHORT = 4, 12
ITEMS, WORDS = 2_000, 100_000
_FILTER_BITS = 20
_CHUNK = 1 << 15
_MIX = np.uint64(0x9E3779B97F4A7C15)
STEPS = 64  # one random bit of a word per step; every coordinate lies below


def _mixed(words: np.ndarray, salt: int) -> np.ndarray:
    out = (words ^ np.uint64(salt * 0x94D049BB133111EB % (1 << 64))) * _MIX
    return (out ^ (out >> np.uint64(32))) * _MIX


def samples() -> dict[tuple[int, int], list[np.ndarray]]:
    """(walk, level) -> sets of coordinates. Half of the sets keep to the first half."""
    rng = np.random.default_rng(4)
    out = {}
    for walk in range(WALKS):
        for level in LEVELS:
            if level == 1:
                out[walk, level] = [np.zeros(1, np.int64)] if walk == 0 else []
                continue
            reach = 3 * level // 2
            out[walk, level] = [
                np.sort(rng.choice(max(12, reach // (1 + s % 2)), SAMPLE, replace=False))
                for s in range(SETS)
            ]
    return out


_SAMPLES = samples()
_COEFFICIENTS = np.random.default_rng(5).integers(1, 1 << 63, SAMPLE, dtype=np.uint64) | np.uint64(1)


def walk_keys(words: np.ndarray, starts: np.ndarray, walk: int, levels: list[int]):
    """(level, set, keys, furthest word) for CGK walks from each start.

    `words` ends in STEPS zeros, so that no walk leaves it.
    """
    wanted = {int(j) for level in levels for s in _SAMPLES[walk, level] for j in s} or {0}
    bits = _mixed(words, 1 + walk)
    at = starts.astype(np.int32)
    seen, where = {}, {}
    for j in range(max(wanted) + 1):
        if j in wanted:
            seen[j], where[j] = words[at], at
        at = at + ((bits[at] >> np.uint64(j)) & np.uint64(1)).astype(np.int32)
    for level in levels:
        for s, chosen in enumerate(_SAMPLES[walk, level]):
            salt = np.uint64((level * 64 + s + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            keys = seen[int(chosen[0])] * _COEFFICIENTS[0] + salt
            for coefficient, j in zip(_COEFFICIENTS[1:], chosen[1:]):
                keys += seen[int(j)] * coefficient
            keys = (keys ^ (keys >> np.uint64(31))) * _MIX
            yield level, s, keys, where[int(chosen[-1])]


@dataclass(frozen=True)
class Index:
    """Keys of item windows, per (walk, level, set) sorted, with the item and its word offset."""

    items: list[np.ndarray]
    words: list[frozenset[int]]
    ids: list[int]
    tables: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    stride: int


def build_index(items: list[tuple[int, np.ndarray]], stride: int) -> Index:
    found: dict[tuple[int, int, int], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for n, (_, words) in enumerate(items):
        short = len(words) < SHORT
        offsets = np.arange(min(max(stride, len(words) // 2), len(words)) if short else len(words))
        left = len(words) - offsets
        for walk in range(WALKS):
            padded = np.append(words, np.zeros(STEPS, np.uint64))
            for level, s, keys, reach in walk_keys(padded, offsets, walk, list(LEVELS)):
                if short:
                    own = np.full(len(offsets), level == 1)
                else:  # the largest level that the window fills
                    own = (left >= level) & ((left < 2 * level) | (level == LEVELS[-1])) & (level > 1)
                at = np.flatnonzero(own & (reach < len(words)))
                if len(at):
                    rows = keys[at], np.full(len(at), n, np.int32), offsets[at].astype(np.int32)
                    found.setdefault((walk, level, s), []).append(rows)
    tables = {}
    for place, rows in found.items():
        keys, item, offset = (np.concatenate(part) for part in zip(*rows))
        order = np.lexsort((offset, item, keys))
        keys = keys[order]
        flags = np.zeros(1 << _FILTER_BITS, bool)
        flags[keys >> np.uint64(64 - _FILTER_BITS)] = True
        tables[place] = flags, keys, item[order], offset[order]
    distinct = [frozenset(w.tolist()) for _, w in items]
    return Index([w for _, w in items], distinct, [i for i, _ in items], tables, stride)


def edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest word edits between the item and any run of words of the text, and where the run ends."""
    along = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - along) + along
    end = int(row.argmin())
    return int(row[end]), end


def places(docs: list[np.ndarray], index: Index) -> list[list[tuple[int, int]]]:
    """For each document the (item, word where the item would start) that share a sampled key.

    Documents are walked together, with STEPS zeros after each, in chunks of bounded size.
    """
    found: list[set[tuple[int, int]]] = [set() for _ in docs]
    gap = np.zeros(STEPS, np.uint64)
    begin = np.cumsum([0, *(len(d) + STEPS for d in docs)])
    words = np.concatenate([x for d in docs for x in (d, gap)]) if docs else gap
    starts = [np.arange(b, b + len(d), index.stride) for b, d in zip(begin, docs)]
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    levels = sorted({level for _, level, _ in index.tables})
    for low in range(0, len(starts), _CHUNK):
        here = starts[low : low + _CHUNK]
        part = words[here[0] : here[-1] + STEPS + 1]
        for walk in range(WALKS):
            for level, s, keys, _ in walk_keys(part, here - here[0], walk, levels):
                table = index.tables.get((walk, level, s))
                if table is None:
                    continue
                flags, sorted_keys, item, offset = table
                hits = np.flatnonzero(flags[keys >> np.uint64(64 - _FILTER_BITS)])
                first = np.searchsorted(sorted_keys, keys[hits], "left")
                last = np.searchsorted(sorted_keys, keys[hits], "right")
                for hit, a, b in zip(here[hits], first, last):
                    if a < b:
                        doc = int(np.searchsorted(begin, hit, "right")) - 1
                        start = int(hit - begin[doc])
                        found[doc].update((int(item[x]), start - int(offset[x])) for x in range(a, b))
    return [sorted(f) for f in found]


def matches(docs: list[np.ndarray], index: Index) -> list[list[tuple[int, int, int, int]]]:
    """(item_id, word_start, edits, n_words) of each document's first place for each item."""
    out = []
    for words, tries in zip(docs, places(docs, index)):
        found: dict[int, tuple[int, int, int, int]] = {}
        at = 0
        while at < len(tries):
            n, start = tries[at]
            item = index.items[n]
            most = int(SHARE * len(item))
            last = start
            while at < len(tries) and tries[at][0] == n and tries[at][1] - start <= most:
                last = tries[at][1]
                at += 1
            if n in found:
                continue
            low = max(0, start - most)
            text = words[low : max(0, last + len(item)) + most]
            # Distinct words of the item that do not occur here bound the edits from below.
            if len(index.words[n] - set(text.tolist())) > most:
                continue
            count, end = edits(item, text)
            if count <= most:
                found[n] = (index.ids[n], max(low, low + end - len(item)), count, len(item))
        out.append(sorted(found.values()))
    return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items with at least one word by length class, on the driver at most ITEMS of WORDS words at a time."""
    rows = benchmark.select(F.col("item_id").cast("long"), word_hashes(F.col("text")).alias("words"))
    rows = rows.filter(F.col("item_id").isNotNull() & (F.size("words") > 0))
    for short in (True, False):
        part = rows.filter((F.size("words") < SHORT) == F.lit(short)).orderBy("item_id")
        block, n_words = [], 0
        for row in part.toLocalIterator():
            words = np.array(row.words, np.int64).view(np.uint64)
            if block and (len(block) >= ITEMS or n_words + len(words) > WORDS):
                yield block
                block, n_words = [], 0
            block.append((row.item_id, words))
            n_words += len(words)
        if block:
            yield block


_LEAK = "struct<item_id:bigint,word_start:bigint,edits:int,n_words:int>"


def leak_column(
    spark: SparkSession, block: list[tuple[int, np.ndarray]]
) -> Callable[[Column], Column]:
    """Column function: the leaks of a block of items in a document's word hashes."""
    shared = spark.sparkContext.broadcast(
        build_index(block, 1 if len(block[0][1]) < SHORT else STRIDE)
    )

    @F.arrow_udf(f"array<{_LEAK}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for docs in batches:
            found = []
            for at in range(0, len(docs), 512):
                part = docs.slice(at, 512)
                words = [w.values.to_numpy(zero_copy_only=False).view(np.uint64) for w in part]
                found += matches(words, shared.value)
            rows = [x for hits in found for x in hits]
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            leaks = pa.StructArray.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["item_id", "word_start", "edits", "n_words"],
            )
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), leaks)

    return run


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, word_start, edits, n_words for every benchmark item found in a document."""
    spark = documents.sparkSession
    kind = documents.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"doc_id {kind}, leak {_LEAK}")
    for block in item_blocks(benchmark):
        leaks = leak_column(spark, block)(word_hashes(F.col("text")))
        found = documents.select("doc_id", leaks.alias("leaks"))
        out = out.unionByName(found.select("doc_id", F.explode("leaks").alias("leak")))
    return out.select("doc_id", "leak.*")


def uncontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, in which no benchmark item is found."""
    for block in item_blocks(benchmark):
        leaks = leak_column(documents.sparkSession, block)(word_hashes(F.col("text")))
        documents = documents.filter(F.size(leaks) == 0)
    return documents
