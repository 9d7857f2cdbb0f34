"""Similarity join of documents on 5-word shingles by MinHash with Bayesian candidate pruning.

1. Texts with the same words are one text (hash of the word sequence), so thousands of exact copies
   cost one signature and no pairs.
2. Bands of MinHash values form buckets. Inside a bucket the signatures are compared `STEP` values at
   a time, and a pair is dropped as soon as the posterior probability that its Jaccard index reaches
   the threshold falls below `TOLERANCE`. What survives only says which texts belong together: a task
   writes at most one edge per text, never the pairs.
3. Connected survivors form candidate groups. Every text moves to its group once, all pairs of the
   group are pruned in the same way, and the rest are verified exactly on the shingle sets. A task
   writes one row per text: its number of links and its smallest linked neighbour.

Buckets and groups above `BLOCK` texts are dealt into blocks by a hash of the id, and each pair of
blocks is a task of its own, so a group may be of any size and no link is lost.

Defined results: texts with fewer than five words have one shingle, all their words; texts without
words (null, empty, punctuation) have no shingle, link with nothing and are their own class. Rows that
repeat an id count as rows, and so do rows without id, but a null id never names a class. Only doc_id and
text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.llm.common import components, runs, slices, word_hashes
from perkflow.sources.scratch import materialise

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
BANDS, ROWS = 20, 5  # a pair at 0.8 shares no band once in 2,800
STEP = 16
TOLERANCE = 1e-4
BLOCK = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(2)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct 64-bit hashes of runs of SHINGLE words, sorted."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.astype(np.uint64, copy=False)
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * _MIX + words[i : i + n]
    return np.unique((out ^ (out >> np.uint64(32))) * _MIX)


def minhash(found: np.ndarray) -> np.ndarray:
    """HASHES 32-bit minima; chunks bound the memory for very long texts."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 2048):
        part = (found[at : at + 2048, None] * _A + _B) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=0))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64) * _MIX
    for r in range(ROWS):
        keys = (keys ^ (keys >> np.uint64(31))) * _MIX + low[r : BANDS * ROWS : ROWS]
    return (keys ^ (keys >> np.uint64(33))).view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n values compared, the fewest matches that keep a pair.

    Signatures keep 8 bits a value, so values match with p = J + (1 - J) / 256. With a uniform prior
    over J the posterior is proportional to p^m (1 - p)^(n - m), summed here over a grid.
    """
    j = (np.arange(4000) + 0.5) / 4000
    p = j + (1 - j) / 256
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(p) + (n - m) * np.log1p(-p)
            mass = np.exp(logs - logs.max())
            if mass[j >= threshold].sum() >= tolerance * mass.sum():
                out[n] = m
                break
    return out


_LEAST = least_matches()


def surviving(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Positions in `many` (n x HASHES bytes) that `one` may reach the threshold with."""
    left = np.arange(len(many))
    matches = np.zeros(len(many), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        matches += (many[left, n - STEP : n] == one[n - STEP : n]).sum(axis=1)
        keep = matches >= _LEAST[n]
        left, matches = left[keep], matches[keep]
    return left


def lowest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position connected with each of n positions through the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def bucket_edges(ids: np.ndarray, sigs: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge at most per text: a walk over the survivors, comparing with texts not yet reached."""
    order = np.argsort(ids, kind="stable")
    ids, sigs, block = ids[order], sigs[order], block[order]
    two = block.min() != block.max()
    left = np.arange(len(ids))
    root = np.arange(len(ids))
    while len(left):
        start, left = left[0], left[1:]
        queue = [start]
        while queue and len(left):
            at = queue.pop()
            here = left[block[left] != block[at]] if two else left
            hit = here[surviving(sigs[at], sigs[here])]
            root[hit] = start
            queue.extend(hit)
            left = np.setdiff1d(left, hit, assume_unique=True)
    moved = np.flatnonzero(ids[root] != ids)
    return ids[moved], ids[root[moved]]


def verified_pairs(sigs: np.ndarray, sets: list[np.ndarray], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) across the two blocks, or within the one, whose exact Jaccard index suffices."""
    n, size = len(sets), np.array([len(s) for s in sets])
    two = block.min() != block.max()
    first, second = [], []
    for a in range(n - 1):
        rest = np.arange(a + 1, n)
        small, large = np.minimum(size[a], size[rest]), np.maximum(size[a], size[rest])
        rest = rest[(small >= THRESHOLD * large) & ((block[rest] != block[a]) | (not two))]
        hit = rest[surviving(sigs[a], sigs[rest])]
        first.append(np.full(len(hit), a))
        second.append(hit)
    a = np.concatenate(first) if first else np.zeros(0, np.int64)
    b = np.concatenate(second) if second else np.zeros(0, np.int64)
    if len(a) <= 8 * n:
        shared = np.array(
            [len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64
        )
    else:
        shared = _shared_counts(sets)[a, b].astype(np.int64)
    good = shared >= THRESHOLD * (size[a] + size[b] - shared) - 1e-9
    return a[good], b[good]


def _shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of all pairs of one bounded task, by products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times[column] > 1
    owner, column = owner[twice], column[twice]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    kinds, column = np.unique(column, return_inverse=True)
    for low in range(0, len(kinds), 2048):
        at = slice(*np.searchsorted(column, (low, low + 2048)))
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[at], column[at] - low] = 1
        total += part @ part.T
    return total


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def signatures(documents: DataFrame) -> DataFrame:
    """doc_id, row_key, text_key (null without words), sig and bands of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            keys, sigs, bands = [], [], []
            for hashes in batch.column(1):
                found = hashes.values.to_numpy(zero_copy_only=False)
                if not len(found):
                    keys.append(None), sigs.append(None), bands.append(None)
                    continue
                low = minhash(shingles(found))
                keys.append(hashlib.md5(found.tobytes()).digest())
                sigs.append((low & np.uint64(255)).astype(np.uint8).tobytes())
                bands.append(band_keys(low))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(2),
                    pa.array(keys, pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "text_key", "sig", "bands"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long"), word_hashes(F.col("text")).alias("words"), row_key().alias("row_key")
    )
    schema = "doc_id long, row_key string, text_key binary, sig binary, bands array<long>"
    return rows.mapInArrow(run, schema)


def row_key() -> Column:
    """Digest of id and text: rows that agree in both are copies of one row."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.md5("text"), F.lit("-")))


def in_blocks(
    rows: DataFrame, keys: list[str], size: Column, rep: str, most: int | None = None
) -> DataFrame:
    """Deal each group into blocks by a hash of the id, one copy of a row per pair of blocks."""
    blocks = F.ceil(size / F.lit(most or BLOCK)).cast("int")
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(rep), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other)
    return rows.select(
        *keys, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        *[c for c in rows.columns if c not in (*keys, "blocks", "other")],
    )


def grouped(rows: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """`run` on runs of rows that agree in the keys and the pair of blocks, one run at a time."""
    keys = [*keys, "low", "high"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, schema)


def candidate_groups(reps: DataFrame) -> DataFrame:
    """(rep, group) of the texts that survive the pruning with some other text."""
    rows = reps.select("rep", F.explode("bands").alias("band"))
    counts = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = rows.join(counts, "band")
    dealt = in_blocks(shared, ["band"], F.col("n"), "rep").join(reps.select("rep", "sig"), "rep")
    dealt = dealt.select("band", "low", "high", "rep", "block", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            if group.num_rows < 2:
                continue
            block = _numbers(group.column(4))
            a, b = bucket_edges(_numbers(group.column(3)), _matrix(group.column(5)), block)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    edges = grouped(dealt, ["band"], run, "a long, b long").distinct()
    found = components(edges)
    return found.select(F.col("id").alias("rep"), F.col("component_id").alias("group"))


def verified_links(documents: DataFrame, reps: DataFrame, groups: DataFrame) -> DataFrame:
    """rep, links (rows with another text at the threshold) and near (smallest linked text in a task)."""
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    members = in_blocks(groups.join(sizes, "group"), ["group"], F.col("n"), "rep")
    members = members.join(reps.select("rep", "row_key", "copies", "sig"), "rep")
    texts = documents.select(row_key().alias("row_key"), "text")
    rows = members.join(texts, "row_key").select("group", "low", "high", "rep", "block", "copies", "sig", "text")
    keys = ["group", "low", "high"]
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "rep")
    rows = rows.withColumn("text", word_hashes(F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            # A row may be there several times.
            ids, first = np.unique(_numbers(group.column(3)), return_index=True)
            group = group.take(pa.array(first))
            if len(ids) < 2:
                continue
            block, copies = _numbers(group.column(4)), _numbers(group.column(5))
            words = group.column(7)
            sets = [shingles(w.values.to_numpy(zero_copy_only=False)) for w in words]
            a, b = verified_pairs(_matrix(group.column(6)), sets, block)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            near = ids[lowest_labels(len(ids), a, b)]
            hit = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[hit]) for x in (ids, links, near)], names=["rep", "links", "near"]
            )

    return rows.mapInArrow(run, "rep long, links long, near long")


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row_key, text_key) and, per text_key, its class, the name of the class and n_links.

    A class is a number; its name is the smallest id of its rows, null if none has an id.
    """
    rows = materialise(signatures(documents), "signatures")
    worded = rows.filter(F.col("text_key").isNotNull())
    keyed = worded.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.min("row_key").alias("row_key")
    )
    own = worded.select("text_key", "row_key", F.col("doc_id").alias("some_id"), "sig", "bands")
    # Texts go by a number of their own; ids only name the classes. One row stands for its text.
    reps = keyed.join(own, ["text_key", "row_key"]).dropDuplicates(["text_key"])
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "texts")
    links = materialise(verified_links(documents, reps, candidate_groups(reps)), "links")
    total = links.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(links.filter("near <> rep").select(F.col("rep").alias("a"), F.col("near").alias("b")))
    classes = classes.withColumnRenamed("id", "rep")
    # The names are stored, so that a class with very many texts meets a side of known size.
    names = materialise(
        classes.join(reps.select("rep", "first_id"), "rep").groupBy("component_id").agg(
            F.min("first_id").alias("name")
        ),
        "names",
    )
    known = (
        reps.select("text_key", "rep", "first_id", "copies")
        .join(total, "rep", "left")
        .join(classes, "rep", "left")
        .join(names, "component_id", "left")
        .select(
            "text_key",
            F.coalesce("component_id", "rep").alias("class"),
            F.coalesce("name", "first_id").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return rows.select("doc_id", "row_key", "text_key"), known


def similarity_join(documents: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id connected through links) and n_links for every row."""
    rows, known = _classes(documents)
    return rows.join(known, "text_key", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def first_of_each_class(documents: DataFrame) -> DataFrame:
    """One row of each class, with all columns: the one with the smallest id, among equal ids by digest.

    Rows without id stand behind all others of their class. A text without words is its own class; rows
    that agree in id and text are one row.
    """
    rows, known = _classes(documents)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    best = rows.filter(F.col("text_key").isNotNull()).join(known, "text_key").groupBy("class")
    best = best.agg(F.min(place)["row_key"].alias("_row")).select("_row")
    alone = rows.filter(F.col("text_key").isNull()).select(F.col("row_key").alias("_row"))
    keep = best.unionByName(alone)
    key = "_row"
    while key in documents.columns:
        key += "_"
    once = documents.withColumn(key, row_key()).dropDuplicates([key])
    return once.join(keep.withColumnRenamed("_row", key), key, "left_semi").select(documents.columns)
