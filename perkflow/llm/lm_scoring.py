"""Cross-entropy difference between two matched n-gram models.

A target model (documents of a wanted kind) and a background model (all documents) are bigram models
over one shared vocabulary with the same smoothing. A document's score is the mean over its words of
the loss under the target model minus the loss under the background model: low means like the target.

Every word and every bigram of the corpus is counted and takes part, whatever its size.

1. One scan cuts the documents into blocks of `BLOCK_WORDS` words (or one longer document). A block is one
   stored row: its different words and, for each word of its texts, the number of that word in the block.
2. Each block asks for its different bigrams, with its own counts; a question goes to the part that the
   bigram's hash names. The task of a part adds up, and answers only what a block cannot know: the totals of
   bigrams that several blocks hold. For all other bigrams, most of them, the block's counts are the totals.
3. In the same way each block asks for its different words: their counts, and what the bigrams that they
   open come to. A bigram in several blocks is counted by one of them, its owner.
4. Blocks, now with all totals, score their own documents. Plain blocks are stored in buckets, so only
   answers move to them.

So a bigram moves once per block that holds it, packed, 8 bytes and its counts. A frequent bigram or word
is one row per block, never one per occurrence. A task holds one block or one part; no model is on the
driver or broadcast. Only the ids of target documents are broadcast, up to `MOST_IDS` of them, and joined
beyond that.

Loss: absolute discounting, P(w | v) = max(c(v w) - D, 0) / c(v) + left(v) * P(w), where left(v) is the
mass that the bigrams of v leave, and P(w) adds one to every count. Each sums to one. A word that the corpus
does not hold has count 0 and leaves all its mass. Words are 64 bits of a hash, and so are bigrams.

Defined results: a document without words has n_tokens 0 and null losses; without any target document
the target model is the uniform one over the vocabulary. Only doc_id, text and the target ids are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.llm.common import runs, slices, word_hashes
from perkflow.sources import files
from perkflow.sources.scratch import materialise, scratch_path

DISCOUNT = 0.5
BLOCK_WORDS = 1 << 20
PART_WORDS = 1 << 20  # words of the corpus per part
MOST_IDS = 2_000_000
START = 0  # stands before the first word of a text
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ASKED = "part int, block long, body binary"
_ANSWERED = "block long, part int, body binary, n_known long"


@dataclass(frozen=True)
class Scorer:
    """The corpus that both models count, and the ids of the target documents in it."""

    corpus: DataFrame
    target_ids: DataFrame


def train(documents: DataFrame, target_ids: DataFrame) -> Scorer:
    """Models of the documents whose id is in `target_ids` (doc_id) and of all documents."""
    return Scorer(documents, target_ids.select("doc_id"))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: equal bytes of the numbers stand together, which compresses small numbers."""
    codec = pa.Codec("zstd", compression_level=1)
    parts = []
    for array in arrays:
        planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T.tobytes()
        parts.append((array.dtype.str, len(array), codec.compress(planes, asbytes=True)))
    return pickle.dumps(parts)


def unpacked(body: bytes) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    out = []
    for kind, n, data in pickle.loads(body):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(codec.decompress(data, n * size, asbytes=True), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(kind))
    return out


def pair_ids(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different words and START, frequent ones first, and for each word of the texts its number.

    Small numbers for frequent words compress better.
    """
    every = np.concatenate([np.array([START], np.int64), *texts])
    known, ids, n = np.unique(every, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    number = np.empty(len(known), np.int32)
    number[order] = np.arange(len(known), dtype=np.int32)
    return known[order], number[ids[1:]]


class Block:
    """Texts as numbers of words, and the counts of their different words and bigrams."""

    def __init__(self, known: np.ndarray, ids: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, counted: bool):
        self.known, self.ids, self.lengths = known, ids, lengths
        size = len(known)
        start = int(np.flatnonzero(known == START)[0])
        before = np.concatenate((ids[:1], ids[:-1])).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else np.zeros(0, np.int64)
        before[at[lengths > 0]] = start
        codes, self.row = np.unique(before * size + ids, return_inverse=True)
        self.first, self.second = codes // size, codes % size
        weight = np.repeat(wanted, lengths) & counted
        total = np.full(len(ids), counted)
        self.pairs = np.stack([np.bincount(self.row, w, len(codes)) for w in (weight, total)], axis=1).astype(np.int64)
        # Of each word: its count and the occurrences of the bigrams that it opens, target and all.
        words = [np.bincount(ids, w, size) for w in (weight, total)]
        words += [np.bincount(self.first, self.pairs[:, i], size) for i in range(2)]
        self.words = np.stack(words, axis=1).astype(np.int64)

    def pair_keys(self) -> np.ndarray:
        """64-bit hashes of the bigrams."""
        words = self.known.view(np.uint64)
        keys = (words[self.first] ^ (words[self.first] >> np.uint64(29))) * _MIX + words[self.second]
        keys = (keys ^ (keys >> np.uint64(32))) * _MIX
        return keys ^ (keys >> np.uint64(29))


def word_keys(known: np.ndarray) -> np.ndarray:
    """Mixed word hashes, which deal the words to parts."""
    keys = known.view(np.uint64) * _MIX
    return keys ^ (keys >> np.uint64(32))


def by_part(keys: np.ndarray, parts: int) -> list[np.ndarray]:
    """Positions of the keys of each part, in order."""
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return np.split(order, np.searchsorted(part[order], np.arange(1, parts)))


def _asks(block: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part with keys and counts of the items that it adds up."""
    small = counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts
    dealt = [(part, at) for part, at in enumerate(by_part(keys, parts)) if len(at)]
    bodies = [packed(keys[at], *(small[at, i] for i in range(small.shape[1]))) for _, at in dealt]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part for part, _ in dealt], pa.int32()),
            pa.array(np.full(len(dealt), block, np.int64)),
            pa.array(bodies, pa.binary()),
        ],
        names=["part", "block", "body"],
    )


def answers(asked: DataFrame, known_column: int) -> DataFrame:
    """Totals of the items that several blocks ask for, to each of these blocks.

    `body` holds the positions of the items in the block's question, whether the block owns them, and the
    sums of all their counts. One more row per part, without block, says how many items of the part have a
    sum in `known_column`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 1):
            part = group.column(0)[0].as_py()
            blocks = group.column(1).to_pylist()
            asks = [unpacked(body) for body in group.column(2).to_pylist()]
            sizes = [len(a[0]) for a in asks]
            keys = np.concatenate([a[0] for a in asks])
            counts = np.stack([np.concatenate([a[i] for a in asks]) for i in range(1, len(asks[0]))], axis=1)
            counts = counts.astype(np.int64)
            place = np.concatenate([np.arange(n, dtype=np.uint32) for n in sizes])
            asker = np.repeat(np.arange(len(asks)), sizes)
            order = np.argsort(keys, kind="stable")
            starts = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
            sums = np.add.reduceat(counts[order], starts, axis=0)
            n = np.diff(np.append(starts, len(order)))
            item = np.repeat(np.arange(len(starts)), n)
            owner = np.zeros(len(order), bool)
            owner[starts] = True
            shared = n[item] > 1
            row, item, owner = order[shared], item[shared], owner[shared]
            out: list[tuple] = [(None, part, None, int((sums[:, known_column] > 0).sum()))]
            back = np.lexsort((place[row], asker[row]))
            row, item, owner = row[back], item[back], owner[back]
            cuts = np.searchsorted(asker[row], np.arange(len(asks) + 1))
            for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
                if high > low:
                    found = sums[item[low:high]]
                    body = packed(place[row[low:high]], owner[low:high], *(found[:, c] for c in range(found.shape[1])))
                    out.append((blocks[i], part, body, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.int64()))],
                names=["block", "part", "body", "n_known"],
            )

    # Owners go by the order of the blocks, so a repeated task names the same ones.
    return asked.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, _ANSWERED)


def _taught(keys: np.ndarray, own: np.ndarray, parts: int, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Totals of a block's items (its own counts where nobody else asked) and whether it owns them."""
    total, owns = own.copy(), np.ones(len(own), bool)
    dealt = by_part(keys, parts)
    for part, body in zip(known.column("part").to_pylist(), known.column("body").to_pylist()):
        place, owner, *sums = unpacked(body)
        at = dealt[part][place]
        total[at], owns[at] = np.stack(sums, axis=1), owner
    return total, owns


def _marked(scorer: Scorer) -> DataFrame:
    """doc_id, text and wanted of the corpus."""
    wanted = materialise(scorer.target_ids.filter(F.col("doc_id").isNotNull()).distinct(), "targets")
    wanted = wanted.withColumn("_wanted", F.lit(True))
    if wanted.count() <= MOST_IDS:
        wanted = F.broadcast(wanted)
    marked = scorer.corpus.select("doc_id", "text").join(wanted, "doc_id", "left")
    return marked.select("doc_id", "text", F.coalesce("_wanted", F.lit(False)).alias("wanted"))


def _blocks(rows: DataFrame, counted: bool, scored: bool) -> DataFrame:
    """Rows (doc_id, text, wanted) in blocks: doc_ids, the packed texts and the number of words."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Blocks that are only scored have numbers of their own.
    base = 0 if counted else 1 << 62

    def made(number: int, ids: list[pa.Array], texts: list[np.ndarray], wanted: list[bool]) -> pa.RecordBatch:
        known, numbers = pair_ids(texts)
        lengths, flags = np.array([len(t) for t in texts], np.int64), np.array(wanted, bool)
        column = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([counted]), pa.array([scored]),
                pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column),
                pa.array([packed(known, numbers, lengths, flags)], pa.binary()),
                pa.array([len(numbers)], pa.int64()), pa.array([int(lengths[flags].sum())], pa.int64()),
            ],
            names=["block", "counted", "scored", "doc_ids", "body", "n_words", "n_target"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, filled = base + (TaskContext.get().partitionId() << 32), 0
        ids, texts, wanted = [], [], []
        for batch in slices(batches, 1024):
            low = 0
            flags = batch.column(2).to_pylist()
            words = [w.values.to_numpy(zero_copy_only=False) for w in batch.column(1)]
            for i, text in enumerate(words):
                if filled and filled + len(text) > BLOCK_WORDS:
                    if i > low:
                        ids.append(batch.column(0).slice(low, i - low))
                    yield made(number, ids, texts, wanted)
                    number, filled, low = number + 1, 0, i
                    ids, texts, wanted = [], [], []
                filled += len(text) + 1
                texts.append(text.copy())
                wanted.append(flags[i])
            if batch.num_rows > low:
                ids.append(batch.column(0).slice(low))
        if texts:
            yield made(number, ids, texts, wanted)

    rows = rows.select("doc_id", word_hashes(F.col("text")).alias("words"), "wanted")
    schema = (
        f"block long, counted boolean, scored boolean, doc_ids array<{kind}>, body binary, "
        "n_words long, n_target long"
    )
    return rows.mapInArrow(run, schema)


def _block(body: bytes, counted: bool) -> Block:
    known, ids, lengths, wanted = unpacked(body)[:4]
    return Block(known, ids, lengths, wanted, counted)


def _asked_pairs(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, counted, body in zip(*(c.to_pylist() for c in batch.columns)):
                block = _block(body, counted)
                yield _asks(number, block.pair_keys(), block.pairs, parts)

    return blocks.select("block", "counted", "body").mapInArrow(run, _ASKED)


def _asked_words(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(*(c.to_pylist() for c in batch.columns)):
                known, _, _, _, _, _, *words = unpacked(body)
                yield _asks(number, word_keys(known), np.stack(words, axis=1), parts)

    return blocks.select("block", "body").mapInArrow(run, _ASKED)


def _with_pairs(blocks: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """Blocks with the totals of their bigrams, and six numbers per word to add up over blocks.

    These are the word's count, the occurrences of the bigrams it opens, and the number of different ones
    among them that the block owns, each in the target and in all documents.
    """

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        block = _block(own.column("body")[0].as_py(), own.column("counted")[0].as_py())
        total, owns = _taught(block.pair_keys(), block.pairs, parts, found)
        kinds = [np.bincount(block.first[owns & (total[:, i] > 0)], minlength=len(block.known)) for i in range(2)]
        words = [*block.words.T, *kinds]
        flags = unpacked(own.column("body")[0].as_py())[3]
        body = packed(block.known, block.ids, block.lengths, flags, *total.T, *words)
        at = own.schema.get_field_index("body")
        return own.set_column(at, "body", pa.array([body], pa.binary()))

    cogrouped = blocks.groupBy("block").cogroup(known.groupBy("block"))
    return cogrouped.applyInArrow(run, blocks.schema)


def mean_losses(
    block: Block, pairs: np.ndarray, words: np.ndarray, totals: tuple[int, int], size: int
) -> list[np.ndarray]:
    """Mean loss per word of each non-empty text under both models.

    `pairs` and `words` hold the totals of the block's bigrams and words (as of `_with_pairs`).
    """
    lengths = block.lengths[block.lengths > 0]
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    means = []
    for i in range(2):
        share = (words[:, i] + 1) / (totals[i] + size)
        direct = words[:, 2 + i] - DISCOUNT * words[:, 4 + i]
        opened = np.maximum(np.maximum(words[:, i], words[:, 2 + i]), 1)
        left = np.maximum(1 - direct / opened, 1e-9)
        chance = np.maximum(pairs[:, i] - DISCOUNT, 0) / opened[block.first] + left[block.first] * share[block.second]
        means.append(np.add.reduceat(-np.log(chance)[block.row], starts) / lengths)
    return means


def _scored(blocks: DataFrame, known: DataFrame, parts: int, totals: tuple[int, int], size: int) -> DataFrame:
    """doc_id, n_tokens and the losses of all documents of the blocks."""

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        body = own.column("body")[0].as_py()
        block = _block(body, own.column("counted")[0].as_py())
        _, _, _, _, pair_t, pair_b, *words = unpacked(body)
        words, _ = _taught(word_keys(block.known), np.stack(words, axis=1), parts, found)
        losses = np.full((2, len(block.lengths)), np.nan)
        if len(block.ids):
            losses[:, block.lengths > 0] = mean_losses(block, np.stack([pair_t, pair_b], axis=1), words, totals, size)
        lacks = block.lengths == 0
        return pa.Table.from_arrays(
            [
                own.column("doc_ids").combine_chunks().flatten(), pa.array(block.lengths),
                *(pa.array(x, mask=lacks) for x in losses),
            ],
            names=["doc_id", "n_tokens", "loss_target", "loss_background"],
        )

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, loss_target double, loss_background double"
    return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, schema)


@contextmanager
def _by_block(blocks: DataFrame, name: str) -> Iterator[DataFrame]:
    """The stored blocks as a table in buckets of their number, so that answers come to them.

    A block is one row of several megabytes, and its answers are small: blocks stay where they are.
    """
    spark = blocks.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        blocks.write.format("parquet").option("path", path).bucketBy(buckets, "block").saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        files.delete(spark, path)


def score(documents: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background and ce_diff of every whole document."""
    same = documents is scorer.corpus
    blocks = _blocks(_marked(scorer), True, same)
    if not same:
        other = documents.select("doc_id", "text", F.lit(False).alias("wanted"))
        blocks = blocks.unionByName(_blocks(other, False, True))
    with _by_block(blocks, "blocks") as plain:  # not needed once the blocks hold their totals
        sums = plain.agg(
            F.sum("n_words"), F.sum(F.when(F.col("counted"), F.col("n_words"))), F.sum("n_target")
        ).first()
        asked, background, target = (int(n or 0) for n in sums)
        parts = max(1, asked // PART_WORDS)
        known = answers(_asked_pairs(plain, parts), 1).filter(F.col("block").isNotNull())
        blocks = materialise(_with_pairs(plain, known, parts), "counted_blocks")
    few = max(1, parts // 4)
    known = materialise(answers(_asked_words(blocks, few), 1), "answered_words")
    size = int(known.agg(F.sum("n_known")).first()[0] or 0) + 1
    own = blocks.filter("scored")
    known = known.join(own.select("block"), "block", "left_semi")
    out = _scored(own, known, few, (target, background), size)
    return out.withColumn("ce_diff", F.col("loss_target") - F.col("loss_background"))
