"""Prefix trie of conversations by a splitter skeleton.

A turn is 128 bits of a hash of its role and text, and a conversation the row of its turns, its path. Equal
prefixes stand together when paths are sorted, so a node of the trie is a range of the sorted paths.

1. A small sample gives splitters, pairs of a path and a conversation, which deal all conversations into
   sorted shards of about equal size. Copies of one conversation part by their id, so a group of copies
   of any size is dealt over many shards.
2. A node that reaches over a shard's end is a prefix of the splitter there. The trie of the splitter
   paths, the skeleton, is broadcast. Each task walks over its sorted shard with a stack as deep as the path
   and finishes every node outside the skeleton; of a node inside it, it writes what its shard adds.
3. The parts of the skeleton nodes are reduced by key, and one walk over the reduced skeleton brings the
   sums of the subtrees up to the root.

Sizes: the sample holds `PER_SHARD` paths a shard; a splitter is cut after `SPLIT_TURNS` turns, so the skeleton
takes at most `MAX_SHARDS` * `SPLIT_TURNS` * 16 bytes (32 MB), whatever the input. A task holds one path, the
children of the open nodes of its own shard, and hash states. The list of conversations that end at a node
is hashed as it streams by, in pieces of `CHUNK` bytes, because SHA-256 needs it in one order.

Defined results: turns go by number, those without one first, turns of one number by their hash. Null
role or text is empty. Rows without conv_id take no part; an empty table has no node, not even a root. A
repeated row is a turn that is there twice. One conversation is one row, 20 bytes a turn. Only conv_id,
turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.sources.scratch import materialise

WIDTH = 16  # bytes of a turn in a path
SHARD_TURNS = 50_000
MAX_SHARDS = 4096
PER_SHARD = 8
SPLIT_TURNS = 512
CHUNK = 8192
_BATCH = 4096
_LOCAL, _PART, _ENDS = 0, 1, 2
_SWEPT = pa.schema(
    [("kind", pa.int8()), ("node", pa.int32()), ("parent", pa.int32()), ("depth", pa.int64())]
    + [(n, pa.int64()) for n in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("size", pa.int64()), ("mark", pa.binary()), ("ends_sha256", pa.string())]
    + [("shard", pa.int32()), ("piece", pa.int32()), ("ends", pa.binary())]
)
_SWEPT_DDL = (
    "kind byte, node int, parent int, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, size long, mark binary, ends_sha256 string, "
    "shard int, piece int, ends binary"
)
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def turn_mark(role: Column, text: Column) -> Column:
    """Hex of the 128 bits that stand for a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, mark and size (bytes of the text) of each row that has a conv_id."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_mark(F.col("role").cast("string"), F.col("text").cast("string")).alias("mark"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("size"),
    ).filter(F.col("conv_id").isNotNull())


def _listed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "mark", "size"))).alias("turns"))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order."""
    return _listed(turns(conversations), "conv_id")


def rebuilt_turns(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """conv_id and turns, with the first turns exchanged for those of the family's first conversation.

    Conversation c gets the first h turns of c - c % family, then its own from the h-th on, where h is
    crc32 of c in decimal modulo `most`. A family lies in one partition, so its members meet without a join.
    """
    rows = turns(conversations).withColumn("family", F.col("conv_id") - F.col("conv_id") % family)
    own = _listed(rows.repartition("family"), "family", "conv_id")
    families = own.groupBy("family").agg(F.collect_list(F.struct("conv_id", "turns")).alias("members"))
    first = F.get(F.filter("members", lambda m: m["conv_id"] == F.col("family")), F.lit(0))["turns"]
    none = F.array().cast("array<struct<turn:bigint,mark:string,size:int>>")
    each = families.select(F.coalesce(first, none).alias("lead"), F.explode("members").alias("member"))
    h = (F.crc32(F.col("member.conv_id").cast("string").cast("binary")) % most).cast("int")
    own_turns = F.col("member.turns")
    return each.select(
        F.col("member.conv_id").alias("conv_id"),
        F.concat(F.slice("lead", F.lit(1), h), F.slice(own_turns, h + 1, F.size(own_turns))).alias("turns"),
    )


def paths(listed: DataFrame) -> DataFrame:
    """conv_id, path (marks of its turns in a row) and sizes (bytes of their texts)."""
    return listed.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that both paths begin with."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


@dataclass(frozen=True)
class Skeleton:
    """Trie of the splitter paths. Nodes are numbered depth first; 0 is the root."""

    splitters: list[tuple[bytes, int]]
    numbers: list[np.ndarray]  # per splitter, the node of each of its depths
    parents: np.ndarray

    @classmethod
    def of(cls, splitters: list[tuple[bytes, int]]) -> Skeleton:
        numbers, parents = [], [-1]
        before, own = b"", np.zeros(1, np.int32)
        for path, _ in splitters:
            depth = shared_turns(before, path)
            fresh = np.arange(len(parents), len(parents) + len(path) // WIDTH - depth, dtype=np.int32)
            own = np.concatenate((own[: depth + 1], fresh))
            parents += own[depth:-1].tolist()
            numbers.append(own)
            before = path
        return cls(splitters, numbers, np.array(parents, np.int32))

    def shard_of(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def on_path(self, shard: int, path: bytes) -> np.ndarray:
        """Skeleton nodes among the prefixes of a path of this shard, root first.

        Every splitter that has such a prefix lies beyond a splitter at an end of the shard that has it too.
        """
        best = np.zeros(1, np.int32)
        for at in (shard - 1, shard):
            if 0 <= at < len(self.splitters):
                depth = shared_turns(path, self.splitters[at][0])
                if depth >= len(best):
                    best = self.numbers[at][: depth + 1]
        return best


def skeleton(table: DataFrame, shard_turns: int = SHARD_TURNS) -> tuple[Skeleton, int]:
    """Skeleton and number of shards for a stored table of paths, from a sample of it."""
    row = table.agg(F.count(F.lit(1)), F.sum(F.octet_length("path") / WIDTH)).first()
    shards = int(min(MAX_SHARDS, max(1, -(-(row[1] or 0) // shard_turns))))
    if shards == 1:
        return Skeleton.of([]), 1
    share = min(1.0, PER_SHARD * shards / row[0])
    most = SPLIT_TURNS * WIDTH
    sample = table.sample(share, seed=11).select(
        F.substring("path", 1, most).alias("path"),
        # A cut path stands before all conversations that begin with it.
        F.when(F.octet_length("path") <= most, F.col("conv_id")).alias("conv_id"),
        (F.octet_length("path") + WIDTH).alias("weight"),
    )
    rows = sorted(
        (bytes(r.path), -(1 << 63) if r.conv_id is None else r.conv_id, r.weight) for r in sample.collect()
    )
    sums = np.cumsum([r[2] for r in rows])
    if not len(sums):
        return Skeleton.of([]), 1
    at = np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards)
    chosen = sorted({rows[i][:2] for i in np.minimum(at, len(rows) - 1)})
    return Skeleton.of(chosen), len(chosen) + 1


class _Node:
    """An open node of the walk, with the sums of what lies below it in this shard."""

    __slots__ = ("number", "mark", "size", "least", "n", "children", "leaves", "saved", "pending", "digest", "ends", "piece")

    def __init__(self, number: int, mark: bytes | None, size: int):
        self.number, self.mark, self.size = number, mark, size
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.pending: list[dict] = []
        self.digest, self.ends, self.piece = None, [], 0

    def add(self, least: int, n: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.n += n


_NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Walk:
    """Depth-first walk over the sorted paths of one shard; finished rows gather in `rows`."""

    def __init__(self, frame: Skeleton, shard: int):
        self.frame, self.shard = frame, shard
        self.before = b""
        self.stack = [_Node(0, None, 0)]
        self.rows: list[dict] = []

    def visit(self, path: bytes, conv_id: int, sizes: list[int]) -> None:
        depth = len(path) // WIDTH
        common = shared_turns(self.before, path)
        self.close(common)
        if depth > common:
            numbers = self.frame.on_path(self.shard, path)
            for d in range(common + 1, depth + 1):
                number = int(numbers[d]) if d < len(numbers) else -1
                self.stack.append(_Node(number, path[(d - 1) * WIDTH : d * WIDTH], sizes[d - 1]))
        self.before = path
        node = self.stack[-1]
        node.add(conv_id, 1)
        text = b"%d" % conv_id
        if node.number >= 0:
            node.ends.append(text)
            if len(node.ends) * 8 >= CHUNK:
                self._piece(node)
        elif node.digest is None:
            node.digest = hashlib.sha256(text)
        else:
            node.digest.update(b"," + text)

    def close(self, depth: int) -> None:
        """Finish the open nodes below this depth; -1 finishes the root as well."""
        while len(self.stack) - 1 > depth:
            own = len(self.stack) - 1
            node = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            if above is not None:
                above.add(node.least, node.n)
            row = {
                "depth": own, "conv_id": node.least, "n_convs": node.n, "n_children": node.children,
                "n_leaves": node.leaves, "saved_tokens": node.saved, "size": node.size, "mark": node.mark,
            }
            if node.number >= 0:
                self._piece(node)
                self.rows.append(row | {"kind": _PART, "node": node.number})
                continue
            row["kind"] = _LOCAL
            row["n_leaves"] = node.leaves or 1
            row["saved_tokens"] += (node.n - 1) * node.size
            row["ends_sha256"] = node.digest.hexdigest() if node.digest else _NO_ENDS
            # Only now is the smallest member known, which the children name as their parent.
            for child in node.pending:
                child["parent_conv_id"] = node.least
            self.rows += node.pending
            above.children += 1
            above.leaves += row["n_leaves"]
            above.saved += row["saved_tokens"]
            if above.number >= 0:
                self.rows.append(row | {"parent": above.number})
            else:
                above.pending.append(row)

    def _piece(self, node: _Node) -> None:
        if node.ends:
            self.rows.append({
                "kind": _ENDS, "node": node.number, "shard": self.shard, "piece": node.piece,
                "ends": b",".join(node.ends),
            })
            node.piece, node.ends = node.piece + 1, []


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_SWEPT)


def swept_shards(table: DataFrame, frame: Skeleton, shards: int) -> DataFrame:
    """Finished nodes, parts of skeleton nodes and pieces of their member lists, from all shards."""
    shared = table.sparkSession.sparkContext.broadcast(frame)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.shard_of
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            column = pa.array([of(path, conv_id) for path, conv_id in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "shard"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    if walk is None or walk.shard != row["shard"]:
                        if walk is not None:
                            walk.close(-1)
                            yield _batch(walk.rows)
                        walk = _Walk(shared.value, row["shard"])
                    walk.visit(row["path"], row["conv_id"], row["sizes"])
                    if len(walk.rows) >= _BATCH:
                        yield _batch(walk.rows)
                        walk.rows = []
        if walk is not None:
            walk.close(-1)
            yield _batch(walk.rows)

    dealt = table.mapInArrow(deal, "conv_id long, path binary, sizes array<int>, shard int")
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    return dealt.mapInArrow(sweep, _SWEPT_DDL)


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """node and ends_sha256, from the pieces of each skeleton node in order, one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            for number, ends in zip(batch.column(0).to_pylist(), batch.column(3)):
                if number == node:
                    digest.update(b",")
                else:
                    if digest:
                        yield _digest_row(node, digest.hexdigest())
                    node, digest = number, hashlib.sha256()
                digest.update(ends.as_buffer())
        if digest:
            yield _digest_row(node, digest.hexdigest())

    rows = pieces.select("node", "shard", "piece", "ends").repartition("node")
    return rows.sortWithinPartitions("node", "shard", "piece").mapInArrow(run, "node int, ends_sha256 string")


def _digest_row(node: int, digest: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([node], pa.int32()), pa.array([digest])], names=["node", "ends_sha256"]
    )


def _skeleton_nodes(parts: DataFrame, ends: DataFrame, frame: Skeleton) -> DataFrame:
    """The finished skeleton nodes. One task walks over the reduced skeleton, whose size is bounded."""
    parents = parts.sparkSession.sparkContext.broadcast(frame.parents)
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    reduced = parts.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(name).alias(name) for name in sums],
        F.min("size").alias("size"), F.min("mark").alias("mark"),
    ).join(ends, "node", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        rows = sorted((r for batch in found for r in batch.to_pylist()), key=lambda r: r["node"])
        by_node = {r["node"]: r for r in rows}
        up = parents.value
        for row in reversed(rows):  # children before parents
            row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
            row["saved_tokens"] += (row["n_convs"] - 1) * row["size"]
            row["ends_sha256"] = row["ends_sha256"] or _NO_ENDS
            above = by_node.get(int(up[row["node"]]))
            row["parent_conv_id"] = above["conv_id"] if above else None
            if above:
                above["n_children"] += 1
                above["n_leaves"] += row["n_leaves"]
                above["saved_tokens"] += row["saved_tokens"]
        names = [n for n in _SWEPT.names if n in rows[0]]
        schema = pa.schema([_SWEPT.field(n) for n in names])
        yield pa.RecordBatch.from_pylist(rows, schema=schema).select(_TOP_NAMES)

    return reduced.repartition(1).mapInArrow(run, _TOP_DDL)


_TOP_NAMES = ["node", *COLUMNS, "mark"]
_TOP_DDL = (
    "node int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, mark binary"
)


def trie(listed: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of conversations (conv_id, turns as of `conversation_turns`).

    A node is named by its smallest member `conv_id` and its `depth`. `mark` is the hash of its last turn,
    null at the root; `with_texts` adds that turn.
    """
    table = materialise(paths(listed), "paths")
    frame, shards = skeleton(table, shard_turns)
    swept = materialise(swept_shards(table, frame, shards), "swept")
    ends = _hashed_ends(swept.filter(F.col("kind") == _ENDS))
    top = materialise(_skeleton_nodes(swept.filter(F.col("kind") == _PART), ends, frame), "skeleton")
    local = swept.filter(F.col("kind") == _LOCAL).select("parent", *COLUMNS, "mark")
    above = top.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    local = local.join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return local.select(*COLUMNS, "mark").unionByName(top.select(*COLUMNS, "mark"))


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Nodes with role and text of their last turn, null at the root."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    texts = conversations.select(F.unhex(turn_mark(role, text)).alias("mark"), role.alias("role"), text.alias("text"))
    return nodes.join(texts.dropDuplicates(["mark"]), "mark", "left")
