"""Exact top-k search by inner product with a uniform threshold in three phases.

The dimensions are cut into `LISTS` lists; a vector's score for a query is the sum of its partial scores
in all lists. A task holds some of the vectors and walks over their lists for a whole block of queries.

1. Gather: per query and list each task takes the `k` best partial scores of its vectors, adds up what those
   vectors score in all lists and reports the `k` best sums, and the lowest partial score of each list.
   The k-th best reported sum of a query is a score that k vectors reach: a safe cutoff.
2. Collect: cutoffs and lows are broadcast. Partial scores count from the low of their list, so that none
   is negative. A vector whose partial scores all lie below the cutoff divided by the number of lists cannot
   reach it; every other vector is an entry. An entry goes when its known parts and, for the lists below
   the threshold, the threshold itself still do not reach the cutoff.
3. Resolve: the remaining entries get their exact sums. A task reports at most `k` entries per query, the
   best at or above the cutoff, and a window over those reports gives the result.

Nothing is approximate and no row is left out: ties at the cutoff stay, and of more than k entries in one
task only those that k better ones of the same task precede are dropped.

Queries come in blocks of about `QUERIES`, so what is broadcast and what a task holds is bounded; every block is
one scan of the stored vectors. Vectors are never shuffled. Reports shuffle k numbers per task and query.

Components are floor(scale * x). Scores are exact: products run in 32-bit or 64-bit floats as long as all sums
fit their mantissa; vectors whose sums could exceed 2 to the 53rd stop the job.

Defined results: vectors that are null or hold null or non-finite components take no part; vectors of
different lengths are not compared, empty vectors score 0 with each other. Rows that repeat an id count as
rows: each is a candidate, and a query of its own if the id is divisible. A row without id is a candidate and
comes last among ties. Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perkflow.llm.common import slices
from perkflow.sources.scratch import materialise, scratch_path

SCALE = 256
LISTS = 4
QUERIES = 4096
_SIDE = 512  # queries at a time inside a task
_ROWS = 2048  # vectors at a time inside a task
_REPORT = "query int, totals array<double>, lows array<double>"
_FOUND = "query int, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim, top (largest absolute component) and vec, the components as integers in doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2 * _ROWS):
            at, dims, tops, packed = [], [], [], []
            for i, row in enumerate(batch.column(1)):
                if not row.is_valid or row.values.null_count:
                    continue
                vector = np.floor(row.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if np.isfinite(vector).all():
                    at.append(i)
                    dims.append(len(vector))
                    tops.append(float(np.abs(vector).max(initial=0)))
                    packed.append(vector.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())), pa.array(dims, pa.int32()),
                    pa.array(tops, pa.float64()), pa.array(packed, pa.binary()),
                ],
                names=["vec_id", "dim", "top", "vec"],
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, dim int, top double, vec binary")


@dataclass(frozen=True)
class Block:
    """Queries of one length: rows of the table by number, and their vectors."""

    rows: np.ndarray
    matrix: np.ndarray

    def cuts(self) -> list[slice]:
        """The dimensions of each list."""
        edges = np.linspace(0, self.matrix.shape[1], LISTS + 1).astype(int)
        return [slice(a, b) for a, b in zip(edges, edges[1:])]

    def parts(self, side: slice, vectors: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Partial scores (lists x queries x vectors) and the pairs of a query with its own row."""
        mine = self.matrix[side]
        scores = np.stack([mine[:, cut] @ vectors[:, cut].T for cut in self.cuts()])
        at = np.searchsorted(numbers, self.rows[side])
        own = np.flatnonzero((at < len(numbers)) & (numbers[np.minimum(at, len(numbers) - 1)] == self.rows[side]))
        return scores, np.stack([own, at[own]])


def _sides(block: Block) -> list[slice]:
    return [slice(a, min(a + _SIDE, len(block.rows))) for a in range(0, len(block.rows), _SIDE)]


def _batches(batches: Iterator[pa.RecordBatch], dim: int, kind: type) -> Iterator[tuple]:
    """Numbers (ascending), ids and vectors of the rows of a task, some at a time."""
    for batch in slices(batches, _ROWS):
        vectors = np.frombuffer(b"".join(batch.column(2).to_pylist())).reshape(batch.num_rows, dim)
        numbers = batch.column(0).to_numpy()
        order = np.argsort(numbers)
        yield numbers[order], batch.column(1).take(pa.array(order)), vectors[order].astype(kind)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each row, in no order; all if there are fewer."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def gathered(table: DataFrame, block: Block, k: int) -> DataFrame:
    """Reports of all tasks: per query the k best sums of listed vectors and the low of each list."""
    shared = table.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        n, dim = own.matrix.shape
        totals, lows, some = np.full((n, k), -np.inf), np.full((n, LISTS), np.inf), False
        for numbers, _, vectors in _batches(batches, dim, own.matrix.dtype):
            some = True
            for side in _sides(own):
                scores, same = own.parts(side, vectors, numbers)
                lows[side] = np.minimum(lows[side], scores.min(axis=2).T)
                scores[:, same[0], same[1]] = -np.inf
                total = scores.sum(axis=0, dtype=np.float64)
                listed = np.zeros(total.shape, bool)
                for one in scores:
                    np.put_along_axis(listed, _best(one, k), True, axis=1)
                total[~listed] = -np.inf
                both = np.concatenate([totals[side], np.take_along_axis(total, _best(total, k), axis=1)], axis=1)
                totals[side] = np.take_along_axis(both, _best(both, k), axis=1)
        if some:
            for at in range(0, n, _ROWS):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(at, min(at + _ROWS, n), dtype=np.int32)),
                        pa.array([row[row > -np.inf] for row in totals[at : at + _ROWS]], pa.list_(pa.float64())),
                        pa.array(list(lows[at : at + _ROWS]), pa.list_(pa.float64())),
                    ],
                    names=["query", "totals", "lows"],
                )

    return table.select("row", "vec_id", "vec").mapInArrow(run, _REPORT)


def cutoffs(reports: DataFrame, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k-th best reported sum (minus infinity if fewer) and the low of each list."""
    best = F.slice(F.sort_array(F.flatten(F.collect_list("totals")), asc=False), 1, k)
    lows = [F.min(F.col("lows")[i]).alias(f"low_{i}") for i in range(LISTS)]
    cut, low = np.full(n, -np.inf), np.zeros((n, LISTS))
    for row in reports.groupBy("query").agg(best.alias("best"), *lows).collect():  # one row per query of the block
        if len(row.best) == k:
            cut[row.query] = row.best[-1]
        low[row.query] = [row[f"low_{i}"] for i in range(LISTS)]
    return cut, low


def reaching(scores: np.ndarray, cut: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that may reach the cutoff, by the uniform threshold."""
    above = scores - low.T[:, :, None]
    need = (cut - low.sum(axis=1))[:, None]
    share = need / LISTS
    known = above >= share
    query, vector = np.nonzero(known.any(axis=0))
    most = np.where(known[:, query, vector], above[:, query, vector], share[query, 0]).sum(axis=0)
    # Sums of thresholds are rounded; a slip of one keeps an entry that the exact sum decides.
    keep = most >= need[query, 0] - 1
    return query[keep], vector[keep]


def resolved(table: DataFrame, block: Block, cut: np.ndarray, low: np.ndarray, k: int) -> DataFrame:
    """query, vec_id and score of at most k entries per task and query, at or above the cutoff."""
    shared = table.sparkSession.sparkContext.broadcast((block, cut, low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, limit, least = shared.value
        # query, score, whether the row lacks an id, id
        kept = [np.zeros(0, kind) for kind in (np.int64, np.float64, bool, np.int64)]
        for numbers, ids, vectors in _batches(batches, own.matrix.shape[1], own.matrix.dtype):
            lacks, named = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            fresh = []
            for side in _sides(own):
                scores, same = own.parts(side, vectors, numbers)
                mine = np.zeros(scores.shape[1:], bool)
                mine[same[0], same[1]] = True
                query, vector = reaching(scores, limit[side], least[side])
                others = ~mine[query, vector]
                query, vector = query[others], vector[others]
                exact = scores[:, query, vector].sum(axis=0, dtype=np.float64)
                good = exact >= limit[side][query]
                query, vector = query[good], vector[good]
                fresh.append((query + side.start, exact[good], lacks[vector], named[vector]))
            kept = _first_k([np.concatenate(columns) for columns in zip(kept, *fresh)], k)
        query, score, null, vec_id = kept
        if len(query):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query.astype(np.int32)), pa.array(vec_id, pa.int64(), mask=null),
                    pa.array(score.astype(np.int64)),
                ],
                names=["query", "vec_id", "score"],
            )

    return table.select("row", "vec_id", "vec").mapInArrow(run, _FOUND)


def _first_k(columns: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best entries of each query: higher score, then smaller id, rows without id last."""
    query, score, null, vec_id = columns
    order = np.lexsort((vec_id, null, -score, query))
    columns = [column[order] for column in columns]
    query = columns[0]
    starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
    return [column[place < k] for column in columns]


def _exact_kind(dim: int, top: float) -> type:
    """Float type in which all sums of such products are exact."""
    bound = max(dim, 1) * top * top
    if bound >= 1 << 53:
        raise ValueError(f"scores of {dim} components up to {top:.0f} do not fit 53 bits")
    return np.float32 if bound < 1 << 24 else np.float64


def search(
    vectors: DataFrame, is_query: Column, k: int, scale: int = SCALE, queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows for each row that `is_query` marks."""
    spark = vectors.sparkSession
    table = whole_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id())
    table = materialise(table, "search_vectors")
    found = []
    sizes = table.groupBy("dim").agg(
        F.max("top").alias("top"), F.sum(F.when(is_query, 1).otherwise(0)).alias("queries")
    )
    for dim, top, number in sorted(map(tuple, sizes.collect())):  # one row per length of vectors
        kind = _exact_kind(dim, top)
        own = table.filter(F.col("dim") == dim)
        blocks = -(-number // queries)
        asked = own.filter(is_query).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))))
        for part in range(blocks):
            rows = asked.filter(F.col("block") == part).select("row", "vec_id", "vec").orderBy("row").collect()
            if not rows:
                continue
            matrix = np.frombuffer(b"".join(bytes(r.vec) for r in rows)).reshape(len(rows), dim).astype(kind)
            block = Block(np.array([r.row for r in rows]), matrix)
            cut, low = cutoffs(gathered(own, block, k), len(rows), k)
            names = spark.createDataFrame([(i, r.row, r.vec_id) for i, r in enumerate(rows)], "query int, asking long, query_id long")
            path = scratch_path(spark, "found")
            resolved(own, block, cut, low, k).join(F.broadcast(names), "query").write.parquet(path)
            found.append(path)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("asking").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = spark.read.parquet(*found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
