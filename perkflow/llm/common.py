"""What several operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perkflow.sources.scratch import materialise

#: Words are runs of letters and digits in lower case.
NOT_WORD = r"[^\p{L}\p{N}]+"


#: Rows of an Arrow batch. Rows are whole documents, and a batch is in memory on both sides of a task.
BATCH_ROWS = 1000
_BATCHES, _USUAL = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Sets Arrow batches to BATCH_ROWS rows where the session leaves them as they are."""
    if spark.conf.get(_BATCHES) == _USUAL:
        spark.conf.set(_BATCHES, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text; an empty array for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda word: word != "")


def word_hashes(text: Column) -> Column:
    """64-bit hash of each word, in order."""
    return F.transform(words(text), lambda word: F.xxhash64(word))


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n: the fold that decides what is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most so many rows, so that memory does not follow the batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Rows that agree in the first `keys` columns; the rows come sorted by them."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for low, high in zip(starts, starts[1:]):
            here = tuple(column[low] for column in columns)
            if kept and here != last:
                yield _joined(kept)
                kept = []
            kept.append(batch.slice(low, high - low))
            last = here
    if kept:
        yield _joined(kept)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def bounded_texts(
    rows: DataFrame, chosen: DataFrame, keys: list[str], most_rows: int, most_bytes: int
) -> DataFrame:
    """`chosen` (few rows: keys and marks) with the `text` of the rows of the same keys, doc_id among them.

    A key may be repeated and a text long, so rows are bounded as well: each text of a key counts once,
    and texts are taken by the hash of their id until there are `most_rows` of them or the next one would
    exceed `most_bytes`. Which they are is decided on digests and lengths; only the texts taken move.
    """
    texts = rows.select(*keys, "text").filter(F.col("text").isNotNull())
    digest = texts.select(*keys, F.md5("text").alias("_md5"), F.octet_length("text").alias("_bytes"))
    rank = [F.xxhash64(F.col("doc_id").cast("string")), *chosen.columns, "_md5"]
    few = digest.join(F.broadcast(chosen), keys).distinct().orderBy(*rank).limit(most_rows)
    so_far = F.sum("_bytes").over(Window.orderBy(*rank).rowsBetween(Window.unboundedPreceding, 0))
    few = few.withColumn("_so_far", so_far).filter(F.col("_so_far") <= most_bytes).drop("_bytes", "_so_far")
    found = texts.join(F.broadcast(few), keys).filter(F.md5("text") == F.col("_md5"))
    return found.drop("_md5").distinct()


def learned(sample: DataFrame, fit: Callable[[list[dict]], Any]) -> Any:
    """What `fit` makes of the rows of a bounded sample. One task does it; the driver gets the result only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])

    made = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0].model) if made else fit([])


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable, for every id on an edge of `edges` (a, b).

    Minimum labels over the neighbours, then each label replaced by the label of the label, until
    nothing changes. Every round is a stored table, so lost executors cost one round at most, and a
    vertex with very many edges is a skewed join, which adaptive execution splits.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both, "edges")
    first = both.groupBy("a").agg(F.min("b").alias("label"))
    labels, total = _summed(first.select(F.col("a").alias("id"), F.least("a", "label").alias("label")))
    before = None
    while True:
        if total is None or total == before:
            return labels.withColumnRenamed("label", "component_id")
        before = total
        near = labels.select(F.col("id").alias("b"), F.col("label").alias("near"))
        hop = both.join(near, "b").groupBy("a").agg(F.min("near").alias("near"))
        stepped = labels.join(hop.withColumnRenamed("a", "id"), "id", "left").select(
            "id", F.least("label", "near").alias("label")
        )
        stepped = materialise(stepped, "labels")
        roots = stepped.select(F.col("id").alias("label"), F.col("label").alias("root"))
        jumped = stepped.join(roots, "label", "left")
        labels, total = _summed(jumped.select("id", F.least("label", "root").alias("label")))


def _summed(labels: DataFrame) -> tuple[DataFrame, Any]:
    """The stored labels and their sum, which the writing job observes."""
    seen = Observation()
    total = F.sum(F.col("label").cast("decimal(38,0)")).alias("total")
    return materialise(labels.observe(seen, total), "labels"), seen.get["total"]
