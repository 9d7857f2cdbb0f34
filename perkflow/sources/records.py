"""Records of delimited files whose quoted fields hold line breaks, read in parallel.

A task that begins in the middle of a file cannot tell whether it begins inside a quoted field. It depends
on whether the quotes before it are even or odd in number, and parities add up: one scan counts the quotes
of each block, a running sum over the blocks of a file says how each begins, and a second scan then cuts
every block into records by itself. Records that reach over the end of a block come as pieces, at most
two a block (or one whole block of a very long field); these few are put together by a window over the
blocks of their file.

Quotes are as in RFC 4180: around whole fields, doubled inside. Where they stand differently, the quotes
of a file or their places do not pair, which stops the job if the file ends inside a field. Compressed files
are one block each.

The driver holds and broadcasts nine bytes per block, 128 MB of input by default.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

_RECORDS = "file string, block long, place int, header boolean, value string"
_WHOLE, _END, _BEGIN = 0, 1, 2  # a record, the end of one from before, the begin of one that goes on
_PARSE = {
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\u0000",
}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as they stand, with file and block. A line belongs to the block in which it begins."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def block_parities(spark: SparkSession, path: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per file the starts of its blocks, in order, and whether each begins inside a quoted field."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = _lines(spark, path).groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    found: dict[str, list[tuple[int, int]]] = {}
    for row in counted.collect():  # one row per block
        found.setdefault(row.file, []).append((row.block, row.odd))
    out = {}
    for file, blocks in found.items():
        blocks.sort()
        after = np.cumsum([odd for _, odd in blocks]) % 2
        if after[-1]:
            raise ValueError(f"{file} ends inside a quoted field")
        out[file] = np.array([b for b, _ in blocks]), np.concatenate(([0], after[:-1])).astype(bool)
    return out


class _Cutter:
    """Cuts the lines of one block into records and pieces, as they come."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block = file, block
        self.goes_on = inside  # whether the open lines belong to a record of the block before
        self.odd = int(inside)
        self.open: list[str] = []
        self.first = block == 0
        self.out: list[tuple] = []

    def _put(self, place: int) -> None:
        self.out.append((self.file, self.block, place, self.first, "\n".join(self.open)))
        self.first, self.open = False, []

    def take(self, lines: list[str], odd: np.ndarray) -> None:
        """More lines of the block, and whether each holds an odd number of quotes."""
        after = (np.cumsum(odd) + self.odd) % 2
        at = 0
        for stop in np.flatnonzero(after == 0):
            self.open += lines[at : stop + 1]
            at = stop + 1
            self._put(_END if self.goes_on else _WHOLE)
            self.goes_on = False
        self.open += lines[at:]
        self.odd = int(after[-1])

    def close(self) -> list[tuple]:
        if self.open:
            # The begin of a record, or the middle of one that fills the block.
            self._put(_END if self.goes_on else _BEGIN)
        return self.out


def _cut(lines: DataFrame, parities: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    shared = lines.sparkSession.sparkContext.broadcast(parities)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        columns = list(zip(*rows)) if rows else [()] * 5
        names = ["file", "block", "place", "header", "value"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter: _Cutter | None = None
        for batch in batches:
            odd = pc.count_substring(batch.column(0), '"').to_numpy(zero_copy_only=False) % 2
            values, files, blocks = (batch.column(i).to_pylist() for i in range(3))
            low = 0
            while low < len(values):
                here = files[low], blocks[low]
                high = low + 1
                while high < len(values) and (files[high], blocks[high]) == here:
                    high += 1
                if cutter is None or (cutter.file, cutter.block) != here:
                    if cutter is not None:
                        yield batch_of(cutter.close())
                    starts, inside = shared.value[here[0]]
                    cutter = _Cutter(*here, bool(inside[np.searchsorted(starts, here[1])]))
                cutter.take(values[low:high], odd[low:high])
                yield batch_of(cutter.out)
                cutter.out = []
                low = high
        if cutter is not None:
            yield batch_of(cutter.close())

    return lines.mapInArrow(run, _RECORDS)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, header (whether it is the file's first) and value of each record, line breaks kept."""
    parities = block_parities(spark, path)
    cut = _cut(_lines(spark, path), parities)
    whole = cut.filter(F.col("place") == _WHOLE).select("file", "header", "value")
    if not any(inside.any() for _, inside in parities.values()):
        return whole
    # The end of a record comes before the begin of the next one in its block.
    pieces = cut.filter(F.col("place") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "place")
    number = F.sum(F.when(F.col("place") == _BEGIN, 1).otherwise(0)).over(order)
    parts = pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.max("header").alias("header"),
        F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("parts"),
    )
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return whole.unionByName(parts.select("file", "header", joined.alias("value")))


def _plain(value):
    """A record without the mark of the file's encoding and the return of its last line end."""
    return F.regexp_replace(value, "^\ufeff|\r$", "")


def read_quoted_csv(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | None = None
) -> DataFrame:
    """Rows of delimited files with line breaks inside quotes. Without a schema all columns are text.

    All files have the same header; one that differs stops the job.
    """
    records = read_records(spark, path).withColumn("value", _plain(F.col("value")))
    first = records.filter("header").select("value").distinct().limit(2).collect()
    if not first:
        return spark.createDataFrame([], schema or T.StructType([]))
    if len(first) > 1:
        raise ValueError(f"files with different headers below {path}: {first[0].value!r}, {first[1].value!r}")
    names = next(csv.reader([first[0].value], delimiter=sep))
    if schema is not None and schema.names != names:
        raise ValueError(f"header {names} is not {schema.names}")
    kinds = [f.dataType.simpleString() for f in schema.fields] if schema else ["string"] * len(names)
    # Headers may hold any character, which a schema text may not.
    shape = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
    rows = records.filter(~F.col("header") & (F.col("value") != ""))
    return rows.select(F.from_csv("value", shape, {**_PARSE, "sep": sep}).alias("row")).select("row.*").toDF(*names)
