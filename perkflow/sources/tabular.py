"""Delimited files in and out."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.operators.columns import normalise_headers, widen_integers
from perkflow.operators.inference import infer_types
from perkflow.sources import files
from perkflow.sources.records import read_quoted_csv

LINE = "_line"

_FORMAT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | None = None,
    infer: bool = True,
    escape_lines: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Rows of a delimited file as they are.

    With a schema the file is read once and must have its headers. Without one an extra pass infers
    the types, unless `infer` is off and all columns are text. Inference takes leading zeros from
    ids; files with ids need a schema or `infer` off.

    `escape_lines` undoes what `write_csv` did under that name. `multi_line` reads foreign files with
    line breaks inside quotes, block by block (see `records`); inference then takes one more pass.
    """
    if multi_line:
        rows = read_quoted_csv(spark, path, sep, schema)
        rows = infer_types(rows) if infer and schema is None else rows
        return unescaped(rows) if escape_lines else rows
    # A null value that no file holds keeps a quoted empty text apart from a missing one.
    reader = spark.read.options(**_FORMAT, sep=sep, nullValue="\u0000")
    if schema is not None:
        rows = reader.option("enforceSchema", "false").schema(schema).csv(path)
    elif not infer:
        rows = reader.csv(path)
    else:
        rows = widen_integers(reader.option("inferSchema", "true").csv(path))
    return unescaped(rows) if escape_lines else rows


def with_line_order(df: DataFrame) -> DataFrame:
    """Add `_line`, which sorts like the lines of the files. Use it directly on a file read."""
    return df.withColumn(
        LINE,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_tabular(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | None = None,
    infer: bool = True,
    keep_order: bool = False,
) -> DataFrame:
    """Rows of a delimited file under normalised column names, optionally with `_line`."""
    rows = read_csv(spark, path, sep, schema, infer)
    return normalise_headers(with_line_order(rows) if keep_order else rows)


def write_csv(df: DataFrame, path: str, sep: str = ";", escape_lines: bool = False) -> int:
    """Write delimited text with a header; return the number of rows.

    The rows are computed once, into a folder of part files beside `path` that replaces `path` when
    complete. Without rows nothing is replaced. A line break inside a text would make one record two
    lines, and the file unsplittable; `escape_lines` writes it as `\\n` for `read_csv` to undo.
    """
    staged = f"{path}.{uuid4().hex}"
    seen = Observation()
    rows = escaped(df) if escape_lines else df
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        counted.write.options(**_FORMAT, sep=sep).csv(staged)
        number = seen.get["rows"]
        if number:
            files.replace(df.sparkSession, staged, path)
    finally:
        files.delete(df.sparkSession, staged)
    return number


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def escaped(df: DataFrame) -> DataFrame:
    """Texts without line breaks: backslash, line feed and return become two characters each."""
    columns = {}
    for name in _texts(df):
        text = F.replace(F.col(name), F.lit("\\"), F.lit("\\-"))
        text = F.replace(text, F.lit("\n"), F.lit("\\n"))
        columns[name] = F.replace(text, F.lit("\r"), F.lit("\\r"))
    return df.withColumns(columns) if columns else df


def unescaped(df: DataFrame) -> DataFrame:
    """The texts that `escaped` was given."""
    columns = {}
    for name in _texts(df):
        text = F.replace(F.col(name), F.lit("\\n"), F.lit("\n"))
        text = F.replace(text, F.lit("\\r"), F.lit("\r"))
        columns[name] = F.replace(text, F.lit("\\-"), F.lit("\\"))
    return df.withColumns(columns) if columns else df
