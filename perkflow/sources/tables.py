"""Stored tables: Parquet folders, partitioned by load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Rows of a table folder. `merge_schema` unites the columns of all its files."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_if_filled(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame | None:
    """Rows of a table folder, or None while it is missing or empty."""
    try:
        table = read_table(spark, path, merge_schema)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return None if table.isEmpty() else table


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table folder; new columns show up with `merge_schema`."""
    df.write.mode("append").parquet(path)


def write_load(df: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Write one load into its own partition folder. Writing it again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/stream_id={stream_id}/batch_id={batch_id}")


def read_load(spark: SparkSession, path: str, stream_id: str, batch_id: int) -> DataFrame:
    """The rows of one load, with its partition columns."""
    load = f"{path}/stream_id={stream_id}/batch_id={batch_id}"
    return spark.read.option("basePath", path).parquet(load)


def point_lookup(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows with one key. The value takes the type of the column, so the filter reaches the scan."""
    return df.filter(F.col(column) == F.lit(value).cast(df.schema[column].dataType))
