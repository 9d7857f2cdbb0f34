"""Place for intermediate tables and checkpoints."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from perkflow.sources.files import delete


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application below the one the session names in `spark.checkpoint.dir`.

    Without that setting it lies in the warehouse, which all executors reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/perkflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder name for an intermediate table or a checkpoint."""
    return f"{scratch_root(spark)}/{name}-{uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application. Call it when all results are written."""
    delete(spark, scratch_root(spark))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that several outputs need, and read it back.

    It outlives lost executors, and its size is known to the joins that follow.
    """
    return _write_and_read(df, scratch_path(df.sparkSession, name))


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`materialise` for as long as the block runs."""
    path = scratch_path(df.sparkSession, name)
    try:
        yield _write_and_read(df, path)
    finally:
        delete(df.sparkSession, path)


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
