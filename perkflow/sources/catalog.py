"""Databases and external tables of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perkflow.sources.tables import read_if_filled


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def use_database(spark: SparkSession, name: str) -> None:
    """Create a database if it is missing and make it the current one."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")
    spark.catalog.setCurrentDatabase(name)


def register_table(spark: SparkSession, name: str, path: str) -> bool:
    """Register a table over a folder once it has rows; tell whether it is registered.

    Call it after each load: it makes partitions and files that came since known.
    """
    if read_if_filled(spark, path) is None:
        return False
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    if "batch_id" in spark.table(name).columns:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return True


def add_load(spark: SparkSession, name: str, path: str, stream_id: str, batch_id: int) -> None:
    """Make one new load of a registered table known, without listing the others."""
    place = f"{path}/stream_id={stream_id}/batch_id={batch_id}".replace("'", "\\'")
    own = stream_id.replace("'", "\\'")
    spark.sql(
        f"ALTER TABLE {quoted(name)} ADD IF NOT EXISTS "
        f"PARTITION (stream_id='{own}', batch_id={batch_id}) LOCATION '{place}'"
    )
    spark.catalog.refreshTable(name)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store rows by a key, so that joins and windows on it over tables of as many buckets move nothing.

    One file per bucket; choose the number so that a bucket fits a task.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.format("parquet").saveAsTable(quoted(name))
