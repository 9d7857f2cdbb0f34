"""Relational tables through JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types of the relational tables.
ACTIVITY_TYPES = {
    "id_salarie": "VARCHAR(50)",
    "start_date": "TIMESTAMP",
    "activity_type": "VARCHAR(100)",
    "distance_m": "REAL",
    "duration_sec": "INTEGER",
}
EMPLOYEE_TYPES = {
    "id_salarie": "VARCHAR(50)",
    "salaire_brut": "VARCHAR(50)",
    "moyen_deplacement": "VARCHAR(100)",
    "nom": "VARCHAR(100)",
    "prenom": "VARCHAR(100)",
    "date_embauche": "DATE",
    "type_contrat": "VARCHAR(50)",
    "bu": "VARCHAR(100)",
}


def column_types(df: DataFrame, types: dict[str, str]) -> str:
    """Types for the columns of `df`, as the JDBC writer takes them."""
    return ", ".join(f"{name} {types[name]}" for name in df.columns if name in types)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    low: int | None = None,
    high: int | None = None,
    splits: int = 1,
    **properties: str,
) -> DataFrame:
    """Relational table; with a split column it is read by several tasks. Filters are pushed down."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split_column:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=low, upperBound=high, numPartitions=splits
        )
    return reader.load()


def append_relational(
    df: DataFrame, url: str, table: str, types: dict[str, str], batch: int = 10_000, **properties: str
) -> None:
    """Insert rows in batches, one transaction per task, and stamp them with the load time.

    The writer creates a missing table with the given column types.
    """
    stamped = df.withColumn("created_at", F.current_timestamp())
    (
        stamped.write.format("jdbc")
        .mode("append")
        .options(url=url, dbtable=table, batchsize=batch, **properties)
        .option("createTableColumnTypes", column_types(df, types))
        .save()
    )
