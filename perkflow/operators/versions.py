"""Pick one row per key.

`row_number() = 1` lets Spark limit each key to one row before the shuffle (WindowGroupLimit), so a
key with very many versions sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "_rank"


def _top_row(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    window = W.partitionBy(key).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, key: str | list[str], *newest_by: str) -> DataFrame:
    """Newest row of each key by `newest_by`, compared left to right, nulls oldest."""
    return _top_row(df, key, [F.col(name).desc_nulls_last() for name in newest_by])


def first_per_key(df: DataFrame, key: str, *oldest_by: str) -> DataFrame:
    """Oldest row of each key by `oldest_by`, compared left to right, nulls last."""
    return _top_row(df, key, [F.col(name).asc_nulls_last() for name in oldest_by])


def current_rows(changes: DataFrame, key: str, *newest_by: str) -> DataFrame:
    """Latest state of each key in a change table: deleted keys are gone.

    The `op` column says what happened; only `d` removes a key.
    """
    latest = latest_per_key(changes, key, *newest_by)
    return latest.filter(F.coalesce(F.col("op"), F.lit("c")) != "d")


def current_activities(log: DataFrame) -> DataFrame:
    """Activities after all corrections and deletes. Rows without an activity id stay as they are."""
    if not {"id", "op"} <= set(log.columns):
        return log
    order = [name for name in ("cdc_ts_ms", "cdc_offset") if name in log.columns]
    named = current_rows(log.filter(F.col("id").isNotNull()), "id", *order)
    return named.unionByName(log.filter(F.col("id").isNull()))
