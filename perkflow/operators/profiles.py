"""Profiles of loads that merge to the profile of the table, and what changed between loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_K = 200
#: Largest difference in rank of a sketched quantile, with 99 % probability, for SKETCH_K.
RANK_ERROR = 0.0133


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """colonne, nombre, nuls, minimum, maximum and a quantile sketch of numeric columns, in one pass."""
    parts = []
    for name in columns:
        number = F.col(name).cast("double")
        parts.append(
            F.struct(
                F.lit(name).alias("colonne"),
                F.count(F.lit(1)).alias("nombre"),
                F.count_if(number.isNull()).alias("nuls"),
                F.min(number).alias("minimum"),
                F.max(number).alias("maximum"),
                F.kll_sketch_agg_double(number, SKETCH_K).alias("quantiles"),
            ).alias(name)
        )
    row = df.agg(*parts)
    return row.select(F.inline(F.array(*[F.col(f"`{name}`") for name in columns])))


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of parts, or of loads, as the profile of all their rows."""
    return profiles.groupBy("colonne").agg(
        F.sum("nombre").alias("nombre"),
        F.sum("nuls").alias("nuls"),
        F.min("minimum").alias("minimum"),
        F.max("maximum").alias("maximum"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def with_quantiles(profiles: DataFrame, **ranks: float) -> DataFrame:
    """Named quantiles in place of the sketch; null for a column without a value."""
    filled = F.col("nombre") > F.col("nuls")
    found = {
        name: F.when(filled, F.kll_sketch_get_quantile_double("quantiles", F.lit(rank))) for name, rank in ranks.items()
    }
    return profiles.withColumns(found).drop("quantiles")


def drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """How two profiles differ: share of nulls, and where the old median ranks among the new values.

    `rang_mediane` is near 0.5 while the values keep their distribution, null where a side has no value.
    """
    old = with_quantiles(before, mediane=0.5).select(
        "colonne", "mediane", (F.col("nuls") / F.col("nombre")).alias("part_nuls_avant")
    )
    # The rank function takes constants only: one median per column.
    medians = {row.colonne: row.mediane for row in old.collect()}
    rank = F.lit(None).cast("double")
    for name, median in medians.items():
        if median is not None:
            own = (F.col("colonne") == name) & (F.col("nombre") > F.col("nuls"))
            rank = F.when(own, F.kll_sketch_get_rank_double("quantiles", F.lit(median))).otherwise(rank)
    new = after.select(
        "colonne", (F.col("nuls") / F.col("nombre")).alias("part_nuls_apres"), rank.alias("rang_mediane")
    )
    return old.drop("mediane").join(new, "colonne")
