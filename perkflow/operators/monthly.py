"""Monthly activity figures that are kept per load and merged.

Numbers and distances add up; different employees do not, so each part keeps a sketch of them. A load is
summed up once when it comes, and reports merge the parts, whatever the number of activities behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.model import MONEY_SUM

SKETCH_BITS = 14
#: Relative error of the number of employees that two in three months stay within: 0.8 / sqrt(2 ** bits).
SKETCH_ERROR = 0.8 / 2 ** (SKETCH_BITS / 2)


def monthly_parts(activities: DataFrame, time: str = "start_date") -> DataFrame:
    """Figures of one load per month and type, with a sketch of its employees."""
    return activities.groupBy(F.date_trunc("month", time).cast("date").alias("mois"), "activity_type").agg(
        F.count(F.lit(1)).alias("nb_activites"),
        F.sum(F.col("distance_m").try_cast("decimal(18,2)")).cast(MONEY_SUM).alias("distance_totale_m"),
        F.hll_sketch_agg(F.col("id_salarie").cast("string"), SKETCH_BITS).alias("employes"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Parts of several loads as one part; merging in any order and grouping gives the same."""
    return parts.groupBy("mois", "activity_type").agg(
        F.sum("nb_activites").alias("nb_activites"),
        F.sum("distance_totale_m").cast(MONEY_SUM).alias("distance_totale_m"),
        F.hll_union_agg("employes").alias("employes"),
    )


def monthly_report(parts: DataFrame) -> DataFrame:
    """Number, distance and (estimated) different employees per month and type."""
    return merge_parts(parts).withColumn("nb_employes", F.hll_sketch_estimate("employes")).drop("employes")
