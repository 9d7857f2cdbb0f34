"""Exports for the dashboard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.functions.pay import salary_amount
from perkflow.functions.text import decimal_comma
from perkflow.model import MONEY
from perkflow.operators.reports import bonus_stats, ensure_bonus
from perkflow.sources.scratch import stored
from perkflow.sources.tabular import write_csv


def bonus_rows(employees: DataFrame) -> DataFrame:
    """Employee id, mode, bonus and salary with money as decimals."""
    return ensure_bonus(employees).select(
        F.col("id_salarie").alias("ID_employee"),
        "moyen_deplacement",
        F.col("prime_annuelle").cast(MONEY).alias("prime_annuelle"),
        salary_amount(F.col("salaire_brut").cast("string")).alias("salaire_brut"),
    )


def with_decimal_comma(rows: DataFrame) -> DataFrame:
    """`bonus_rows` with amounts as text with a decimal comma."""
    return rows.withColumns(
        {name: decimal_comma(F.col(name)) for name in ("prime_annuelle", "salaire_brut")}
    )


def activity_export(activities: DataFrame) -> DataFrame:
    """Activities with the distance to two decimals."""
    return activities.withColumn(
        "distance_m", F.col("distance_m").cast("string").try_cast("decimal(18,2)")
    )


NAMES = {"activities": "activities.csv", "bonuses": "bonuses.csv", "statistics": "statistics.csv"}


def export_dashboard(
    folder: str,
    activities: DataFrame | None,
    employees: DataFrame | None,
    names: Mapping[str, str] = NAMES,
) -> dict[str, int]:
    """Write the three exports; each is independent of the others. Returns the rows of each.

    `employees` holds one row per employee. The statistics have one row per travel mode. `names`
    gives the file names a dashboard already reads.
    """

    def write(kind: str, rows: DataFrame) -> int:
        return write_csv(rows, f"{folder}/{names[kind]}", ";")

    done = {}
    if activities is not None:
        done["activities"] = write("activities", activity_export(activities))
    if employees is not None:
        with stored(bonus_rows(employees), "bonus_rows") as rows:
            done["bonuses"] = write("bonuses", with_decimal_comma(rows))
            done["statistics"] = write("statistics", bonus_stats(rows))
    return done
