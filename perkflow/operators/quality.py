"""Data-quality rules. Each adds boolean columns and keeps every row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.functions.commute import activity_limit_km
from perkflow.functions.dates import date_or_null
from perkflow.functions.pay import salary_amount, salary_defaulted


def check_dates(
    hr: DataFrame,
    birth: str = "date_naissance",
    hire: str = "date_embauche",
    today: date | None = None,
) -> DataFrame:
    """Birth and hire dates readable and in order: birth before hire, hire not in the future."""
    as_of: Column = F.lit(today) if today else F.current_date()
    born = date_or_null(F.col(birth).cast("string"))
    hired = date_or_null(F.col(hire).cast("string"))
    in_order = F.coalesce((born < hired) & (hired <= as_of), F.lit(False))
    return hr.withColumns(
        {
            "naissance_valide": born.isNotNull(),
            "embauche_valide": hired.isNotNull(),
            "dates_coherentes": in_order,
        }
    )


def check_salary(
    hr: DataFrame, low: Decimal, high: Decimal, salary: str = "salaire_brut"
) -> DataFrame:
    """Salary readable and within the scale."""
    text = F.col(salary).cast("string")
    inside = salary_amount(text).between(F.lit(low), F.lit(high)) & ~salary_defaulted(text)
    return hr.withColumn("salaire_dans_bareme", inside)


def check_required(
    df: DataFrame, required: Sequence[str] = ("id_salarie", "salaire_brut", "moyen_deplacement")
) -> DataFrame:
    """All mandatory fields filled."""
    filled = F.lit(True)
    for name in required:
        filled = filled & F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(False))
    return df.withColumn("champs_complets", filled)


def check_activity_distance(
    activities: DataFrame, kind: str = "activity_type", metres: str = "distance_m"
) -> DataFrame:
    """Distance in km and whether it is plausible for the type; types without limit always are."""
    limit = activity_limit_km(F.col("_kind"))
    km = F.col(metres).cast("double") / 1000
    return (
        activities.withColumn("_kind", F.lower(kind))
        .withColumns({"distance_km": km, "distance_valide": F.coalesce(km <= limit, F.lit(True))})
        .drop("_kind")
    )


def required_profile(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """colonne, presente and remplis (rows with a value) of each required column, in one pass."""
    parts = [
        F.struct(
            F.lit(name).alias("colonne"),
            F.lit(name in df.columns).alias("presente"),
            (F.count(F.col(name)) if name in df.columns else F.count(F.lit(None))).alias("remplis"),
        ).alias(f"c{i}")
        for i, name in enumerate(required)
    ]
    row = df.agg(*parts)
    return row.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(required))])))
