"""Bonus, budget and per-mode reports over employee rows.

Employee tables hold every version of a row. Reports expect one row per employee, which
`latest_per_key` or `current_rows` gives; feeding all versions reports on all versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.functions.pay import bonus_of, eco_bonus, is_eco, salary_amount
from perkflow.model import ACTIVE_THRESHOLD, MONEY, MONEY_SUM
from perkflow.operators.columns import ensure_column
from perkflow.operators.ordering import order_rows


def with_salary(employees: DataFrame) -> DataFrame:
    """Add `salaire`, the salary text as money."""
    return employees.withColumn("salaire", salary_amount(F.col("salaire_brut").cast("string")))


def ensure_bonus(employees: DataFrame) -> DataFrame:
    """Add the yearly bonus only where the table lacks it."""
    salary = salary_amount(F.col("salaire_brut").cast("string"))
    return ensure_column(
        employees, "prime_annuelle", eco_bonus(salary, F.col("moyen_deplacement"))
    )


def eco_bonuses(hr: DataFrame, ordered: bool = True) -> DataFrame:
    """Bonus of each eco employee, largest first unless `ordered` is off."""
    salary = salary_amount(F.col("salaire_brut").cast("string"))
    eco = hr.filter(is_eco(F.col("moyen_deplacement")))
    paid = eco.withColumn("prime_annuelle", bonus_of(salary))
    return order_rows(paid, F.col("prime_annuelle").desc(), "id_salarie") if ordered else paid


def eco_budget(employees: DataFrame) -> DataFrame:
    """Total, number and average of the eco bonuses, one row."""
    bonus = bonus_of(salary_amount(F.col("salaire_brut").cast("string")))
    eco = employees.filter(is_eco(F.col("moyen_deplacement"))).select(bonus.alias("prime"))
    return eco.agg(
        F.sum("prime").cast(MONEY_SUM).alias("budget_total_primes"),
        F.count(F.lit(1)).alias("nombre_employes_ecologiques"),
        F.round(F.avg("prime"), 2).cast(MONEY).alias("prime_moyenne"),
    )


def bonus_stats(employees: DataFrame) -> DataFrame:
    """Number, average and total bonus per mode, largest total first."""
    return (
        employees.groupBy("moyen_deplacement")
        .agg(
            F.count(F.lit(1)).alias("nombre_employes"),
            F.round(F.avg("prime_annuelle"), 2).cast(MONEY).alias("prime_moyenne"),
            F.sum("prime_annuelle").cast(MONEY_SUM).alias("budget_total"),
        )
        .orderBy(F.col("budget_total").desc(), "moyen_deplacement")
    )


def salary_by_mode(employees: DataFrame) -> DataFrame:
    """Average salary per mode, highest first."""
    return (
        with_salary(employees)
        .groupBy("moyen_deplacement")
        .agg(
            F.round(F.avg("salaire"), 2).cast(MONEY).alias("salaire_moyen"),
            F.count(F.lit(1)).alias("nombre_employes"),
        )
        .orderBy(F.col("salaire_moyen").desc(), "moyen_deplacement")
    )


def count_by_mode(employees: DataFrame) -> DataFrame:
    """Employees per mode, most frequent first."""
    return (
        employees.groupBy("moyen_deplacement")
        .agg(F.count(F.lit(1)).alias("nombre_employes"))
        .orderBy(F.col("nombre_employes").desc(), "moyen_deplacement")
    )


def bonus_by_mode(employees: DataFrame) -> DataFrame:
    """Average bonus per mode, highest first."""
    return (
        employees.groupBy("moyen_deplacement")
        .agg(
            F.round(F.avg("prime_annuelle"), 2).cast(MONEY).alias("prime_moyenne"),
            F.count(F.lit(1)).alias("nombre_employes"),
        )
        .orderBy(F.col("prime_moyenne").desc(), "moyen_deplacement")
    )


def mode_report_sql(employees: DataFrame, view: str = "employee_filtered") -> DataFrame:
    """Average, number and total per mode as SQL over a temporary view."""
    employees.createOrReplaceTempView(view)
    return employees.sparkSession.sql(
        f"""
        SELECT moyen_deplacement,
               CAST(ROUND(AVG(prime_annuelle), 2) AS DECIMAL(18,2)) AS prime_moyenne,
               COUNT(*) AS nombre_employes,
               CAST(SUM(prime_annuelle) AS DECIMAL(28,2)) AS budget_total
        FROM {view}
        GROUP BY moyen_deplacement
        ORDER BY prime_moyenne DESC, moyen_deplacement
        """
    )


def budget_sql(employees: DataFrame, view: str = "employee_filtered") -> DataFrame:
    """Sum of the positive bonuses as SQL over a temporary view."""
    employees.createOrReplaceTempView(view)
    return employees.sparkSession.sql(
        f"""
        SELECT CAST(SUM(prime_annuelle) AS DECIMAL(28,2)) AS budget_total_primes
        FROM {view}
        WHERE prime_annuelle > 0
        """
    )


def _as_number(df: DataFrame, name: str) -> Column:
    """Numbers as they are, text as far as it reads as one, nothing for other types."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name)
    return F.col(name).try_cast("double") if isinstance(kind, T.StringType) else F.lit(None).cast("double")


def describe_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum and maximum as one row per column, in one pass.

    Mean and deviation of text use what reads as a number.
    """
    names = list(columns or df.columns)
    aggregates = []
    for name in names:
        number = _as_number(df, name)
        aggregates.append(
            F.struct(
                F.lit(name).alias("colonne"),
                F.count(name).alias("nombre"),
                F.avg(number).cast("double").alias("moyenne"),
                F.stddev(number).alias("ecart_type"),
                F.min(name).cast("string").alias("minimum"),
                F.max(name).cast("string").alias("maximum"),
            ).alias(f"s_{name}")
        )
    row = df.agg(*aggregates)
    return row.select(F.inline(F.array(*[F.col(f"s_{name}") for name in names])))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def kpi_overview(
    employees: DataFrame, activities: DataFrame, threshold: int = ACTIVE_THRESHOLD
) -> DataFrame:
    """Main figures as rows (kpi, valeur). Employees carry `prime_annuelle`."""
    people = employees.agg(
        F.count(F.lit(1)).cast(MONEY_SUM).alias("nombre_employes"),
        F.count_if(F.col("prime_annuelle") > 0).cast(MONEY_SUM).alias("employes_avec_prime"),
        F.sum("prime_annuelle").cast(MONEY_SUM).alias("budget_total_primes"),
    )
    per_person = activities.groupBy("id_salarie").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("distance_m").try_cast("decimal(18,2)")).alias("distance"),
    )
    practice = per_person.agg(
        F.sum("n").cast(MONEY_SUM).alias("nombre_activites"),
        F.count_if(F.col("n") >= threshold).cast(MONEY_SUM).alias("employes_tres_actifs"),
        F.sum("distance").cast(MONEY_SUM).alias("distance_totale_m"),
    )
    return people.unpivot([], people.columns, "kpi", "valeur").unionByName(
        practice.unpivot([], practice.columns, "kpi", "valeur")
    )
