"""Activity counts and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perkflow.functions.pay import is_eco
from perkflow.model import ACTIVE_THRESHOLD, DECLARED, MONEY_SUM, WELLBEING_DAYS
from perkflow.operators.ordering import order_rows


def _declares(practice: str) -> Column:
    return F.coalesce(F.trim(practice) != "", F.lit(False))


def declared_counts(declared: DataFrame, practice: str = DECLARED) -> DataFrame:
    """Number of declared practices per employee; empty text and null count as none."""
    return declared.groupBy(F.col("id_salarie").cast("string").alias("id_salarie")).agg(
        F.count_if(_declares(practice)).alias("nb_activites_excel")
    )


def activity_counts(activities: DataFrame, key: str = "id_salarie") -> DataFrame:
    """Number of recorded activities per employee."""
    return activities.groupBy(F.col(key).cast("string").alias("id_salarie")).agg(
        F.count(F.lit(1)).alias("nb_activites_delta")
    )


def combine_counts(declared: DataFrame, recorded: DataFrame) -> DataFrame:
    """Full outer join of the two counts; an employee missing on one side has zero there."""
    right = recorded.withColumnRenamed("id_salarie", "id_salarie_delta")
    joined = declared.join(
        right, F.col("id_salarie").eqNullSafe(F.col("id_salarie_delta")), "full_outer"
    )
    filled = joined.select(
        F.coalesce("id_salarie", "id_salarie_delta").alias("id_salarie"),
        "nb_activites_excel",
        "nb_activites_delta",
    ).fillna(0)
    return filled.withColumn(
        "nb_activites_total", F.col("nb_activites_excel") + F.col("nb_activites_delta")
    )


def activity_totals(
    declared: DataFrame,
    activities: DataFrame,
    key: str = "id_salarie",
    practice: str = DECLARED,
) -> DataFrame:
    """Declared, recorded and total activities per employee.

    Same result as `combine_counts` of both counts. Both inputs go through one aggregation, so there
    is one shuffle of partial counts and no join to sort for.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    left = declared.select(
        F.col("id_salarie").cast("string").alias("id_salarie"),
        F.when(_declares(practice), one).otherwise(none).alias("declared"),
        none.alias("recorded"),
    )
    right = activities.select(
        F.col(key).cast("string").alias("id_salarie"), none.alias("declared"), one.alias("recorded")
    )
    return (
        left.unionByName(right)
        .groupBy("id_salarie")
        .agg(
            F.sum("declared").alias("nb_activites_excel"),
            F.sum("recorded").alias("nb_activites_delta"),
        )
        .withColumn("nb_activites_total", F.col("nb_activites_excel") + F.col("nb_activites_delta"))
    )


def active_employees(totals: DataFrame, threshold: int = ACTIVE_THRESHOLD) -> DataFrame:
    """Employees with at least `threshold` activities, most active first."""
    return totals.filter(F.col("nb_activites_total") >= threshold).orderBy(
        F.col("nb_activites_total").desc(), "id_salarie"
    )


def top_active(totals: DataFrame, n: int = 20) -> DataFrame:
    """The `n` most active employees."""
    return totals.orderBy(F.col("nb_activites_total").desc(), "id_salarie").limit(n)


def active_details(
    totals: DataFrame,
    hr: DataFrame,
    threshold: int = ACTIVE_THRESHOLD,
    ordered: bool = True,
) -> DataFrame:
    """HR details of the active employees, most active first unless `ordered` is off.

    Leave the order out where another join follows or the rows go to a table. Give stored `totals`:
    then adaptive execution splits an id with very many HR rows.
    """
    people = hr.select(
        F.col("id_salarie").cast("string").alias("id_salarie"),
        "nom",
        "prenom",
        "moyen_deplacement",
        "salaire_brut",
    )
    active = totals.filter(F.col("nb_activites_total") >= threshold)
    joined = people.join(active, "id_salarie")
    if not ordered:
        return joined
    return order_rows(joined, F.col("nb_activites_total").desc(), "id_salarie")


def eco_employees(hr: DataFrame) -> DataFrame:
    """Employees whose mode earns the bonus."""
    return hr.filter(is_eco(F.col("moyen_deplacement")))


def eco_ids(eco: DataFrame) -> DataFrame:
    """Ids of the eco employees, once each."""
    return eco.select(F.col("id_salarie").cast("string").alias("id_salarie")).distinct()


def active_and_eco(details: DataFrame, ids: DataFrame) -> DataFrame:
    """Active employees whose id is among the (stored) `eco_ids`."""
    return details.join(ids, "id_salarie", "left_semi")


def wellbeing_days(
    activities: DataFrame,
    time: str = "start_date",
    key: str = "id_salarie",
    threshold: int = ACTIVE_THRESHOLD,
) -> DataFrame:
    """Activities and extra days off per employee and year."""
    counted = activities.groupBy(
        F.col(key).cast("string").alias("id_salarie"), F.year(time).alias("annee")
    ).agg(F.count(F.lit(1)).alias("nb_activites"))
    days = F.when(F.col("nb_activites") >= threshold, WELLBEING_DAYS).otherwise(0)
    return counted.withColumn("jours_bien_etre", days)


def activity_trend(activities: DataFrame, time: str = "start_date") -> DataFrame:
    """Activities and distance per month and type."""
    return activities.groupBy(
        F.date_trunc("month", time).cast("date").alias("mois"), "activity_type"
    ).agg(
        F.count(F.lit(1)).alias("nb_activites"),
        F.sum(F.col("distance_m").try_cast("decimal(18,2)")).cast(MONEY_SUM).alias("distance_totale_m"),
    )


def employee_detail(
    hr: DataFrame, counts: DataFrame, threshold: int = ACTIVE_THRESHOLD
) -> DataFrame:
    """Every employee with the number of activities and both eligibilities.

    `counts` are the (stored) `activity_counts`.
    """
    counts = counts.withColumnRenamed("nb_activites_delta", "nb_activites")
    people = hr.select(
        F.col("id_salarie").cast("string").alias("id_salarie"), "nom", "moyen_deplacement"
    )
    joined = people.join(counts, "id_salarie", "left").fillna(0, ["nb_activites"])
    return joined.withColumns(
        {
            "prime_eligible": is_eco(F.col("moyen_deplacement")),
            "jours_bien_etre": F.when(
                F.col("nb_activites") >= threshold, WELLBEING_DAYS
            ).otherwise(0),
        }
    )
