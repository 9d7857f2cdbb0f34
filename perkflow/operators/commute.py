"""Commute distances and their validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow import model
from perkflow.functions.commute import (
    Band,
    city_distance,
    commute_verdict,
    default_distance,
    postcode_distance,
)

VALIDATION_COLUMNS = model.VALIDATION_COLUMNS


def with_distance(
    hr: DataFrame,
    measured: DataFrame | None = None,
    located: DataFrame | None = None,
    cities: Sequence[Band] = model.CITY_BANDS,
    postcodes: Sequence[Band] = model.POSTCODE_BANDS,
) -> DataFrame:
    """Add `distance_km`: measured, else by place name, by city, by postal code, else a default.

    `measured` are the (stored) `measured_places`, and `located` the (stored) `gazetteer.located_places`,
    one row per place. Bands stand for their midpoint. The band lists are part of the plan, so their lookup
    is a projection without join or shuffle; a list of thousands of names belongs in a gazetteer.
    """
    lower = hr.withColumn("_lower", F.lower("adresse"))
    bands = [
        city_distance(F.col("_lower"), cities),
        postcode_distance(F.col("adresse"), postcodes),
        default_distance(),
    ]
    joined = lower.withColumn("_place", F.trim("adresse"))
    known = []
    for places, name in ((measured, "_measured"), (located, "_located")):
        if places is not None:
            joined = joined.join(places, "_place", "left")
            known.append(name)
    return joined.withColumn("distance_km", F.coalesce(*known, *bands)).drop("_lower", "_place", *known)


def measured_places(measured: DataFrame) -> DataFrame:
    """One distance in km per place from rows of (adresse, distance_m)."""
    return measured.groupBy(F.trim("adresse").alias("_place")).agg(
        (F.min("distance_m") / 1000).alias("_measured")
    )


def validate_commute(with_distances: DataFrame, company_address: str) -> DataFrame:
    """Add the verdict of the commute rule and the company address."""
    verdict = commute_verdict(F.col("distance_km"), F.col("_mode"))
    return (
        with_distances.withColumn("_mode", F.lower("moyen_deplacement"))
        .withColumns(
            {"validation_deplacement": verdict, "adresse_entreprise": F.lit(company_address)}
        )
        .drop("_mode")
    )


def commute_stats(validated: DataFrame) -> DataFrame:
    """Number and average distance per verdict, most frequent first."""
    return (
        validated.groupBy("validation_deplacement")
        .agg(
            F.count(F.lit(1)).alias("nombre_employes"),
            F.avg("distance_km").alias("distance_moyenne_km"),
        )
        .orderBy(F.col("nombre_employes").desc(), "validation_deplacement")
    )


def commute_errors(validated: DataFrame) -> DataFrame:
    """Declarations that break the rule or name no known mode."""
    # One pattern, so that the pushed-down filter works the verdict out once.
    wrong = f"{model.ERROR_PREFIX}|{model.UNKNOWN_MODE}"
    return validated.filter(F.col("validation_deplacement").rlike(wrong))
