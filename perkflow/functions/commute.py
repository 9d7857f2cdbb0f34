"""Commute distance bands and the commute rule."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkflow import model
from perkflow.functions.text import number_text

Band = tuple[str, float, float]


def _midpoint(low: float, high: float) -> Column:
    return F.lit(round((low + high) / 2, 2)).cast("double")


def _first_band(text: Column, bands: Sequence[Band]) -> Column:
    """Midpoint of the first band whose word the text contains, else null."""
    chosen = F.when(F.lit(False), F.lit(None).cast("double"))
    for word, low, high in bands:
        chosen = chosen.when(text.contains(word), _midpoint(low, high))
    return chosen


def city_distance(lower_address: Column, bands: Sequence[Band] = model.CITY_BANDS) -> Column:
    """Distance by city name. Takes the address in lower case."""
    return _first_band(lower_address, bands)


def postcode_distance(address: Column, bands: Sequence[Band] = model.POSTCODE_BANDS) -> Column:
    """Distance by postal code."""
    return _first_band(address, bands)


def default_distance() -> Column:
    return _midpoint(*model.DEFAULT_BAND)


def contains_any(text: Column, words: Iterable[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return found


def commute_verdict(distance_km: Column, lower_mode: Column) -> Column:
    """Text result of the commute rule. Takes the mode in lower case.

    Motor vehicles and public transport are out first, then walking and riding have their limits.
    """

    def too_far(limit: int, label: str) -> Column:
        return F.concat(
            F.lit(f"{model.ERROR_PREFIX} "), number_text(distance_km), F.lit(f"km > {limit}km ({label})")
        )

    def within(limit: int, label: str) -> Column:
        return F.when(distance_km <= limit, model.VALID).otherwise(too_far(limit, label))

    return (
        F.when(distance_km.isNull() | lower_mode.isNull(), model.MISSING_DATA)
        .when(contains_any(lower_mode, model.EXCLUDED_WORDS), model.EXCLUDED)
        .when(contains_any(lower_mode, model.WALK_WORDS), within(model.WALK_LIMIT_KM, "Marche"))
        .when(contains_any(lower_mode, model.RIDE_WORDS), within(model.RIDE_LIMIT_KM, "Vélo"))
        .otherwise(model.UNKNOWN_MODE)
    )


def activity_limit_km(lower_type: Column) -> Column:
    """Longest plausible distance of an activity type, null when the type has no limit."""
    return F.when(contains_any(lower_type, model.WALK_WORDS), F.lit(model.WALK_LIMIT_KM)).when(
        contains_any(lower_type, model.RIDE_WORDS), F.lit(model.RIDE_LIMIT_KM)
    )
