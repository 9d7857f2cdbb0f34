"""Validation of declared travel modes against home distances."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perkflow.operators.commute import (
    VALIDATION_COLUMNS,
    commute_errors,
    commute_stats,
    measured_places,
    validate_commute,
    with_distance,
)
from perkflow.operators.gazetteer import located_places
from perkflow.sources.scratch import materialise
from perkflow.sources.tabular import write_csv


def validated_commutes(
    hr: DataFrame, company_address: str, measured: DataFrame | None = None, gazetteer: DataFrame | None = None
) -> DataFrame:
    """One verdict per employee row.

    `measured` holds (adresse, distance_m), `gazetteer` (name, position, low_km, high_km).
    """
    if measured is not None:
        measured = materialise(measured_places(measured), "places")
    located = None if gazetteer is None else materialise(located_places(hr, gazetteer), "located")
    checked = validate_commute(with_distance(hr, measured, located), company_address)
    return checked.select(*VALIDATION_COLUMNS)


def export_commutes(validated: DataFrame, folder: str) -> DataFrame:
    """Write all verdicts and the wrong ones as CSV folders; return the statistics."""
    verdicts = materialise(validated, "verdicts")
    write_csv(verdicts, f"{folder}/verdicts.csv", ",")
    write_csv(commute_errors(verdicts), f"{folder}/errors.csv", ",")
    return commute_stats(verdicts)
