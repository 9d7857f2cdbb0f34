"""Batch analysis of activities and bonuses."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perkflow.model import ACTIVE_THRESHOLD
from perkflow.operators import activity, columns, reports
from perkflow.sources.scratch import materialise


def activity_analysis(
    hr: DataFrame, declared: DataFrame, activities: DataFrame, threshold: int = ACTIVE_THRESHOLD
) -> dict[str, DataFrame]:
    """Active employees, their details, the eco employees among them and the bonus budget.

    Several results build on the HR columns in use, the activity totals and the eco ids, which are
    therefore computed once and stored. A stored side of a join also lets adaptive execution split an
    id with very many rows on the other side. No result is sorted; give them an order when shown.
    """
    named = ["id_salarie", "nom", "prenom", "moyen_deplacement", "salaire_brut"]
    hr = materialise(hr.select(*named), "hr")
    totals = materialise(
        activity.activity_totals(declared, activities, columns.discover_id(activities)), "totals"
    )
    eco = activity.eco_employees(hr)
    eco_ids = materialise(activity.eco_ids(eco), "eco_ids")
    details = activity.active_details(totals, hr, threshold, ordered=False)
    return {
        "active_employees": activity.active_employees(totals, threshold),
        "active_details": details,
        "eco_employees": eco,
        "active_and_eco": activity.active_and_eco(details, eco_ids),
        "eco_bonuses": reports.eco_bonuses(hr, ordered=False),
        "eco_budget": reports.eco_budget(hr),
    }


def employee_analysis(employees: DataFrame) -> dict[str, DataFrame]:
    """Statistics per travel mode. Give the latest versions, or all of them to report on all.

    Picking the latest versions is the costly part, so the four columns in use are stored once.
    """
    lacking = columns.missing_columns(
        employees, ["id_salarie", "salaire_brut", "moyen_deplacement"]
    )
    if lacking:
        raise ValueError(f"employee table lacks {lacking}")
    ready = materialise(
        reports.ensure_bonus(employees).select(
            "id_salarie", "salaire_brut", "moyen_deplacement", "prime_annuelle"
        ),
        "employees",
    )
    return {
        "describe_stats": reports.describe_stats(ready),
        "salary_by_mode": reports.salary_by_mode(ready),
        "count_by_mode": reports.count_by_mode(ready),
        "bonus_by_mode": reports.bonus_by_mode(ready),
    }
