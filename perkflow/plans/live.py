"""Change messages to tables and alerts, both streams in one session."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from perkflow.model import ACTIVITY_IMAGE, EMPLOYEE_IMAGE, VERSION_ORDER
from perkflow.operators.versions import current_rows
from perkflow.sources.latest import BUCKET, read_latest
from perkflow.streaming.alerts import stream_alerts
from perkflow.streaming.ingest import stream_activities, stream_employees, stream_rejects
from perkflow.streaming.reports import stream_mode_report
from perkflow.streaming.views import MODE_FEED, follow_modes


def start_live(
    activities: DataFrame,
    employees: DataFrame,
    root: str,
    interval: str | None = "10 seconds",
    on_metrics: Callable[[int, dict[str, Any]], None] | None = None,
) -> list[StreamingQuery]:
    """Start the activity, employee, reject, alert and report streams below one folder.

    Tables and their checkpoints lie side by side: they belong together. `mode_report` counts every
    version of an employee, `latest_mode_report` the latest ones (`views.latest_mode_report` reads it).
    """
    def place(name: str) -> tuple[str, str, str | None]:
        return f"{root}/{name}", f"{root}/checkpoints/{name}", interval

    current = f"{root}/current_employees"
    return [
        stream_activities(activities, *place("activities")),
        stream_employees(
            employees, *place("employee_prime"), on_metrics, current, MODE_FEED,
            lambda spark: follow_modes(spark, current, f"{root}/latest_mode_report"),
        ),
        stream_rejects(activities, ACTIVITY_IMAGE, *place("activity_rejects"), "id"),
        stream_rejects(employees, EMPLOYEE_IMAGE, *place("employee_rejects")),
        stream_alerts(activities, *place("alert_outbox")),
        stream_mode_report(employees, *place("mode_report")),
    ]


def current_employees(employee_table: DataFrame) -> DataFrame:
    """Latest version of each employee, without deleted ones.

    Reads a table of latest versions as it is; of a table of all versions the latest are picked.
    """
    if BUCKET in employee_table.columns:
        return read_latest(employee_table)
    order = [name for name in VERSION_ORDER if name in employee_table.columns]
    return current_rows(employee_table, "id_salarie", *order)
