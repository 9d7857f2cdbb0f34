"""Text of an activity alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkflow.functions.text import number_text
from perkflow.model import ALERT_DEFAULTS


def _field(row: Column, name: str) -> Column:
    return F.coalesce(row[name], F.lit(ALERT_DEFAULTS[name]))


def _distance(row: Column) -> Column:
    """Distance as it was written; from 1e7 on JSON parsing leaves an exponent, which is undone."""
    raw = _field(row, "distance_m")
    return F.when(raw.contains("E"), number_text(raw.try_cast("double"))).otherwise(raw)


def alert_text(row: Column) -> Column:
    """Message for one activity, five lines and a sixth when there is a comment."""
    comment = row["comment"]
    lines = F.concat(
        # Wording of the message.
        F.lit("🎯 Nouvelle activité sportive!\n👤 Employé: "),
        _field(row, "id_salarie"),
        F.lit("\n🏃 Type: "),
        _field(row, "activity_type"),
        F.lit("\n📏 Distance: "),
        _distance(row),
        F.lit("m\n⏱️ Durée: "),
        _field(row, "duration_sec"),
        F.lit("s"),
    )
    extra = F.when(comment != "", F.concat(F.lit("\n💬 Commentaire: "), comment)).otherwise("")
    return F.concat(lines, extra)
