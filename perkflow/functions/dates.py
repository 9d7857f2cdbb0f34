"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_micros(micros: Column) -> Column:
    """Timestamp from micros since the epoch, as change events carry them."""
    return F.timestamp_micros(micros)


def from_days(days: Column) -> Column:
    """Date from days since the epoch, as change events carry them."""
    return F.date_from_unix_date(days)


def change_time(text: Column) -> Column:
    """Timestamp of a change event: micros since the epoch or ISO text."""
    return F.coalesce(from_micros(text.try_cast("bigint")), text.try_cast("timestamp"))


def change_date(text: Column) -> Column:
    """Date of a change event: days since the epoch or ISO text."""
    return F.coalesce(from_days(text.try_cast("int")), text.try_cast("date"))


def date_or_null(text: Column) -> Column:
    """Date from ISO text; null when it is none."""
    return text.try_cast("date")


def minute_text(moment: Column) -> Column:
    """Time as text to the minute."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm")
