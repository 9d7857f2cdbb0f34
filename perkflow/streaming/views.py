"""Sums per group that follow a table of latest versions by retraction.

Each load of the table tells what it changed. A view takes the old contribution of a changed key out of
its group and puts the new one in, so its work follows the load, not the table. A view is itself a table of
latest versions, one row per group, and its loads carry the numbers of the loads they take in: what has
been taken in is seen from the folder, a repeated load of the table changes nothing, and after a crash the
loads that are missing are taken in first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perkflow.model import ACTIVE_THRESHOLD, MONEY, MONEY_SUM, VERSION_ORDER, WELLBEING_DAYS
from perkflow.operators.changes import decode_activities, decode_employee_changes, with_pay
from perkflow.operators.cleaning import fill_defaults
from perkflow.sources.latest import drop_feed, loads, read_feed, read_latest, upsert_latest
from perkflow.sources.tables import read_if_filled
from perkflow.streaming.ingest import paced

GROUP, NUMBER, TOTAL, AS_OF = "groupe", "nombre", "total", "as_of"
EVENTS = "_events"
Fields = Callable[[Column], dict[str, Column]]
Events = Callable[[DataFrame], DataFrame]


def _deltas(feed: DataFrame, by: Fields, amount: Callable[[Column], Column]) -> DataFrame:
    """Change of number and total of each group."""
    sides = []
    for name, sign in (("before", -1), ("after", 1)):
        row = F.col(name)
        fields = [value.alias(field) for field, value in by(row).items()]
        part = feed.filter(row.isNotNull()).select(
            *fields, F.lit(sign).cast("long").alias(NUMBER), (amount(row).cast(MONEY_SUM) * sign).alias(TOTAL)
        )
        sides.append(part)
    names = sides[0].columns[:-2]
    summed = sides[0].unionByName(sides[1]).groupBy(*names).agg(
        F.sum(NUMBER).alias(NUMBER), F.sum(TOTAL).cast(MONEY_SUM).alias(TOTAL)
    )
    key = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return summed.withColumn(GROUP, key).filter((F.col(NUMBER) != 0) | (F.col(TOTAL) != 0))


def follow(
    spark: SparkSession, table: str, view: str, by: Fields,
    amount: Callable[[Column], Column] = lambda row: F.lit(0), events: Events | None = None,
) -> list[int]:
    """Take the loads of `table` that `view` lacks into it, in order; return their numbers.

    `by` names the group of a row and `amount` what it adds to the group's total; rows are structs of the
    columns that the table feeds. `events` makes rows to keep beside a load from its groups (the new values,
    and `was`, the number before).
    """
    last = max(loads(spark, view), default=-1)
    missing = [load for load in loads(spark, table) if load > last]
    for load in missing:
        _take_in(spark, table, view, load, by, amount, events)
        drop_feed(spark, table, load)
    return missing


def _take_in(
    spark: SparkSession, table: str, view: str, load: int, by: Fields,
    amount: Callable[[Column], Column], events: Events | None,
) -> None:
    feed = read_feed(spark, table, load)
    known = read_if_filled(spark, view) if loads(spark, view) else None
    if feed is None:
        if known is not None:
            rows = known.limit(0).drop("load", "width", "bucket")
            upsert_latest(rows, view, GROUP, (AS_OF,), load=load)
        return
    delta = _deltas(feed, by, amount)
    was, had = F.lit(0).cast("long"), F.lit(0).cast(MONEY_SUM)
    if known is not None:
        before = read_latest(known).select(GROUP, F.col(NUMBER).alias("_n"), F.col(TOTAL).alias("_t"))
        delta = delta.join(before, GROUP, "left")
        was, had = F.coalesce("_n", was), F.coalesce("_t", had)
    rows = delta.withColumns({
        "was": was, NUMBER: was + F.col(NUMBER), TOTAL: (had + F.col(TOTAL)).cast(MONEY_SUM),
        AS_OF: F.lit(load).cast("long"),
    }).drop("_n", "_t")
    beside = {EVENTS: events(rows)} if events else None
    upsert_latest(rows.drop("was"), view, GROUP, (AS_OF,), load=load, beside=beside)


# --- bonuses per mode ------------------------------------------------------------------------------


def _by_mode(row: Column) -> dict[str, Column]:
    return {"moyen_deplacement": row["moyen_deplacement"]}


MODE_FEED = ("moyen_deplacement", "prime_annuelle")


def follow_modes(spark: SparkSession, employees: str, view: str) -> list[int]:
    """Keep number and bonuses per mode in step with a table of latest employees that feeds MODE_FEED."""
    return follow(spark, employees, view, _by_mode, lambda row: row["prime_annuelle"])


def latest_mode_report(view: DataFrame) -> DataFrame:
    """Number, average and total bonus per mode over the latest versions, largest total first."""
    rows = read_latest(view).filter(F.col(NUMBER) > 0)
    mean = (F.col(TOTAL) / F.col(NUMBER)).cast("decimal(22,6)")
    return rows.select(
        "moyen_deplacement",
        F.col(NUMBER).alias("nombre_employes"),
        F.round(mean, 2).cast(MONEY).alias("prime_moyenne"),
        F.col(TOTAL).alias("budget_total"),
    ).orderBy(F.col("budget_total").desc(), "moyen_deplacement")


def stream_latest_report(
    messages: DataFrame, employees: str, view: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Employee messages to a table of latest versions and the report on it."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        priced = with_pay(fill_defaults(decode_employee_changes(rows)))
        order = [name for name in VERSION_ORDER if name in priced.columns]
        upsert_latest(priced, employees, "id_salarie", order, feed=MODE_FEED)
        follow_modes(rows.sparkSession, employees, view)

    writer = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return paced(writer, interval).start()


# --- well-being days -------------------------------------------------------------------------------


def _by_year(row: Column) -> dict[str, Column]:
    return {"id_salarie": row["id_salarie"], "annee": F.year(row["start_date"])}


def _crossings(threshold: int) -> Events:
    """Employees and years that reach the threshold with a load, or lose it by corrections."""

    def made(rows: DataFrame) -> DataFrame:
        event = F.when((F.col("was") < threshold) & (F.col(NUMBER) >= threshold), "reached").when(
            (F.col("was") >= threshold) & (F.col(NUMBER) < threshold), "lost"
        )
        found = rows.select("id_salarie", "annee", event.alias("event"), F.col(NUMBER).alias("nb_activites"))
        return found.filter(F.col("event").isNotNull())

    return made


def stream_eligibility(
    messages: DataFrame, activities: str, view: str, checkpoint: str,
    interval: str | None = None, threshold: int = ACTIVE_THRESHOLD,
) -> StreamingQuery:
    """Activity messages to counts per employee and year, after corrections and deletes.

    A correction takes the activity out of the employee and year it stood for. The load in which a count
    reaches the threshold keeps one event for it, and so does one in which it falls below again
    (`eligibility_events`). Messages without an activity id count once per distinct content.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        log = decode_activities(rows)
        content = F.concat(F.lit("content:"), F.md5(F.to_json(F.struct(*log.columns))))
        named = log.withColumn("id", F.coalesce("id", content))
        upsert_latest(named, activities, "id", ("cdc_ts_ms", "cdc_offset"), feed=("id_salarie", "start_date"))
        follow(rows.sparkSession, activities, view, _by_year, events=_crossings(threshold))

    writer = messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return paced(writer, interval).start()


def eligibility(view: DataFrame, threshold: int = ACTIVE_THRESHOLD) -> DataFrame:
    """Activities and extra days off per employee and year, as of the newest load."""
    rows = read_latest(view).filter(F.col(NUMBER) > 0)
    days = F.when(F.col(NUMBER) >= threshold, WELLBEING_DAYS).otherwise(0)
    return rows.select(
        "id_salarie", "annee", F.col(NUMBER).alias("nb_activites"), days.alias("jours_bien_etre")
    )


def eligibility_events(spark: SparkSession, view: str) -> DataFrame:
    """All crossings of the threshold so far: id_salarie, annee, event, nb_activites."""
    return spark.read.parquet(f"{view}/load=*/{EVENTS}")
