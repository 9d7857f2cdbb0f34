"""Streams from change messages to tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from perkflow.functions.pay import salary_defaulted
from perkflow.model import EMPLOYEE_IMAGE, VERSION_ORDER
from perkflow.operators.changes import (
    decode_activities,
    decode_employee_changes,
    raw_text,
    rejects,
    with_pay,
)
from perkflow.operators.cleaning import fill_defaults
from perkflow.sources.latest import upsert_latest
from perkflow.sources.tables import read_load, write_load

Metrics = Callable[[int, dict[str, Any]], None]


def paced(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run forever at an interval, or without one take what is there and end."""
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint."""
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
    return paced(writer.option("checkpointLocation", checkpoint), interval).start(path)


def stream_activities(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    by_month: bool = False,
) -> StreamingQuery:
    """Activity messages to the activity table.

    `by_month` adds the partition column `start_month`, so that reports on a period read only its
    months; use it with intervals long enough to fill files for each month.
    """
    rows = decode_activities(messages)
    if not by_month:
        return append_stream(rows, path, checkpoint, interval)
    month = F.date_format("start_date", "yyyy-MM")
    return append_stream(
        rows.withColumn("start_month", month), path, checkpoint, interval, ["start_month"]
    )


def stream_raw(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Key and value as text, undecoded."""
    return append_stream(raw_text(messages), path, checkpoint, interval)


def stream_rejects(
    messages: DataFrame,
    image: StructType,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    key: str = "id_salarie",
) -> StreamingQuery:
    """Messages that the table streams leave out, with their text and the reason."""
    return append_stream(rejects(messages, image, key), path, checkpoint, interval)


def show_stream(rows: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Print a stream, for debugging."""
    writer = rows.writeStream.format("console").outputMode("append").option("truncate", "false")
    return paced(writer.option("checkpointLocation", checkpoint), interval).start()


def load_employees(
    messages: DataFrame, path: str, stream_id: str, batch_id: int
) -> dict[str, Any]:
    """Decode, complete, price and store one batch of employee messages; return its figures.

    The figures (null counts before the defaults, rows written, rows with a bonus) are observed by
    the job that writes, so the batch is read once. Errors propagate: the batch then counts as not
    done and is repeated, which replaces its partition.
    """
    changes = decode_employee_changes(messages)
    names = EMPLOYEE_IMAGE.names
    is_row = F.coalesce(F.col("op"), F.lit("c")) != "d"
    seen = Observation()
    nulls = [F.count_if(is_row & F.col(name).isNull()).alias(f"null_{name}") for name in names]
    observed = changes.observe(seen, F.count(F.lit(1)).alias("messages"), *nulls)
    flagged = observed.withColumn("salary_defaulted", salary_defaulted(F.col("salaire_brut")))
    priced = with_pay(fill_defaults(flagged))
    ready = priced.withColumn("processing_timestamp", F.current_timestamp())
    written = Observation()
    final = ready.observe(
        written,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_row & (F.col("prime_annuelle") > 0)).alias("with_bonus"),
    )
    write_load(final, path, stream_id, batch_id)
    return {**seen.get, **written.get}


def stream_employees(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    on_metrics: Metrics | None = None,
    current: str | None = None,
    feed: Sequence[str] = (),
    after: Callable[[SparkSession], object] | None = None,
) -> StreamingQuery:
    """Employee messages to the employee table, one partition folder per batch.

    With `current` each stored batch also goes into the table of latest versions there, which then feeds
    the columns of `feed`; `after` runs when that is done.

    The query id is part of the folder name. It lives in the checkpoint, so a repeated batch
    replaces its own rows, and a new checkpoint cannot replace those of an older one.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream_id:
            raise RuntimeError("the batch does not tell its query id")
        figures = load_employees(batch, path, stream_id, batch_id)
        if current:
            stored = read_load(batch.sparkSession, path, stream_id, batch_id)
            upsert_latest(stored, current, "id_salarie", VERSION_ORDER, feed=feed)
        if after:
            after(batch.sparkSession)
        if on_metrics:
            on_metrics(batch_id, figures)

    writer = messages.writeStream.foreachBatch(load).outputMode("append")
    return paced(writer.option("checkpointLocation", checkpoint), interval).start()
