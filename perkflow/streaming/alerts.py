"""Alerts for new activities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perkflow.functions.alerts import alert_text
from perkflow.model import ALERT_IMAGE
from perkflow.operators.changes import envelope, payloads
from perkflow.streaming.ingest import append_stream, paced


def alerts(messages: DataFrame) -> DataFrame:
    """One alert text per activity message; messages without a new row image give none."""
    found = payloads(messages, envelope(ALERT_IMAGE), lambda p: p["after"].isNotNull())
    return found.select(
        F.col("after.id_salarie").alias("id_salarie"), alert_text(F.col("after")).alias("message")
    )


def stream_alerts(
    messages: DataFrame, outbox: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Alert texts to an outbox table, exactly once."""
    return append_stream(alerts(messages), outbox, checkpoint, interval)


def deliver(
    outbox_rows: DataFrame,
    send: Callable[[str, Iterator[Row]], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Hand the outbox rows to `send` on the executors, one call per partition of a batch.

    `send` gets a name, the same whenever the part is repeated, and an iterator over its rows. An error
    in it fails the task and Spark repeats the part, so a receiver that remembers names sees no row
    twice.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        def part(own: Iterator[Row]) -> None:
            send(f"{batch_id}-{TaskContext.get().partitionId()}", own)

        rows.foreachPartition(part)

    writer = outbox_rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return paced(writer, interval).start()
