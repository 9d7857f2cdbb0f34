"""Reports that follow a stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perkflow.model import MONEY, MONEY_SUM
from perkflow.operators.changes import decode_employees, with_pay
from perkflow.operators.cleaning import fill_defaults
from perkflow.sources import files
from perkflow.streaming.ingest import paced


def running_mode_report(messages: DataFrame) -> DataFrame:
    """Running number, average and total bonus per mode over all employee messages.

    The state holds one row per mode. It counts every version of an employee; a report on the
    latest versions needs the stored table, see `on_new_data`.
    """
    rows = with_pay(fill_defaults(decode_employees(messages)))
    kept = rows.filter(F.col("id_salarie").isNotNull())
    return kept.groupBy("moyen_deplacement").agg(
        F.count(F.lit(1)).alias("nombre_employes"),
        F.round(F.avg("prime_annuelle"), 2).cast(MONEY).alias("prime_moyenne"),
        F.sum("prime_annuelle").cast(MONEY_SUM).alias("budget_total"),
    )


def stream_mode_report(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the newest running report in a folder: written beside it and swapped in when complete."""

    def replace(report: DataFrame, batch_id: int) -> None:
        staged = f"{path}.next"
        report.coalesce(1).write.mode("overwrite").parquet(staged)  # one row per mode
        files.replace(report.sparkSession, staged, path)

    writer = running_mode_report(messages).writeStream.outputMode("complete").foreachBatch(replace)
    return paced(writer.option("checkpointLocation", checkpoint), interval).start()


def arrivals(spark: SparkSession, *folders: str) -> DataFrame:
    """Stream with a row per row that arrives in table folders, which need not exist yet.

    The last letter of each folder goes in brackets: a pattern, unlike a name, may match nothing.
    """
    streams = [
        spark.readStream.schema("id_salarie string").parquet(f"{path[:-1]}[{path[-1]}]").select(F.lit(1))
        for path in (folder.rstrip("/") for folder in folders)
    ]
    return reduce(DataFrame.union, streams)


def on_new_data(
    messages: DataFrame, action: Callable[[int], None], checkpoint: str, interval: str = "30 seconds"
) -> StreamingQuery:
    """Run a batch job, such as a report or an export, at an interval while new messages arrive.

    Nothing runs when nothing is new.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        action(batch_id)

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()
