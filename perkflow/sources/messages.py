"""Streams of change messages with binary key and value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "key binary, value binary"


def kafka_options(
    servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a Kafka topic. Needs the Kafka connector of Spark on the class path."""
    options = kafka_options(servers, topic, starting, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def delivered_once(messages: DataFrame, within: str = "1 day") -> DataFrame:
    """A stream of messages without those that are delivered again within a time.

    Brokers and restarted producers deliver at least once. Two messages are the same if key and value
    are; the place in the log differs. The state holds a digest per message until `within` has passed since
    it arrived. Time is that of the micro-batch, which only rises, so a message whose own time is old, or
    that lies in a partition that lags behind, is never taken for late and dropped.
    """
    text = [F.coalesce(F.base64(F.col(name)), F.lit("-")) for name in ("key", "value")]
    marked = messages.withColumns(
        {"_arrived": F.current_timestamp(), "_digest": F.sha2(F.concat_ws(":", *text), 256)}
    )
    once = marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_digest"])
    return once.drop("_arrived", "_digest")
