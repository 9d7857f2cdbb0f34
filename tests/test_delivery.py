"""Messages that are delivered again."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from perkflow.sources.messages import delivered_once
from perkflow.streaming.ingest import append_stream


def put(spark, folder, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    frame.select(F.lit("k").cast("binary").alias("key"), F.col("value").cast("binary")).write.mode("append").parquet(folder)


def run(spark, folder, within):
    stream = spark.readStream.schema("key binary, value binary").parquet(f"{folder}/in")
    query = append_stream(delivered_once(stream, within), f"{folder}/out", f"{folder}/check")
    query.awaitTermination()
    rows = [r.value for r in spark.read.parquet(f"{folder}/out").select(F.col("value").cast("string")).collect()]
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return sorted(rows, key=repr), states[-1]


def test_each_message_once_also_after_a_restart_and_late_ones_stay(spark, tmp_path):
    folder = str(tmp_path)
    new, old = '{"payload":{"ts_ms":1758807237827}}', '{"payload":{"ts_ms":1}}'
    put(spark, f"{folder}/in", [new, new, None, "{broken"])
    assert run(spark, folder, "1 day")[0] == sorted([new, None, "{broken"], key=repr)
    # A message whose own time is decades old is new here.
    put(spark, f"{folder}/in", [old, new, old, "{broken"])
    assert run(spark, folder, "1 day")[0] == sorted([new, old, None, "{broken"], key=repr)


def test_the_state_is_bounded(spark, tmp_path):
    folder = str(tmp_path)
    for n in range(4):
        put(spark, f"{folder}/in", [f"{n}-{i}" for i in range(100)])
        rows, kept = run(spark, folder, "1 second")
        time.sleep(1.2)
    assert len(rows) == 400 and kept <= 200
