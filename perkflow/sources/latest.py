"""Tables of latest versions, kept in buckets of the key.

A batch rewrites only the buckets that its keys fall into, so its cost follows the batch and the size of
a bucket, not the history. Deleted keys stay as rows with `op` d, so that an older version that comes
late does not bring them back.

Every batch is a load: `load=N/width=W/bucket=B`. It is written under a hidden name and shown by one
rename, when all of it is there. Of each bucket the newest load counts, so nothing is ever replaced in
place: a writer that dies leaves the table as it was, and readers see a load wholly or not at all. Buckets that
newer loads took over go after `KEEP_SECONDS`, when no reader can still be at them. On an object store,
where a rename copies, that window is as long as the copy.

The number of buckets, `width`, doubles when buckets grow beyond `BUCKET_BYTES`; that load rewrites the
whole table.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.operators.versions import latest_per_key
from perkflow.sources import files
from perkflow.sources.scratch import stored
from perkflow.sources.tables import read_if_filled

LOAD, WIDTH, BUCKET = "load", "width", "bucket"
FEED = "_feed"
BUCKET_BYTES = 128 << 20
KEEP_SECONDS = 3600
_PLACE = re.compile(rf"{LOAD}=(\d+)/{WIDTH}=(\d+)/{BUCKET}=(\d+)")


def _newest(paths: Iterable[str]) -> tuple[int, dict[int, int]]:
    """Width of the table, and the load that counts for each of its buckets."""
    places = {tuple(map(int, found.groups())) for found in map(_PLACE.search, paths) if found}
    width = max((w for _, w, _ in places), default=0)
    return width, {b: load for load, w, b in sorted(places) if w == width}


def _newest_rows(table: DataFrame, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of the loads that count, all of them or those of some buckets; only their files are read."""
    width, newest = _newest(table.inputFiles())
    by_load: dict[int, list[int]] = {}
    for bucket, load in newest.items():
        if buckets is None or bucket in buckets:
            by_load.setdefault(load, []).append(bucket)
    live = [(F.col(LOAD) == load) & F.col(BUCKET).isin(own) for load, own in by_load.items()]
    return table.filter(F.col(WIDTH) == width).filter(reduce(or_, live, F.lit(False)))


def loads(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete loads that still have a folder."""
    return sorted(int(n.split("=")[1]) for n in files.entries(spark, path) if n.startswith(f"{LOAD}="))


def _is_deleted(df: DataFrame):
    return F.coalesce(F.col("op"), F.lit("c")) == "d" if "op" in df.columns else F.lit(False)


def upsert_latest(
    changes: DataFrame,
    path: str,
    key: str,
    newest_by: Sequence[str],
    buckets: int = 8,
    feed: Sequence[str] = (),
    load: int | None = None,
    beside: dict[str, DataFrame] | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> list[int]:
    """Bring new versions into the table at `path`; return the buckets rewritten.

    `buckets` is the least number of buckets. Repeating a batch changes nothing. One writer at a time.

    With `feed` the load also holds what it changed: these columns of the old and the new row of each key,
    `before` and `after`, null where there is none. `beside` are more frames to store with the load, by
    folder name. Both appear and fail together with the load. `load` is its number if it is not the next.
    """
    spark = changes.sparkSession
    numbers = loads(spark, path)
    table = read_if_filled(spark, path) if numbers else None
    width = _newest(table.inputFiles())[0] if table is not None else 0
    wanted = max(width, buckets)
    while files.size(spark, path) > wanted * bucket_bytes:
        wanted *= 2
    own = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(wanted)).cast("int")
    newest = latest_per_key(changes, key, *newest_by).withColumn(BUCKET, own)
    staged = f"{path}/_next-{uuid4().hex}"
    number = load if load is not None else max(numbers, default=-1) + 1
    try:
        with stored(newest, "newest") as batch:
            touched = sorted(row[0] for row in batch.select(BUCKET).distinct().collect())
            if not touched and load is None:
                return []
            files.make_folder(spark, staged)
            if touched:
                old = None
                if table is not None:
                    # A table of another width is dealt anew, all of it.
                    rows = _newest_rows(table, touched if wanted == width else None).drop(LOAD, WIDTH)
                    old = rows.withColumn(BUCKET, own)
                merged = batch if old is None else old.unionByName(batch, allowMissingColumns=True)
                # One shuffle: versions of a key meet where their bucket is written, one file each.
                ready = latest_per_key(merged.repartition(BUCKET), [BUCKET, key], *newest_by)
                ready = ready.withColumn(WIDTH, F.lit(wanted))
                ready.write.mode("append").partitionBy(WIDTH, BUCKET).parquet(staged)
                if feed:
                    _changes(old, batch, key, newest_by, feed).write.parquet(f"{staged}/{FEED}")
            for name, rows in (beside or {}).items():
                rows.write.parquet(f"{staged}/{name}")
        files.rename(spark, staged, f"{path}/{LOAD}={number}")
    finally:
        files.delete(spark, staged)
    drop_superseded(spark, path)
    return touched


def _changes(
    old: DataFrame | None, batch: DataFrame, key: str, newest_by: Sequence[str], feed: Sequence[str]
) -> DataFrame:
    """before and after of the keys for which the batch brings the newest version."""

    def side(rows: DataFrame, new: bool) -> DataFrame:
        return rows.select(
            F.col(key).alias("_key"),
            F.struct(
                # Of two equal versions the one that is there stays.
                *newest_by, F.lit(not new).alias("_stays"), _is_deleted(rows).alias("_gone"), *feed
            ).alias("_row"),
            F.lit(new).alias("_new"),
        )

    every = side(batch, True)
    if old is not None:
        lacking = [name for name in batch.columns if name not in old.columns]
        known = old.withColumns({name: F.lit(None).cast(batch.schema[name].dataType) for name in lacking})
        mine = batch.select(F.col(key).alias("_key")).distinct()
        every = side(known, False).join(mine, "_key", "left_semi").unionByName(every)
    found = every.groupBy("_key").agg(
        F.max("_row").alias("_won"), F.max(F.when(~F.col("_new"), F.col("_row"))).alias("_old")
    )

    def image(name: str):
        return F.when(F.col(name).isNotNull() & ~F.col(f"{name}._gone"), F.struct(*[f"{name}.{c}" for c in feed]))

    changed = found.filter(~F.col("_won._stays"))
    pairs = changed.select(image("_old").alias("before"), image("_won").alias("after"))
    return pairs.filter(F.col("before").isNotNull() | F.col("after").isNotNull())


def read_feed(spark: SparkSession, path: str, load: int) -> DataFrame | None:
    """What a load changed (before, after), or None if it has no feed."""
    held = FEED in files.entries(spark, f"{path}/{LOAD}={load}")
    return read_if_filled(spark, f"{path}/{LOAD}={load}/{FEED}") if held else None


def drop_feed(spark: SparkSession, path: str, load: int) -> None:
    files.delete(spark, f"{path}/{LOAD}={load}/{FEED}")


def drop_superseded(spark: SparkSession, path: str, keep_seconds: float = KEEP_SECONDS) -> None:
    """Remove the buckets that newer loads took over at least so long ago. Folders with a feed stay."""
    changed = {int(n.split("=")[1]): t for n, t in files.entries(spark, path).items() if n.startswith(f"{LOAD}=")}
    old = [load for load, moment in changed.items() if moment < time.time() - keep_seconds]
    if len(old) < 2:
        return
    places = [
        f"{LOAD}={load}/{width}/{bucket}"
        for load in changed
        for width in files.entries(spark, f"{path}/{LOAD}={load}") if width.startswith(f"{WIDTH}=")
        for bucket in files.entries(spark, f"{path}/{LOAD}={load}/{width}") if bucket.startswith(f"{BUCKET}=")
    ]
    # Newest among the loads that have been there for long: what they took over is no longer read.
    width, settled = _newest(p for p in places if int(_PLACE.search(p)[1]) in old)
    for place in places:
        load, own, bucket = map(int, _PLACE.search(place).groups())
        if own < width or (own == width and load < settled.get(bucket, -1)):
            files.delete(spark, f"{path}/{place}")


def read_latest(table: DataFrame) -> DataFrame:
    """The rows of a table of latest versions (as `spark.read.parquet` gives it), without deleted keys."""
    rows = _newest_rows(table)
    return rows.filter(~_is_deleted(rows)).drop(LOAD, WIDTH, BUCKET)
