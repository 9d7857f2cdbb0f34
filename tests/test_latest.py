"""Tables of latest versions: crashes, readers beside a writer, growth, and the views that follow them."""

from __future__ import annotations

import json
import random
import threading
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkflow.sources import files, latest
from perkflow.streaming import views

SCHEMA = "id_salarie string, op string, ts long, mode string, prime decimal(18,2)"


def put(spark, path, rows, **options):
    frame = spark.createDataFrame([(str(i), op, ts, mode, None if p is None else Decimal(p)) for i, op, ts, mode, p in rows], SCHEMA)
    return latest.upsert_latest(frame, path, "id_salarie", ("ts",), **options)


def state(spark, path):
    return {r.id_salarie: (r.ts, r["mode"]) for r in latest.read_latest(spark.read.parquet(path)).collect()}


def test_a_writer_that_dies_leaves_the_table_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, [(i, "c", 1, "a", 1) for i in range(50)])
    before = state(spark, path)
    real = files.rename

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(files, "rename", die)
    with pytest.raises(RuntimeError):
        put(spark, path, [(i, "u", 2, "b", 2) for i in range(25)])
    # And one that was killed before it could tidy up.
    spark.range(5).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/_next-dead")
    assert state(spark, path) == before
    monkeypatch.setattr(files, "rename", real)
    put(spark, path, [(i, "u", 2, "b", 2) for i in range(25)])
    assert state(spark, path) == before | {str(i): (2, "b") for i in range(25)}


def test_readers_beside_upserts_see_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, "c", 0, "a", 1) for i in range(200)])
    counts, problems, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                counts.append(latest.read_latest(spark.read.parquet(path)).count())
            except Exception as problem:  # noqa: BLE001
                problems.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    for ts in range(1, 4):
        put(spark, path, [(i, "u", ts, "b", 1) for i in range(0, 200, ts)])
    done.set()
    reader.join()
    assert not problems and set(counts) == {200} and len(counts) > 2


def test_buckets_double_as_the_table_grows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [(i, "c", 1, "a", 1) for i in range(100)], buckets=2)
    put(spark, path, [(1, "u", 2, "b", 1)], buckets=2, bucket_bytes=1000)
    widths = {p.name for p in (tmp_path / "t").glob("load=*/width=*")}
    assert len(widths) == 2 and "width=2" in widths
    assert state(spark, path) == {str(i): (1, "a") for i in range(100)} | {"1": (2, "b")}
    put(spark, path, [(2, "d", 3, None, None)], buckets=2, bucket_bytes=1000)
    assert state(spark, path) == {str(i): (1, "a") for i in range(100) if i != 2} | {"1": (2, "b")}


def test_superseded_buckets_go_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for ts in range(4):
        put(spark, path, [(i, "u", ts, "a", 1) for i in range(20 if ts == 0 else 2)])
    before = len(list((tmp_path / "t").rglob("part-*.parquet")))
    wanted = state(spark, path)
    latest.drop_superseded(spark, path, keep_seconds=-1)
    after = len(list((tmp_path / "t").rglob("part-*.parquet")))
    assert after < before and state(spark, path) == wanted
    assert after == len({p.parent.name for p in (tmp_path / "t").rglob("part-*.parquet")})


def test_null_keys_late_versions_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, "u", ts, f"m{ts}", ts) for i in range(9) for ts in (3, 1, 2)]
    random.Random(1).shuffle(rows)
    for n in range(0, len(rows), 7):
        put(spark, path, rows[n : n + 7])
        put(spark, path, rows[n : n + 7])
    assert state(spark, path) == {str(i): (3, "m3") for i in range(9)}
    frame = spark.createDataFrame([(None, "c", 1, "x", None)], SCHEMA)
    latest.upsert_latest(frame, path, "id_salarie", ("ts",))
    assert state(spark, path)[None] == (1, "x")


# --- views -----------------------------------------------------------------------------------------


def by_mode(row):
    return {"mode": row["mode"]}


def follow(spark, path, view):
    return views.follow(spark, path, view, by_mode, lambda row: row["prime"])


def sums(spark, view):
    rows = latest.read_latest(spark.read.parquet(view)).filter("nombre <> 0").collect()
    return {r["mode"]: (r.nombre, r.total) for r in rows}


def expected(spark, path):
    found = defaultdict(lambda: [0, Decimal(0)])
    for r in latest.read_latest(spark.read.parquet(path)).collect():
        found[r["mode"]][0] += 1
        found[r["mode"]][1] += r.prime or 0
    return {mode: tuple(v) for mode, v in found.items()}


def test_a_view_follows_changes_deletes_returns_and_late_versions(spark, tmp_path):
    path, view = str(tmp_path / "t"), str(tmp_path / "v")
    rng = random.Random(3)
    for step in range(6):
        rows = [
            (rng.randrange(30), rng.choice("cuud"), rng.randrange(100), rng.choice(["a", "b", None]), rng.randrange(9))
            for _ in range(25)
        ]
        put(spark, path, rows, feed=("mode", "prime"))
        if step % 2:  # every other time two loads are taken in
            assert len(follow(spark, path, view)) == 2
            assert sums(spark, view) == expected(spark, path)
            assert follow(spark, path, view) == []


def test_a_crash_between_table_and_view_and_a_repeated_batch(spark, tmp_path, monkeypatch):
    path, view = str(tmp_path / "t"), str(tmp_path / "v")
    first, second = [(1, "c", 1, "a", 5), (2, "c", 1, "b", 7)], [(1, "u", 2, "b", 6), (2, "d", 2, None, None)]
    put(spark, path, first, feed=("mode", "prime"))
    follow(spark, path, view)
    put(spark, path, second, feed=("mode", "prime"))  # died before the view
    put(spark, path, second, feed=("mode", "prime"))  # the batch is repeated
    follow(spark, path, view)
    assert sums(spark, view) == {"b": (1, Decimal("6.00"))} == expected(spark, path)
    put(spark, path, first, feed=("mode", "prime"))  # old versions again
    follow(spark, path, view)
    assert sums(spark, view) == {"b": (1, Decimal("6.00"))}


def move(number, owner, start, op="c", ts=1):
    row = {"id": str(number), "id_salarie": owner, "start_date": start}
    sides = {"before": {"id": str(number)}, "after": None} if op == "d" else {"after": row}
    return json.dumps({"payload": {"op": op, "ts_ms": ts, **sides}})


def run_days(spark, folder, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    frame.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary")).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema("key binary, value binary").parquet(f"{folder}/in")
    views.stream_eligibility(stream, f"{folder}/log", f"{folder}/days", f"{folder}/check").awaitTermination()
    rows = views.eligibility(spark.read.parquet(f"{folder}/days")).collect()
    return {(r.id_salarie, r.annee): (r.nb_activites, r.jours_bien_etre) for r in rows}


def test_eligibility_takes_corrections_back(spark, tmp_path):
    folder = str(tmp_path)
    found = run_days(spark, folder, [move(i, "7", "2024-05-01T10:00:00") for i in range(14)] + ["{broken"])
    assert found == {("7", 2024): (14, 0)}
    assert run_days(spark, folder, [move(14, "7", "2024-06-01T10:00:00"), move(0, "7", "2024-05-01T10:00:00")]) == {("7", 2024): (15, 5)}
    # One moves to another year, one to another employee, one is deleted, one comes late and is older.
    more = [
        move(1, "7", "2025-01-01T00:00:00", "u", 2), move(2, "8", "2024-05-01T10:00:00", "u", 2),
        move(3, "7", None, "d", 2), move(4, "9", "2020-01-01T00:00:00", "u", 0),
    ]
    assert run_days(spark, folder, more) == {("7", 2024): (12, 0), ("7", 2025): (1, 0), ("8", 2024): (1, 0)}
    back = [move(i, "7", "2024-07-01T10:00:00", "u", 3) for i in (1, 2, 3)]
    assert run_days(spark, folder, back) == {("7", 2024): (15, 5)}
    events = Counter((r.id_salarie, r.annee, r.event) for r in views.eligibility_events(spark, f"{folder}/days").collect())
    assert events == {("7", 2024, "reached"): 2, ("7", 2024, "lost"): 1}
