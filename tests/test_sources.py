"""Files, tables and the catalog."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from perkflow.sources import catalog, files, latest, relational, scratch, tables, tabular


def test_missing_and_empty_tables(spark, tmp_path):
    assert tables.read_if_filled(spark, str(tmp_path / "none")) is None
    (tmp_path / "bare").mkdir()
    assert tables.read_if_filled(spark, str(tmp_path / "bare")) is None
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    assert tables.read_if_filled(spark, str(tmp_path / "empty")) is None
    spark.range(2).write.parquet(str(tmp_path / "full"))
    assert tables.read_if_filled(spark, str(tmp_path / "full")).count() == 2


def test_new_columns_in_later_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_rows(spark.createDataFrame([(1,)], ["a"]), path)
    tables.append_rows(spark.createDataFrame([(2, "x")], ["a", "b"]), path)
    rows = tables.read_table(spark, path, merge_schema=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, "x")]


def test_written_again_a_load_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (3, 5):
        tables.write_load(spark.range(rows), path, "s", 0)
    tables.write_load(spark.range(2), path, "s", 1)
    assert spark.read.parquet(path).count() == 7


def test_lookup_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    frame = tables.point_lookup(spark.read.parquet(path), "id", "42")
    assert [r.id for r in frame.collect()] == [42]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,42)" in plan


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, "perks")
    try:
        assert not catalog.register_table(spark, "people", path)
        tables.write_load(spark.range(3), path, "s", 0)
        assert catalog.register_table(spark, "people", path)
        assert spark.table("people").count() == 3
        tables.write_load(spark.range(2), path, "s", 1)
        assert catalog.register_table(spark, "people", path)
        assert spark.sql("SELECT count(*) AS n FROM perks.people WHERE batch_id = 0").first().n == 3
        assert spark.table("people").count() == 5
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    data = [("007", "a;b", 'quo"te', " é ", "12.50"), ("1", "", None, "x", "0.00")]
    frame = spark.createDataFrame(data, "id string, a string, b string, c string, d string")
    assert tabular.write_csv(frame, path, ";") == 2
    back = tabular.read_csv(spark, path, ";", frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(data)


def test_empty_export_keeps_the_old_file(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    assert tabular.write_csv(spark.range(3), path) == 3
    assert tabular.write_csv(spark.range(0), path) == 0
    assert tabular.read_csv(spark, path, ";").count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["x.csv"]


def test_line_breaks_survive(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    data = [("a\nb", "\\n"), ("c\r\nd", "\\-n\\"), ("", None), ('"q";', "\\\\r\r")]
    frame = spark.createDataFrame(data, "a string, b string")
    assert tabular.write_csv(frame, path, ";", escape_lines=True) == 4
    back = tabular.read_csv(spark, path, ";", frame.schema, escape_lines=True)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(data, key=repr)
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "x.csv").glob("part-*.csv")) >= 5
    tabular.write_csv(frame, path, ";")
    foreign = tabular.read_csv(spark, path, ";", frame.schema, multi_line=True)
    assert foreign.count() == 4


def test_replacing_keeps_the_old_until_the_new_is_there(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "old"))
    with pytest.raises(OSError):
        files.replace(spark, str(tmp_path / "missing"), str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "new"))
    files.replace(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert spark.read.parquet(str(tmp_path / "old")).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["old"]


def test_latest_versions_by_bucket(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(*rows):
        frame = spark.createDataFrame(list(rows), "id_salarie string, op string, ts long, v string")
        return latest.upsert_latest(frame, path, "id_salarie", ("ts",), buckets=16)

    def state():
        return {r.id_salarie: r.v for r in latest.read_latest(spark.read.parquet(path)).collect()}

    load(*[(str(i), "c", 1, "a") for i in range(40)])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}
    touched = load(("3", "u", 2, "b"), ("3", "u", 3, "c"))
    assert len(touched) == 1
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {f"bucket={touched[0]}"}
    assert state() == {str(i): "a" for i in range(40)} | {"3": "c"}
    load(("3", "u", 2, "b"), ("3", "u", 3, "c"))  # the same batch again
    load(("4", "d", 5, None))
    load(("4", "u", 4, "late"))  # older than the delete
    assert state() == {str(i): "a" for i in range(40) if i != 4} | {"3": "c"}
    assert load() == []


def test_inferred_types(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("ID salarié,Salaire brut,Actif,Embauche,Nom\n1,2.5,true,2020-01-01 10:00:00,\n2,,false,,x\n")
    frame = tabular.read_tabular(spark, str(file))
    assert dict(frame.dtypes) == {
        "id_salarie": "bigint", "salaire_brut": "double", "actif": "boolean",
        "embauche": "timestamp", "nom": "string",
    }
    first = frame.orderBy("id_salarie").first()
    assert first.nom is None and first.embauche == datetime(2020, 1, 1, 10)


def test_line_order(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("ID salarié,Pratique d'un loisir\n" + "".join(f"{i},s\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        frame = tabular.read_tabular(spark, str(file), keep_order=True)
        assert frame.rdd.getNumPartitions() > 1
        ids = [int(r.id_salarie) for r in frame.orderBy(tabular.LINE).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == list(range(5000))


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert first.startswith(f"{root}/perkflow/{spark.sparkContext.applicationId}/x-")
    assert first != second
    stored = scratch.materialise(spark.range(3), "x")
    assert stored.count() == 3
    scratch.drop_scratch(spark)
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(first)


def test_relational_types(spark):
    frame = spark.createDataFrame([("1", "x", 2)], ["id_salarie", "autre", "duration_sec"])
    types = relational.column_types(frame, relational.ACTIVITY_TYPES)
    assert types == "id_salarie VARCHAR(50), duration_sec INTEGER"


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception) as problem:
        tables.read_if_filled(spark, str(tmp_path / "t"))
    assert not isinstance(problem.value, AnalysisException) or "PATH_NOT_FOUND" not in str(problem.value)
