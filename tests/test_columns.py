"""Types, profiles, sketches, schemas and place names."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.operators import commute, gazetteer, inference, monthly, profiles
from perkflow.sources import catalog, reconcile, tables
from perkflow.sources.scratch import materialise, scratch_path

# --- types -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-2", None, " 3 "], "bigint"), (["007", "8"], "string"), (["0", "-0"], "bigint"),
        (["1", "2.5", "1e3", ".5"], "double"), (["9223372036854775808"], "string"), (["1.5", "99999999999999999999"], "string"),
        (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29", "2024-3-1"], "date"),
        (["2023-02-29"], "string"), (["2024-02-29", "2024-02-29 10:00"], "timestamp"), (["2024-02-29T10:00:00.5"], "timestamp"),
        (["", None, "  "], "string"), (["nan", "1"], "string"), (["1d"], "string"), (["a"], "string"), ([], "string"),
    ],
)
def test_type_of_a_column(spark, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    assert [tuple(r) for r in inference.column_types(inference.type_profile(frame)).collect()] == [("x", kind)]


def test_profiles_of_parts_add_up_in_one_scan(spark):
    frame = spark.createDataFrame([("1", "a"), ("2", ""), ("x", None)], "n string, `odd name` string")
    parts = [inference.type_profile(frame.filter(F.col("n") == v)) for v in "12x"]
    merged = inference.column_types(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, inference.column_types(inference.type_profile(frame)).collect()))
    plan = inference.type_profile(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1 and plan.count("Exchange") == 1


def test_typed_rows(spark):
    frame = spark.createDataFrame([("1", "007", "2024-01-02", ""), (" 2", "8", "2024-01-03", None)], "n string, c string, d string, e string")
    typed = inference.infer_types(frame)
    assert typed.dtypes == [("n", "bigint"), ("c", "string"), ("d", "date"), ("e", "string")]
    assert typed.orderBy("n").first() == (1, "007", date(2024, 1, 2), "")


# --- schemas ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        (T.IntegerType(), T.LongType(), T.LongType()), (T.IntegerType(), T.StringType(), T.StringType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.LongType(), T.DoubleType(), T.StringType()),
        (T.LongType(), T.DecimalType(10, 2), T.DecimalType(21, 2)), (T.DecimalType(38, 0), T.DecimalType(10, 9), T.StringType()),
        (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()), (T.NullType(), T.DateType(), T.DateType()),
    ],
)
def test_widening_loses_nothing(a, b, both):
    assert reconcile.wider(a, b) == both == reconcile.wider(b, a)


def test_loads_of_other_types_and_columns(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([("a", 1)], "nom string, salaire int").write.parquet(f"{path}/load=0")
    spark.createDataFrame([("b", 2**40)], "nom string, salaire long").write.parquet(f"{path}/load=1")
    spark.createDataFrame([(Decimal("3.50"), "c", True)], "salaire decimal(9,2), nom string, actif boolean").write.parquet(f"{path}/load=2")
    spark.createDataFrame([("a", 1)], "nom string, salaire int").write.parquet(f"{path}/load=3")
    (tmp_path / "_hidden").mkdir()
    frame = reconcile.read_reconciled(spark, path)
    assert dict(frame.dtypes) == {"nom": "string", "salaire": "decimal(21,2)", "actif": "boolean"}
    assert sorted((r.nom, r.salaire, r.actif) for r in frame.collect()) == [
        ("a", Decimal(1), None), ("a", Decimal(1), None), ("b", Decimal(2**40), None), ("c", Decimal("3.50"), True)
    ]


# --- sketches --------------------------------------------------------------------------------------


def test_monthly_parts_merge_in_any_order(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 7000).alias("id_salarie"), F.make_timestamp(F.lit(2024), (F.col("id") % 3 + 1).cast("int"), F.lit(5), F.lit(1), F.lit(0), F.lit(0)).alias("start_date"),
        F.lit("Vélo").alias("activity_type"), F.when(F.col("id") % 2 == 0, 10).alias("distance_m"), "id",
    )
    parts = [materialise(monthly.monthly_parts(rows.filter(F.col("id") % 4 == n)), "part") for n in range(4)]
    once = monthly.merge_parts(parts[0].unionByName(parts[1]))
    twice = monthly.merge_parts(parts[3].unionByName(parts[2])).unionByName(once)
    found = sorted(map(tuple, monthly.monthly_report(twice).collect()))
    whole = sorted(map(tuple, monthly.monthly_report(monthly.monthly_parts(rows)).collect()))
    assert [r[:4] for r in found] == [r[:4] for r in whole]
    for row in found:
        assert abs(row[4] - 7000) <= 4 * monthly.SKETCH_ERROR * 7000


def test_profiles_merge_and_show_drift(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") * 1.5).alias("x"), F.lit(None).cast("int").alias("y"))
    parts = [profiles.profile(rows.filter(F.col("id") % 3 == n), ["x", "y"]) for n in range(3)]
    merged = profiles.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    found = {r.colonne: r for r in profiles.with_quantiles(merged, q1=0.25, mediane=0.5).collect()}
    assert (found["x"].nombre, found["x"].nuls, found["x"].minimum, found["x"].maximum) == (20_000, 2_000, 1.5, 29998.5)
    assert (found["y"].nuls, found["y"].minimum, found["y"].mediane) == (20_000, None, None)
    assert abs(found["x"].mediane / 30_000 - 0.5) <= profiles.RANK_ERROR and abs(found["x"].q1 / 30_000 - 0.25) <= profiles.RANK_ERROR
    later = profiles.profile(rows.select(F.when(F.col("id") % 2 == 0, F.col("id") + 15_000).alias("x"), "y"), ["x", "y"])
    change = {r.colonne: r for r in profiles.drift(merged, later).collect()}
    assert change["x"].part_nuls_avant == 0.1 and change["x"].part_nuls_apres == 0.5 and change["x"].rang_mediane < 0.05
    assert change["y"].rang_mediane is None
    same = {r.colonne: r for r in profiles.drift(merged, parts[0]).collect()}
    assert abs(same["x"].rang_mediane - 0.5) < 0.05


# --- places ----------------------------------------------------------------------------------------


def test_thirty_thousand_names_against_all_pairs(spark):
    rng = random.Random(4)
    parts = ["saint", "le", "la", "mont", "val", "bourg", "pont", "sur", "mer", "roc", "é", "x"]
    names = []
    for _ in range(30_000):
        words = [rng.choice(parts) + rng.choice(["", rng.choice(parts), str(rng.randrange(400))]) for _ in range(rng.randint(1, 4))]
        names.append(rng.choice(["-", " ", "'"]).join(words).title())
    names[100:103] = ["", None, " - "]
    rows = [(n, i, float(i % 50), float(i % 50 + 5)) for i, n in enumerate(names)]
    index = spark.createDataFrame(rows, "name string, position int, low_km double, high_km double")
    addresses = [f"{i} Rue du Port, 34{i:03d} {rng.choice(names[200:]).upper()}" + rng.choice(["", " Cedex", ", LE BOURG"]) for i in range(250)]
    addresses += [None, "", "nowhere at all", addresses[0], f"  {addresses[1]} "]
    people = spark.createDataFrame([(str(i), a) for i, a in enumerate(addresses)], "id_salarie string, adresse string")

    def plain(text):
        text = (text or "").lower().translate(str.maketrans("éèêàâîôûç", "eeeaaiouc"))
        return " ".join("".join(c if c.isalnum() else " " for c in text).split())

    known = [(i, f" {plain(n)} ") for i, n in enumerate(names) if plain(n)]
    wanted = {}
    for number, address in enumerate(addresses):
        padded = f" {plain(address)} "
        first = next((i for i, n in known if n in padded), None)
        wanted[str(number)] = None if first is None else first % 50 + 2.5
    places = materialise(gazetteer.located_places(people, index), "located")
    out = commute.with_distance(people, located=places).collect()
    for row in out:
        if wanted[row.id_salarie] is not None:
            assert row.distance_km == wanted[row.id_salarie]
        else:
            assert row.distance_km == 22.5
    assert sum(v is not None for v in wanted.values()) > 200
    plan = gazetteer.located_places(people, index)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_names_and_no_addresses(spark):
    index = spark.createDataFrame([], "name string, position int, low_km double, high_km double")
    people = spark.createDataFrame([("1", "Lattes")], "id_salarie string, adresse string")
    assert gazetteer.located_places(people, index).count() == 0
    assert gazetteer.located_places(people.limit(0), index).count() == 0


# --- catalog ---------------------------------------------------------------------------------------


def test_bucketed_tables_do_not_move(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").cast("string").alias("id_salarie"), "id")
    catalog.use_database(spark, "default")
    for name in ("b_one", "b_two"):
        catalog.save_bucketed(rows, name, str(tmp_path / name), "id_salarie", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_one").join(spark.table("b_two").select("id_salarie"), "id_salarie")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 100
        counted = spark.table("b_one").groupBy("id_salarie").count()
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("b_one", "b_two"):
            spark.sql(f"DROP TABLE {name}")


def test_one_new_load_is_added_without_listing(spark, tmp_path):
    path, name = str(tmp_path / "t"), f"added_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    catalog.use_database(spark, "default")
    tables.write_load(spark.range(3), path, "it's", 0)
    assert catalog.register_table(spark, name, path)
    tables.write_load(spark.range(4), path, "it's", 1)
    assert spark.table(name).count() == 3
    catalog.add_load(spark, name, path, "it's", 1)
    catalog.add_load(spark, name, path, "it's", 1)
    assert spark.table(name).count() == 7
    spark.sql(f"DROP TABLE {name}")
