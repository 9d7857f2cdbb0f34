"""Operators on small hand-made frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkflow.model import ACTIVITY_IMAGE
from perkflow.operators import activity, changes, cleaning, columns, commute, quality, reports, versions
from perkflow.operators.ordering import order_rows
from perkflow.sources.scratch import materialise


def rows(frame, *names):
    return sorted((tuple(row) for row in frame.select(*(names or frame.columns)).collect()), key=repr)


# --- headers and schema ------------------------------------------------------------------------


def test_headers(spark):
    names = [" Date d'embauche", "Adresse du domicile", "Moyen de déplacement", "ID salarié",
             "Pratique d'un loisir", "N°-(x)/y"]
    frame = columns.normalise_headers(spark.createDataFrame([("",) * 6], names))
    assert frame.columns == ["date_embauche", "adresse", "moyen_deplacement", "id_salarie",
                             "pratique_declaree", "n_x_y"]


def test_headers_that_clash(spark):
    with pytest.raises(ValueError, match="id_salarie"):
        columns.normalise_headers(spark.createDataFrame([(1, 2)], ["ID", "Salarié"]))


def test_discover_id(spark):
    assert columns.discover_id(spark.createDataFrame([(1, 2)], ["ts", "ID_x"])) == "ID_x"
    assert columns.discover_id(spark.createDataFrame([(1, 2)], ["ts", "nom"])) == "ts"


def test_missing_and_ensured_columns(spark):
    frame = spark.createDataFrame([(1,)], ["a"])
    assert columns.missing_columns(frame, ["a", "b"]) == ["b"]
    assert columns.ensure_column(frame, "a", F.lit(9)).first().a == 1
    assert columns.ensure_column(frame, "b", F.lit(9)).first().b == 9


def test_employee_ids(spark):
    made = columns.ensure_employee_id(spark.range(3).select(F.lit("x").alias("nom")).coalesce(1))
    assert [row.id_salarie for row in made.collect()] == ["EMP001", "EMP002", "EMP003"]
    named = columns.ensure_employee_id(spark.createDataFrame([(5,)], ["Matricule"]))
    assert named.first().id_salarie == "5"


# --- nulls and cleaning ------------------------------------------------------------------------


def test_null_profile_is_one_job(spark):
    frame = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c string")
    sc = spark.sparkContext
    sc.setJobGroup("profile", "null profile")
    found = dict(rows(cleaning.null_profile(frame)))
    jobs = len(sc.statusTracker().getJobIdsForGroup("profile"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"a": 0, "b": 1, "c": 2}
    # Map stage and result stage of the one aggregation.
    assert jobs <= 2


def test_clean_hr(spark):
    frame = spark.createDataFrame(
        [
            ("1", " dupont-martin ", "CDI", "34000 Rue d'Or", "1990-13-01", "2020-12-14", "30940", "29"),
            ("1", "second", "CDI", None, None, None, "1", "1"),
            ("2", None, None, None, "1990-07-06", "x", "abc", "29.5"),
        ],
        "id_salarie string, nom string, type_contrat string, adresse string, date_naissance string,"
        "date_embauche string, salaire_brut string, jours_cp string",
    ).withColumn("ligne", F.monotonically_increasing_id())
    found = rows(cleaning.clean_hr(frame, "ligne").drop("ligne"))
    assert found == [
        ("1", "Dupont-Martin", "Cdi", "34000 Rue D'Or", None, date(2020, 12, 14), 30940.0, 29.0),
        ("2", None, None, None, date(1990, 7, 6), None, None, 29.5),
    ]


def test_fill_defaults(spark):
    frame = spark.createDataFrame([(None, "x"), ("y", None)], "nom string, autre string")
    assert rows(cleaning.fill_defaults(frame)) == [("Inconnu", "x"), ("y", None)]


# --- versions ----------------------------------------------------------------------------------


def test_latest_and_first(spark):
    frame = spark.createDataFrame([(7, 0, "a"), (7, 2, "c"), (7, 1, "b"), (8, None, "d")], "id int, n int, v string")
    assert rows(versions.latest_per_key(frame, "id", "n")) == [(7, 2, "c"), (8, None, "d")]
    assert rows(versions.first_per_key(frame, "id", "n")) == [(7, 0, "a"), (8, None, "d")]


def test_hot_key_is_limited_before_the_shuffle(spark, tmp_path):
    spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n")
    ).write.parquet(str(tmp_path / "t"))
    frame = versions.latest_per_key(spark.read.parquet(str(tmp_path / "t")), "k", "n")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert frame.count() == 40_001
    assert frame.filter("k = 0").first().n == 59_997


# --- change events -----------------------------------------------------------------------------


MESSAGES = [
    '{"payload":{"op":"c","ts_ms":1,"after":{"id_salarie":"1","nom":"a","date_embauche":18352}}}',
    '{"payload":{"op":"u","ts_ms":2,"after":{"id_salarie":"1","nom":"b"}}}',
    '{"payload":{"op":"c","ts_ms":1,"after":{"id_salarie":"2","nom":"c"}}}',
    '{"payload":{"op":"d","ts_ms":3,"before":{"id_salarie":"2"},"after":null}}',
    '{"payload":{"op":"c","ts_ms":4,"after":{"id_salarie":3,"salaire_brut":30940}}}',
    None,
    "{broken",
    '{"schema":{}}',
    '{"payload":{"op":"u","after":null}}',
    "[1]",
    '{"payload":5}',
]


@pytest.fixture
def messages(spark):
    frame = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    return frame.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"))


def test_decode(messages):
    found = rows(changes.decode_employees(messages), "id_salarie", "nom", "salaire_brut", "op")
    assert found == [("1", "a", None, "c"), ("1", "b", None, "u"), ("2", "c", None, "c"),
                     ("3", None, "30940", "c")]
    hired = changes.decode_employees(messages).filter("nom = 'a'").first().date_embauche
    assert hired == date(2020, 3, 31)


def test_a_bad_field_is_a_reject(spark):
    texts = [
        '{"payload":{"after":{"id_salarie":"9","duration_sec":"long","distance_m":1.5}}}',
        '{"payload":{"after":{"id_salarie":"9","duration_sec":8,"distance_m":1.5}}}',
        '{"payload":{"after":{"id":"4","start_date":"zzz","id_salarie":"9"}}}',
        '{"payload":{"after":{"id":"4"}}}',
        '{"payload":{"op":"d","before":{"id":"4"}}}',
        '{"payload":{"op":"d","before":{"id_salarie":"9"}}}',
    ]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    found = changes.decode_activities(messages)
    assert rows(found, "id", "op", "duration_sec", "distance_m") == [
        ("4", "d", None, None), (None, None, 8, 1.5)]
    reasons = rows(changes.rejects(messages, ACTIVITY_IMAGE, "id"), "reason")
    assert reasons == [("bad field: duration_sec",), ("bad field: start_date",), ("no key",), ("no key",)]


def test_times_as_numbers_or_text(spark):
    times = ["1758807237827000", '"2025-09-25T13:33:57.827Z"', '"soon"', "null"]
    texts = [('{"payload":{"after":{"id_salarie":"1","start_date":%s}}}' % t,) for t in times]
    found = changes.decode_activities(spark.createDataFrame(texts, "value string"))
    moment = datetime(2025, 9, 25, 13, 33, 57, 827000)
    assert [r.start_date for r in found.collect()] == [moment, moment, None]
    days = ["18352", '"2020-03-31"', '"x"']
    texts = [('{"payload":{"after":{"id_salarie":"1","date_embauche":%s}}}' % d,) for d in days]
    found = changes.decode_employees(spark.createDataFrame(texts, "value string"))
    assert [r.date_embauche for r in found.collect()] == [date(2020, 3, 31), date(2020, 3, 31)]


def test_raw_text_stays_beside_the_row(messages):
    kept = changes.decode_employees(messages, keep_raw=True)
    assert rows(kept.filter("nom = 'a'"), "raw_value") == [(MESSAGES[0],)]


def test_current_state(messages):
    table = changes.decode_employee_changes(messages)
    current = versions.current_rows(table, "id_salarie", "cdc_ts_ms")
    assert rows(current, "id_salarie", "nom") == [("1", "b"), ("3", None)]


def test_rejects(messages):
    found = dict(rows(changes.rejects(messages, changes.EMPLOYEE_IMAGE)))
    assert found == {
        None: "empty message",
        "{broken": "broken json",
        '{"schema":{}}': "no payload",
        '{"payload":{"op":"u","after":null}}': "no new image",
        "[1]": "broken json",
        '{"payload":5}': "broken json",
    }


def test_message_is_parsed_once(messages):
    for frame in (
        changes.decode_employees(messages),
        changes.decode_employee_changes(messages),
        changes.rejects(messages, changes.EMPLOYEE_IMAGE),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1


# --- activity ----------------------------------------------------------------------------------


@pytest.fixture
def declared(spark):
    data = [(1, "Tennis"), (2, ""), (2, None), (4, "  "), (None, "Yoga")]
    return spark.createDataFrame(data, "id_salarie long, pratique_declaree string")


@pytest.fixture
def recorded(spark):
    return spark.createDataFrame([("2",)] * 20 + [("3",)] * 15 + [(None,)], "id_salarie string")


def test_declared_counts(declared):
    assert rows(activity.declared_counts(declared)) == [("1", 1), ("2", 0), ("4", 0), (None, 1)]


def test_totals(declared, recorded):
    totals = activity.activity_totals(declared, recorded)
    assert rows(totals) == [
        ("1", 1, 0, 1), ("2", 0, 20, 20), ("3", 0, 15, 15), ("4", 0, 0, 0), (None, 1, 1, 2)
    ]
    joined = activity.combine_counts(
        activity.declared_counts(declared), activity.activity_counts(recorded)
    )
    assert rows(joined) == rows(totals)


def test_active(spark, declared, recorded):
    totals = activity.activity_totals(declared, recorded)
    found = [row.id_salarie for row in activity.active_employees(totals).collect()]
    assert found == ["2", "3"]
    assert [row.id_salarie for row in activity.top_active(totals, 1).collect()] == ["2"]
    hr = spark.createDataFrame(
        [(2, "a", "b", "Marche/Running", "30000"), (3, "c", "d", "Voiture", "1"), (9, "e", "f", "x", "2")],
        "id_salarie long, nom string, prenom string, moyen_deplacement string, salaire_brut string",
    )
    details = activity.active_details(totals, hr)
    assert [(r.id_salarie, r.nom, r.nb_activites_total) for r in details.collect()] == [("2", "a", 20), ("3", "c", 15)]
    both = activity.active_and_eco(details, activity.eco_ids(activity.eco_employees(hr)))
    assert rows(both, "id_salarie") == [("2",)]
    everyone = activity.employee_detail(hr, activity.activity_counts(recorded))
    assert rows(everyone, "id_salarie", "nb_activites", "prime_eligible", "jours_bien_etre") == [
        ("2", 20, True, 5), ("3", 15, False, 5), ("9", 0, False, 0)
    ]


def test_wellbeing_days_per_year(spark):
    data = [("1", "2024-03-01")] * 14 + [("1", "2025-03-01")] * 15
    frame = spark.createDataFrame(data, "id_salarie string, d string").select(
        "id_salarie", F.to_timestamp("d").alias("start_date")
    )
    assert rows(activity.wellbeing_days(frame)) == [("1", 2024, 14, 0), ("1", 2025, 15, 5)]


# --- joins -------------------------------------------------------------------------------------


@pytest.fixture
def hot_plans(spark):
    """Joins as on a cluster with a hot key: no broadcast, small partitions, low skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def hot_people(spark):
    """Four rows in five belong to one employee."""
    number = F.when(F.col("id") % 5 > 0, 1).otherwise(F.col("id")).cast("string")
    return spark.range(0, 20_000, 1, 8).select(
        number.alias("id_salarie"),
        F.concat(F.lit("n"), F.col("id")).alias("nom"),
        F.lit("p").alias("prenom"),
        F.lit("Marche/running").alias("moyen_deplacement"),
        F.lit("1000").alias("salaire_brut"),
        F.concat(number, F.lit(" Rue")).alias("adresse"),
    )


@pytest.mark.parametrize("kind", ["details", "eco", "detail", "distance"])
def test_a_hot_key_is_split(spark, hot_plans, hot_people, kind):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("id_salarie"))
    counts = materialise(ids.withColumn("nb_activites_delta", F.lit(20)), "counts")
    totals = counts.withColumn("nb_activites_total", F.lit(20))
    if kind == "details":
        out = activity.active_details(totals, hot_people, ordered=False)
    elif kind == "eco":
        out = activity.active_and_eco(hot_people, materialise(ids, "ids"))
    elif kind == "detail":
        out = activity.employee_detail(hot_people, counts)
    else:
        places = ids.select(F.concat("id_salarie", F.lit(" Rue")).alias("adresse"), F.lit(7000).alias("distance_m"))
        out = commute.with_distance(hot_people, materialise(commute.measured_places(places), "places"))
    assert len(out.collect()) == 20_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_order_of_equal_rows(spark):
    copies = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(7).alias("k")
    )
    sorted_rows = order_rows(copies, F.col("k").desc())
    assert sorted_rows.columns == ["k"]
    keys = [r.k for r in sorted_rows.collect()]
    assert keys == sorted(keys, reverse=True)


def test_order_spreads_copies_over_tasks(spark):
    copies = spark.range(0, 40_000, 1, 8).select(F.lit(7).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = order_rows(copies, "k").rdd.glom().map(len).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(parts) < 20_000


# --- reports and quality -----------------------------------------------------------------------


def test_all_versions_against_latest(spark):
    data = [("1", "Marche/running", "1000", n) for n in range(5)] + [("2", "Voiture", "x", 0)]
    table = spark.createDataFrame(data, "id_salarie string, moyen_deplacement string, salaire_brut string, n int")
    raw = rows(reports.bonus_stats(reports.ensure_bonus(table)))
    assert raw == [("Marche/running", 5, Decimal("50.00"), Decimal("250.00")),
                   ("Voiture", 1, Decimal("0.00"), Decimal("0.00"))]
    latest = versions.latest_per_key(table, "id_salarie", "n")
    assert rows(reports.bonus_stats(reports.ensure_bonus(latest)))[0][1:] == (
        1, Decimal("50.00"), Decimal("50.00"))


def test_present_bonus_is_kept(spark):
    table = spark.createDataFrame([("1", "Marche/running", "1000", 3.0)],
                                  "id_salarie string, moyen_deplacement string, salaire_brut string, prime_annuelle double")
    assert reports.ensure_bonus(table).first().prime_annuelle == 3.0


def test_describe(spark):
    frame = spark.createDataFrame(
        [("a", 1, date(2025, 1, 1)), ("b", 2, None), (None, None, None)], "t string, n int, d date"
    )
    found = {row.colonne: row for row in reports.describe_stats(frame).collect()}
    assert found["t"][1:] == (2, None, None, "a", "b")
    assert found["n"][1:3] == (2, 1.5)
    assert found["n"][4:] == ("1", "2")
    assert found["d"][1:] == (1, None, None, "2025-01-01", "2025-01-01")


def test_quality(spark):
    hr = spark.createDataFrame(
        [("1990-01-01", "2020-01-01"), ("2021-01-01", "2020-01-01"), ("x", "2020-01-01"), ("1990-01-01", "2999-01-01"), (None, None)],
        "date_naissance string, date_embauche string",
    )
    checked = quality.check_dates(hr)
    assert [tuple(r)[2:] for r in checked.collect()] == [
        (True, True, True), (True, True, False), (False, True, False), (True, True, False), (False, False, False)
    ]
    pay = spark.createDataFrame([("20000",), ("90000",), ("abc",), (None,)], "salaire_brut string")
    scale = quality.check_salary(pay, Decimal("15000"), Decimal("80000"))
    assert [r.salaire_dans_bareme for r in scale.collect()] == [True, False, False, False]
    done = quality.check_required(spark.createDataFrame([("1", "x", "y"), ("1", " ", "y"), (None, "x", "y")],
                                                        "id_salarie string, salaire_brut string, moyen_deplacement string"))
    assert [r.champs_complets for r in done.collect()] == [True, False, False]
    moves = spark.createDataFrame([("Marche", 15000.0), ("Marche", 15001.0), ("Vélo", 25001.0), ("Yoga", 9e9), ("Marche", None)],
                                  "activity_type string, distance_m double")
    assert [r.distance_valide for r in quality.check_activity_distance(moves).collect()] == [True, False, False, True, True]


def test_distances_that_are_no_numbers(spark):
    moves = spark.createDataFrame([("1", "Yoga", float("nan")), ("1", "Yoga", 1.5)],
                                  "id_salarie string, activity_type string, distance_m double")
    dated = moves.withColumn("start_date", F.to_timestamp(F.lit("2025-01-31 00:00:00")))
    assert rows(activity.activity_trend(dated)) == [(date(2025, 1, 1), "Yoga", 2, Decimal("1.50"))]
