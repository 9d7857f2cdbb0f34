"""Whole jobs on small files, also through the command line."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from perkflow.__main__ import main, parser
from perkflow.plans import analysis, commuting, dashboard, loading
from perkflow.sources.relational import EMPLOYEE_TYPES

HR = """ID salarié,Nom,Prénom,Date de naissance,BU,Date d'embauche,Salaire brut,Type de contrat,Nombre de jours de CP,Adresse du domicile,Moyen de déplacement
1,Alpha,Ada,1990-07-06,Marketing,2020-12-14,30940,CDI,29,"1 Rue Haute, 34110 Frontignan",Transports en commun
2,Beta,Bea,1962-09-10,Support,2021-12-12,70320,CDI,29,"2 Rue Basse, 34970 Lattes",Marche/running
2,Doublon,Bea,1962-09-10,Support,2021-12-12,1,CDI,29,"2 Rue Basse, 34970 Lattes",Marche/running
3,Gamma,Guy,1980-01-01,Ventes,2022-03-29,33130,CDD,25,"3 Rue Neuve, 30900 Nîmes",Vélo/Trottinette/Autres
"""
PRACTICE = "ID salarié,Pratique d'un loisir\n1,\n2,Tennis\n3,Yoga\n"


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "hr.csv").write_text(HR)
    (tmp_path / "declared.csv").write_text(PRACTICE)
    activities = spark.range(20).select(
        F.when(F.col("id") < 16, "2").otherwise("3").alias("id_salarie"),
        F.to_timestamp(F.lit("2025-01-02 03:04:05")).alias("start_date"),
        F.lit("Tennis").alias("activity_type"),
        F.lit(6034.94).cast("float").alias("distance_m"),
        F.lit(807).alias("duration_sec"),
        F.lit("ok").alias("comment"),
    )
    activities.write.parquet(str(tmp_path / "activities"))
    return tmp_path


def clean(spark, place):
    return loading.clean_hr_file(spark, str(place / "hr.csv"))


def test_cleaned_files(spark, place):
    hr = {r.id_salarie: r for r in clean(spark, place).collect()}
    assert {i: r.nom for i, r in hr.items()} == {"1": "Alpha", "2": "Beta", "3": "Gamma"}
    assert hr["1"].moyen_deplacement == "Transports En Commun" and hr["1"].type_contrat == "Cdi"
    assert hr["3"].salaire_brut == 33130.0 and hr["3"].jours_cp == 25.0
    declared = loading.clean_practice_file(spark, str(place / "declared.csv"))
    assert sorted((r.id_salarie, r.pratique_declaree) for r in declared.collect()) == [
        ("1", None), ("2", "Tennis"), ("3", "Yoga")]


def test_relational_rows(spark, place):
    rows = loading.employee_rows(clean(spark, place))
    assert rows.columns == list(EMPLOYEE_TYPES)
    bare = loading.employee_rows(spark.createDataFrame([("x",)], ["nom"]).coalesce(1))
    assert tuple(bare.first()) == (
        "EMP001", "30000", "Non spécifié", "x", "Inconnu", None, "CDI", "Non spécifié")


def test_analysis(spark, place):
    hr = clean(spark, place)
    declared = loading.clean_practice_file(spark, str(place / "declared.csv"))
    tables = analysis.activity_analysis(hr, declared, spark.read.parquet(str(place / "activities")))
    assert [(r.id_salarie, r.nb_activites_total) for r in tables["active_employees"].collect()] == [("2", 17)]
    assert [r.nom for r in tables["active_details"].collect()] == ["Beta"]
    assert [r.id_salarie for r in tables["active_and_eco"].collect()] == ["2"]
    assert [(r.id_salarie, str(r.prime_annuelle)) for r in tables["eco_bonuses"].collect()] == [
        ("2", "3516.00"), ("3", "1656.50")]
    budget = tables["eco_budget"].first()
    assert (str(budget[0]), budget[1], str(budget[2])) == ("5172.50", 2, "2586.25")


def test_ids_keep_their_zeros(spark, place):
    (place / "hr.csv").write_text(HR.replace("\n2,", "\n00123,").replace("\n3,", "\n0007,"))
    (place / "declared.csv").write_text(PRACTICE.replace("\n2,", "\n00123,"))
    moves = spark.read.parquet(str(place / "activities"))
    moves = moves.withColumn("id_salarie", F.when(F.col("id_salarie") == "2", "00123").otherwise("0007"))
    moves.write.parquet(f"{place}/moves")
    main(["analyse", "--hr", f"{place}/hr.csv", "--declared", f"{place}/declared.csv",
          "--activities", f"{place}/moves", "--employees", f"{place}/none", "--out", f"{place}/results"])
    found = spark.read.parquet(f"{place}/results/active_details").collect()
    assert {(r.id_salarie, r.nb_activites_total) for r in found} == {("00123", 17)}
    kinds = dict(loading.read_people(spark, f"{place}/hr.csv").dtypes)
    assert kinds["id_salarie"] == "string" and kinds["date_embauche"] == "date"


def test_employee_analysis_needs_its_columns(spark):
    with pytest.raises(ValueError, match="salaire_brut"):
        analysis.employee_analysis(spark.createDataFrame([("1",)], ["id_salarie"]))


def test_dashboard(spark, place):
    out = str(place / "out")
    done = dashboard.export_dashboard(
        out, spark.read.parquet(str(place / "activities")), clean(spark, place),
        names={**dashboard.NAMES, "bonuses": "primes.csv"},
    )
    assert list(done.values()) == [20, 3, 3]
    def lines_of(name):
        texts = [p.read_text().splitlines() for p in sorted((place / "out" / name).glob("part-*.csv"))]
        return [texts[0][0], *(line for text in texts for line in text[1:])]

    lines = lines_of("primes.csv")
    assert lines[0] == "ID_employee;moyen_deplacement;prime_annuelle;salaire_brut"
    assert "3;Vélo/Trottinette/Autres;1656,50;33130,00" in lines
    moves = lines_of("activities.csv")
    assert moves[1].split(";")[2:] == ["Tennis", "6034.94", "807", "ok"]
    stats = lines_of("statistics.csv")
    assert "Marche/Running;1;3516.00;3516.00" in stats


def test_dashboard_parts_are_independent(spark, place):
    moves = spark.read.parquet(str(place / "activities"))
    done = dashboard.export_dashboard(str(place / "out"), moves, None)
    assert list(done.values()) == [20]


def test_commutes(spark, place):
    checked = commuting.validated_commutes(clean(spark, place), "1 Place du Siège")
    found = {r.id_salarie: (r.distance_km, r.validation_deplacement) for r in checked.collect()}
    assert found == {
        "1": (27.5, "Mode exclu: Véhicule motorisé ou transport"),
        "2": (3.0, "Valide"),
        "3": (47.5, "Erreur: 47.5km > 25km (Vélo)"),
    }
    stats = commuting.export_commutes(checked, str(place / "out"))
    assert stats.count() == 3
    errors = spark.read.option("header", True).csv(str(place / "out" / "errors.csv"))
    assert [r.id_salarie for r in errors.collect()] == ["3"]


def test_command_line(spark, place, capsys):
    main(["clean", "--hr", f"{place}/hr.csv", "--declared", f"{place}/declared.csv", "--out", f"{place}/clean"])
    employees = clean(spark, place).withColumns(
        {"op": F.lit("c"), "cdc_ts_ms": F.lit(1), "cdc_offset": F.lit(1), "processing_timestamp": F.current_timestamp(), "batch_id": F.lit(0)}
    )
    employees.write.parquet(f"{place}/employees")
    tables = ["--activities", f"{place}/activities", "--employees", f"{place}/employees"]
    main(["export", *tables, "--out", f"{place}/out"])
    main(["commute", "--hr", f"{place}/hr.csv", "--company", "x", "--out", f"{place}/out"])
    main(["analyse", "--hr", f"{place}/clean/hr", "--declared", f"{place}/declared.csv", *tables, "--out", f"{place}/results"])
    assert spark.read.parquet(f"{place}/results/active_details").count() == 1
    assert spark.read.parquet(f"{place}/results/eco_bonuses").count() == 2
    shown = capsys.readouterr().out
    assert "bonuses 3 rows" in shown
    assert "eco_budget" in shown and "bonus_by_mode" in shown


def test_command_line_live(spark, tmp_path):
    binary = [F.lit("k").cast("binary").alias("key")]
    for name, row in (("moves", '{"id_salarie":"1"}'), ("people", '{"id_salarie":"1","salaire_brut":"1000"}')):
        text = F.lit('{"payload":{"op":"c","after":' + row + "}}")
        spark.range(1).select(*binary, text.cast("binary").alias("value")).write.parquet(str(tmp_path / name))
    main(["live", "--activities", f"{tmp_path}/moves", "--employees", f"{tmp_path}/people", "--root", f"{tmp_path}/root"])
    counts = [
        spark.read.parquet(f"{tmp_path}/root/{name}").count()
        for name in ("activities", "employee_prime", "alert_outbox", "mode_report", "current_employees")
    ]
    assert counts == [1, 1, 1, 1, 1]


def test_header_order_does_not_matter(spark, tmp_path):
    file = tmp_path / "hr.csv"
    file.write_text("Nom,Salaire brut,ID salarié\nAlpha,30940,1\nBeta,x,2\n")
    found = {r.id_salarie: (r.nom, r.salaire_brut) for r in loading.clean_hr_file(spark, str(file)).collect()}
    assert found == {"1": ("Alpha", 30940.0), "2": ("Beta", None)}


def test_whole_numbers_in_files(spark):
    frame = spark.createDataFrame([(30940.0,), (29.5,), (None,)], "n double")
    assert [r.n for r in loading.numbers_as_text(frame).collect()] == ["30940", "29.5", None]


def test_command_line_needs_a_job():
    with pytest.raises(SystemExit):
        parser().parse_args([])
