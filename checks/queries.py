"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from perkflow.functions.commute import city_distance, default_distance, postcode_distance
from perkflow.functions.dates import from_days, from_micros, minute_text
from perkflow.functions.pay import eco_bonus, salary_amount, salary_defaulted, salary_out_of_range
from perkflow.functions.text import mode_key, title_case
from perkflow.model import ACTIVITY_IMAGE, HR_HEADERS
from perkflow.operators import (
    activity,
    changes,
    cleaning,
    columns,
    commute,
    gazetteer,
    inference,
    monthly,
    profiles,
    quality,
    reports,
    versions,
)
from perkflow.plans import loading
from perkflow.plans.commuting import validated_commutes
from perkflow.plans.dashboard import activity_export, bonus_rows, export_dashboard, with_decimal_comma
from perkflow.plans.live import current_employees, start_live
from perkflow.sources.catalog import add_load, register_table, save_bucketed, use_database
from perkflow.sources.latest import read_latest, upsert_latest
from perkflow.sources.messages import delivered_once
from perkflow.sources.reconcile import read_reconciled
from perkflow.sources.scratch import materialise, scratch_path
from perkflow.sources.tables import append_rows, point_lookup, read_if_filled, read_table, write_load
from perkflow.sources.tabular import read_csv, write_csv
from perkflow.streaming import alerts, ingest, views
from perkflow.streaming import reports as stream_reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query_as(name: str) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return roles.plain(make(spark, sf_dir))

        QUERIES[name] = run
        return make

    return register


def query(make: Query) -> Query:
    return query_as(make.__name__)(make)


def _priced(spark, sf_dir):
    return reports.ensure_bonus(roles.employees(spark, sf_dir))


def _latest(spark, sf_dir):
    rows = roles.versions(spark, sf_dir)
    return versions.latest_per_key(rows, "id_salarie", "version_date", "version_no")


def _totals(spark, sf_dir):
    return activity.activity_totals(
        roles.declared(spark, sf_dir), roles.activities(spark, sf_dir)
    )


# --- sources and sinks -------------------------------------------------------------------------


@query
def scan_table(spark, sf_dir):
    rows = read_table(spark, f"{sf_dir}/lineitem.parquet")
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    others = [F.max(name).alias(name) for name in rows.columns if name not in keys]
    return rows.agg(
        F.count(F.lit(1)).alias("nombre"), *[F.sum(name).alias(name) for name in keys], *others
    )


@query_as("point_lookup")
def point_lookup_order(spark, sf_dir):
    return point_lookup(roles.table(spark, sf_dir, "orders"), "o_custkey", "76")


@query
def ingest_tabular(spark, sf_dir):
    """Employees with padded ids as an HR file with its headers, read back typed in one pass."""
    path = scratch_path(spark, "ingest_tabular")
    none = F.lit(None).cast("string")
    rows = roles.employees(spark, sf_dir)
    sheet = rows.select(
        F.lpad("id_salarie", 8, "0"), "nom", "prenom", none, none, F.lit("1996-06-30"), "salaire_brut", none, none,
        "adresse", "moyen_deplacement",
    ).toDF(*HR_HEADERS)
    write_csv(sheet, path, ",")
    return loading.read_people(spark, path, ",").select(
        "id_salarie", "nom", "prenom", "date_embauche", "salaire_brut", "adresse", "moyen_deplacement"
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    rows = roles.table(spark, sf_dir, "documents")
    rows = rows.select("doc_id", "lang", "source", "n_chars", "text")
    write_csv(rows, path, ";", escape_lines=True)
    return read_csv(spark, path, ";", rows.schema, escape_lines=True)


@query
def csv_multiline(spark, sf_dir):
    """Texts with line breaks, quotes and separators as a foreign file holds them."""
    path = scratch_path(spark, "csv_multiline")
    rows = roles.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.replace("text", F.lit(", "), F.lit('";\r\n"')).alias("text")
    )
    write_csv(rows, path, ";")
    return read_csv(spark, path, ";", rows.schema, multi_line=True)


def _mixed(spark, sf_dir):
    """Orders as text columns of every kind."""
    number = F.col("o_orderkey").cast("string")
    return roles.table(spark, sf_dir, "orders").select(
        F.lpad(number, 9, "0").alias("code"),
        number.alias("numero"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("prix"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("clos"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("jour"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(F.col("o_orderkey") % 100 == 7, "n/a").otherwise(number).alias("mixte"),
        F.lit(None).cast("string").alias("vide"),
    )


@query
def csv_typed(spark, sf_dir):
    """A file read back in the types that its values have."""
    path = scratch_path(spark, "csv_typed")
    write_csv(_mixed(spark, sf_dir), path, ";")
    return read_csv(spark, path, ";", multi_line=True)


@query
def inferred_types(spark, sf_dir):
    """Types from the added-up profiles of three parts."""
    rows = _mixed(spark, sf_dir)
    parts = [inference.type_profile(rows.filter(F.col("numero") % 3 == n)) for n in range(3)]
    return inference.column_types(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def schema_conflict(spark, sf_dir):
    """Loads that hold the salary as int, long, decimal and text."""
    path = scratch_path(spark, "schema_conflict")
    rows = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    for n, kind in enumerate(("int", "bigint", "decimal(12,2)", "string")):
        part = rows.filter(F.col("c_nationkey") % 4 == n)
        salary = F.floor("c_acctbal") if n < 2 else F.col("c_acctbal")
        part = part.select("c_custkey", salary.cast(kind).alias("salaire"), "c_nationkey")
        (part if n % 2 else part.drop("c_nationkey")).write.parquet(f"{path}/load={n}")
    return read_reconciled(spark, path)


@query
def schema_evolution(spark, sf_dir):
    """Customers without a bonus, then suppliers with one, in the same table."""
    path = scratch_path(spark, "schema_evolution")
    old = roles.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("nom"), F.col("c_acctbal").alias("salaire")
    )
    new = roles.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("nom"),
        F.col("s_acctbal").alias("salaire"),
        F.col("s_nationkey").cast("string").alias("bu"),
    )
    append_rows(old, path)
    append_rows(new, path)
    return read_table(spark, path, merge_schema=True).select("nom", "salaire", "bu")


@query
def export_primes(spark, sf_dir):
    path = scratch_path(spark, "export_primes")
    rows = with_decimal_comma(bonus_rows(_latest(spark, sf_dir)))
    write_csv(rows, path, ";")
    return read_csv(spark, path, ";", rows.schema)


@query
def export_activities(spark, sf_dir):
    path = scratch_path(spark, "export_activities")
    rows = activity_export(roles.activities(spark, sf_dir)).select(
        "id_salarie", "activity_type", F.col("distance_m").cast("string"), "activity_no"
    )
    write_csv(rows, path, ";")
    return read_csv(spark, path, ";", rows.schema)


@query
def external_table(spark, sf_dir):
    """Orders by status from a table in a database, to which a second load is added."""
    path = scratch_path(spark, "external_table")
    use_database(spark, "perkflow_checks")
    name = f"perkflow_checks.orders_{path.rsplit('-', 1)[1]}"
    use_database(spark, "default")
    for batch_id in (0, 1):
        write_load(roles.table(spark, sf_dir, "orders"), path, "orders", batch_id)
        if batch_id == 0:
            register_table(spark, name, path)
        else:
            add_load(spark, name, path, "orders", batch_id)
    return spark.sql(f"SELECT o_orderstatus, count(*) AS nombre FROM {name} GROUP BY o_orderstatus")


# --- projections and schema --------------------------------------------------------------------


@query
def discover_id(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    return activity.activity_counts(rows, columns.discover_id(rows))


@query
def ensure_bonus(spark, sf_dir):
    return _priced(spark, sf_dir).select("id_salarie", "prime_annuelle")


@query_as("eco_bonus")
def eco_bonus_rows(spark, sf_dir):
    rows = roles.employees(spark, sf_dir)
    salary = salary_amount(F.col("salaire_brut"))
    return rows.select(
        "id_salarie", "moyen_deplacement", eco_bonus(salary, F.col("moyen_deplacement")).alias("prime")
    )


@query
def cdc_parse(spark, sf_dir):
    messages = roles.activity_messages(roles.table(spark, sf_dir, "events"))
    return _activity_columns(changes.decode_activities(messages))


def _activity_columns(rows):
    distance = F.col("distance_m").cast("string").cast("double").alias("distance_m")
    return rows.select(
        "id_salarie", "start_date", "activity_type", distance, "duration_sec", "comment"
    )


@query
def cdc_time_decode(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        F.unix_date(F.col("ts").cast("date")).alias("days"),
    )
    return rows.select(
        "event_id",
        from_micros(F.col("micros")).alias("moment"),
        from_days(F.col("days")).alias("jour"),
    )


@query
def cdc_rejects(spark, sf_dir):
    messages = roles.faulty_messages(roles.table(spark, sf_dir, "events"))
    return changes.rejects(messages, ACTIVITY_IMAGE, "id")


@query
def current_activities(spark, sf_dir):
    """Activities after corrections and deletes."""
    messages = roles.corrected_activity_messages(roles.table(spark, sf_dir, "events"))
    rows = versions.current_activities(changes.decode_activities(messages))
    return rows.select("id", "id_salarie", "activity_type")


# --- filters and nulls -------------------------------------------------------------------------


@query
def eco_filter(spark, sf_dir):
    return activity.eco_employees(roles.employees(spark, sf_dir)).select(
        "id_salarie", "moyen_deplacement"
    )


@query
def fill_defaults(spark, sf_dir):
    return cleaning.fill_defaults(roles.incomplete(roles.table(spark, sf_dir, "customer")))


@query
def null_profile(spark, sf_dir):
    return cleaning.null_profile(roles.incomplete(roles.table(spark, sf_dir, "customer")))


@query
def clean_hr(spark, sf_dir):
    status = F.col("o_orderstatus")
    rows = roles.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id_salarie"),
        F.concat(F.lit("  l'"), F.lower("o_orderpriority")).alias("nom"),
        F.when(status == "P", "inconnu")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date_embauche"),
        F.when(status == "F", "n/a")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("salaire_brut"),
        F.col("o_orderkey").alias("ligne"),
    )
    path = scratch_path(spark, "clean_hr")
    cleaned = cleaning.clean_hr(rows, "ligne")
    write_csv(cleaned, path, ",")
    return read_csv(spark, path, ",", cleaned.schema)


@query
def clean_practice(spark, sf_dir):
    rows = roles.activities(spark, sf_dir).select("id_salarie", "activity_type", "activity_no")
    return cleaning.clean_practice(rows, "activity_no")


@query
def employee_rows(spark, sf_dir):
    """Suppliers as employees that lack most columns."""
    rows = roles.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("matricule"), F.col("s_name").alias("nom")
    )
    return loading.employee_rows(rows)


# --- joins and activity ------------------------------------------------------------------------


@query
def declared_counts(spark, sf_dir):
    return activity.declared_counts(roles.declared(spark, sf_dir))


@query
def activity_counts(spark, sf_dir):
    return activity.activity_counts(roles.activities(spark, sf_dir))


@query
def activity_totals(spark, sf_dir):
    events = roles.table(spark, sf_dir, "events")
    return activity.activity_totals(roles.declared_elsewhere(spark, sf_dir), events, "user_id")


@query
def combine_counts(spark, sf_dir):
    return activity.combine_counts(
        activity.declared_counts(roles.declared_elsewhere(spark, sf_dir)),
        activity.activity_counts(roles.table(spark, sf_dir, "events"), "user_id"),
    )


@query
def active_employees(spark, sf_dir):
    return activity.active_employees(_totals(spark, sf_dir))


@query
def top_active(spark, sf_dir):
    return activity.top_active(_totals(spark, sf_dir), 20)


@query
def active_details(spark, sf_dir):
    totals = materialise(_totals(spark, sf_dir), "totals")
    return activity.active_details(totals, roles.employees(spark, sf_dir))


@query
def active_and_eco(spark, sf_dir):
    people = roles.employees(spark, sf_dir)
    totals = materialise(_totals(spark, sf_dir), "totals")
    ids = materialise(activity.eco_ids(activity.eco_employees(people)), "eco_ids")
    return activity.active_and_eco(activity.active_details(totals, people, ordered=False), ids)


@query
def bucketed_details(spark, sf_dir):
    """Active employees from tables that are stored by employee: neither side moves."""
    use_database(spark, "perkflow_checks")
    use_database(spark, "default")
    names = []
    for kind, rows in (("totals", _totals(spark, sf_dir)), ("people", roles.employees(spark, sf_dir))):
        path = scratch_path(spark, kind)
        names.append(f"perkflow_checks.{kind}_{path.rsplit('-', 1)[1]}")
        save_bucketed(rows, names[-1], path, "id_salarie", 8)
    totals, people = (spark.table(name) for name in names)
    return activity.active_details(totals, people, ordered=False)


@query
def employee_detail(spark, sf_dir):
    counts = materialise(activity.activity_counts(roles.activities(spark, sf_dir)), "counts")
    return activity.employee_detail(roles.employees(spark, sf_dir), counts)


@query
def wellbeing_days(spark, sf_dir):
    return activity.wellbeing_days(roles.table(spark, sf_dir, "events"), "ts", "user_id")


@query
def activity_trend(spark, sf_dir):
    return activity.activity_trend(roles.activities(spark, sf_dir))


@query
def monthly_merged(spark, sf_dir):
    """Figures of three loads, each summed up by itself, against the exact numbers of employees."""
    rows = roles.activities(spark, sf_dir)
    path = scratch_path(spark, "monthly_parts")
    for part in range(3):
        monthly.monthly_parts(rows.filter(F.col("activity_no") % 3 == part)).write.parquet(f"{path}/load={part}")
    report = monthly.monthly_report(read_table(spark, path))
    exact = rows.groupBy(F.date_trunc("month", "start_date").cast("date").alias("mois"), "activity_type")
    exact = exact.agg(F.count_distinct("id_salarie").alias("exact"))
    near = F.abs(F.col("nb_employes") - F.col("exact")) <= 1 + 4 * monthly.SKETCH_ERROR * F.col("exact")
    return report.join(exact, ["mois", "activity_type"]).select(
        "mois", "activity_type", "nb_activites", "distance_totale_m", near.alias("employes_proches")
    )


@query
def profile_merged(spark, sf_dir):
    """Profiles of three loads merged; the median's rank is checked against all rows."""
    rows = roles.table(spark, sf_dir, "lineitem")
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]
    rows = rows.withColumn("l_discount", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_discount")))
    path = scratch_path(spark, "profiles")
    for part in range(3):
        profiles.profile(rows.filter(F.col("l_orderkey") % 3 == part), names).write.parquet(f"{path}/load={part}")
    merged = profiles.with_quantiles(profiles.merge_profiles(read_table(spark, path)), mediane=0.5)
    medians = {r.colonne: r.mediane for r in merged.collect()}  # one row per column
    checks = []
    for name in names:
        below = F.count_if(F.col(name) < medians[name]) / F.count(name)
        upto = F.count_if(F.col(name) <= medians[name]) / F.count(name)
        near = (below <= 0.5 + profiles.RANK_ERROR) & (upto >= 0.5 - profiles.RANK_ERROR)
        checks.append(F.struct(F.lit(name).alias("colonne"), near.alias("mediane_proche")).alias(name))
    near = rows.agg(*checks).select(F.inline(F.array(*names)))
    return merged.drop("mediane").join(near, "colonne")


# --- versions ----------------------------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    return _latest(spark, sf_dir)


@query
def dedup_first(spark, sf_dir):
    rows = roles.versions(spark, sf_dir)
    return versions.first_per_key(rows, "id_salarie", "version_date", "version_no")


@query
def current_rows(spark, sf_dir):
    """Orders in status P delete their employee if they are the latest version."""
    rows = roles.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("op"),
        "o_orderdate",
        "o_orderkey",
    )
    return versions.current_rows(rows, "id", "o_orderdate", "o_orderkey")


# --- reports -----------------------------------------------------------------------------------


@query
def export_stats(spark, sf_dir):
    return reports.bonus_stats(_priced(spark, sf_dir))


@query
def export_stats_all_versions(spark, sf_dir):
    return reports.bonus_stats(reports.ensure_bonus(roles.versions(spark, sf_dir)))


@query
def export_stats_latest(spark, sf_dir):
    return reports.bonus_stats(reports.ensure_bonus(_latest(spark, sf_dir)))


@query
def salary_by_mode(spark, sf_dir):
    return reports.salary_by_mode(_latest(spark, sf_dir))


@query
def count_by_mode(spark, sf_dir):
    return reports.count_by_mode(_latest(spark, sf_dir))


@query
def bonus_by_mode(spark, sf_dir):
    return reports.bonus_by_mode(reports.ensure_bonus(_latest(spark, sf_dir)))


@query
def sql_view_report(spark, sf_dir):
    return reports.mode_report_sql(_priced(spark, sf_dir), "employee_mode_report")


@query
def eco_budget_sql(spark, sf_dir):
    return reports.budget_sql(_priced(spark, sf_dir), "employee_budget")


@query
def eco_budget(spark, sf_dir):
    return reports.eco_budget(roles.employees(spark, sf_dir))


@query
def eco_bonuses(spark, sf_dir):
    return reports.eco_bonuses(roles.employees(spark, sf_dir)).select(
        "id_salarie", "nom", "moyen_deplacement", "prime_annuelle"
    )


@query
def describe_stats(spark, sf_dir):
    rows = reports.with_salary(reports.ensure_bonus(roles.employees(spark, sf_dir)))
    stats = reports.describe_stats(
        rows.select("id_salarie", "moyen_deplacement", "salaire", "prime_annuelle")
    )
    return stats.withColumns({n: F.round(n, 4) for n in ("moyenne", "ecart_type")})


@query
def distinct_values(spark, sf_dir):
    return reports.distinct_values(roles.versions(spark, sf_dir), "salaire_brut")


@query
def kpi_overview(spark, sf_dir):
    return reports.kpi_overview(_priced(spark, sf_dir), roles.activities(spark, sf_dir))


# --- scalar functions --------------------------------------------------------------------------


@query
def salary_parse(spark, sf_dir):
    """Salaries in several spellings by segment, some of which are no numbers."""
    balance = F.col("c_acctbal").cast("string")
    segment = F.col("c_mktsegment")
    rows = roles.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "MACHINERY", balance)
        .when(segment == "HOUSEHOLD", F.concat(F.lit("  "), balance, F.lit(" ")))
        .when(segment == "BUILDING", F.col("c_name"))
        .when(segment == "AUTOMOBILE", F.concat(balance, F.lit("d")))
        .when(F.col("c_nationkey") > 3, F.concat(F.col("c_nationkey") + 1, F.lit("e1999")))
        .alias("texte"),
    )
    text = F.col("texte")
    return rows.select(
        "c_custkey",
        salary_amount(text).alias("salaire"),
        salary_defaulted(text).alias("defaut"),
        salary_out_of_range(text).alias("hors_plage"),
    )


@query_as("title_case")
def title_case_texts(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "documents")
    return rows.select("doc_id", title_case(F.col("text")).alias("titre"))


@query_as("mode_key")
def mode_key_texts(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "documents")
    return rows.select("doc_id", mode_key(F.col("text")).alias("cle"))


@query
def date_text(spark, sf_dir):
    rows = roles.table(spark, sf_dir, "events")
    return rows.select("event_id", minute_text(F.col("ts")).alias("minute"))


# --- commute -----------------------------------------------------------------------------------


@query
def distance_by_city(spark, sf_dir):
    return roles.employees(spark, sf_dir).select(
        "id_salarie",
        F.coalesce(city_distance(F.lower("adresse")), F.lit(-1.0)).alias("distance_km"),
    )


@query
def distance_by_postcode(spark, sf_dir):
    return roles.employees(spark, sf_dir).select(
        "id_salarie",
        F.coalesce(postcode_distance(F.col("adresse")), default_distance()).alias("distance_km"),
    )


def _measured(spark, sf_dir):
    return roles.table(spark, sf_dir, "supplier").select(
        roles.home("s_nationkey", F.col("s_suppkey") % 50).alias("adresse"),
        (F.abs("s_acctbal") * 10).alias("distance_m"),
    )


def _gazetteer(spark, sf_dir):
    """The first words of every document as names of places, and addresses from the same texts."""
    rows = roles.table(spark, sf_dir, "documents").filter(F.col("text").isNotNull())
    words = gazetteer.place_words(F.col("text"))
    names = rows.select(
        F.array_join(F.slice(words, F.lit(1), (1 + F.col("doc_id") % 3).cast("int")), "-").alias("name"),
        F.col("doc_id").alias("position"),
        (F.col("doc_id") % 40).cast("double").alias("low_km"),
        (F.col("doc_id") % 40 + 10).cast("double").alias("high_km"),
    )
    start = (1 + F.col("doc_id") % 30).cast("int")
    people = rows.select(
        F.col("doc_id").cast("string").alias("id_salarie"),
        F.concat(F.col("doc_id") % 9, F.lit(" Rue du Port, "), F.substring("text", start, F.lit(60))).alias("adresse"),
    )
    return names, people


@query
def distance_gazetteer(spark, sf_dir):
    names, people = _gazetteer(spark, sf_dir)
    places = materialise(gazetteer.located_places(people, names), "located")
    found = people.withColumn("_place", F.trim("adresse")).join(places, "_place", "left")
    return found.select("id_salarie", F.coalesce("_located", F.lit(-1.0)).alias("distance_km"))


@query
def distance_fallback(spark, sf_dir):
    people = roles.employees(spark, sf_dir)
    places = materialise(commute.measured_places(_measured(spark, sf_dir)), "places")
    return commute.with_distance(people, places).select(
        "id_salarie", "distance_km"
    )


@query
def commute_validate(spark, sf_dir):
    """All verdicts, written as part files and read back."""
    path = scratch_path(spark, "commute_validate")
    checked = validated_commutes(roles.employees(spark, sf_dir), roles.COMPANY)
    write_csv(checked, path, ",")
    return read_csv(spark, path, ",", checked.schema)


def _verdicts(spark, sf_dir):
    # Distances from 0.1 to 50 km, some missing, so that all verdicts occur.
    km = (F.col("o_totalprice") / 10_000).alias("distance_km")
    rows = roles.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("no"),
        roles.chosen("o_orderpriority", {**roles.VERSION_MODES, "4-NOT SPECIFIED": "Cheval"}).alias(
            "moyen_deplacement"
        ),
        F.when(F.col("o_orderstatus") != "P", km).alias("distance_km"),
    )
    return commute.validate_commute(rows, roles.COMPANY)


@query
def commute_stats(spark, sf_dir):
    stats = commute.commute_stats(
        validated_commutes(
            roles.employees(spark, sf_dir), roles.COMPANY, _measured(spark, sf_dir)
        )
    )
    return stats.withColumn("distance_moyenne_km", F.round("distance_moyenne_km", 4))


@query
def commute_errors(spark, sf_dir):
    return commute.commute_errors(_verdicts(spark, sf_dir)).select("no", "validation_deplacement")


# --- data quality ------------------------------------------------------------------------------


@query
def dq_dates(spark, sf_dir):
    status = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = roles.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "P", "31/12/1970").otherwise("1996-06-30").alias("date_naissance"),
        F.when(status == "F", F.concat(day, F.lit("x"))).otherwise(day).alias("date_embauche"),
    )
    return quality.check_dates(rows, today=date(2000, 1, 1))


@query
def dq_salary(spark, sf_dir):
    rows = roles.employees(spark, sf_dir).select("id_salarie", "salaire_brut")
    return quality.check_salary(rows, Decimal("1000"), Decimal("8000"))


@query
def dq_required(spark, sf_dir):
    rows = roles.incomplete(roles.table(spark, sf_dir, "customer"))
    return quality.check_required(rows).select("id_salarie", "champs_complets")


@query
def required_columns(spark, sf_dir):
    rows = roles.incomplete(roles.table(spark, sf_dir, "customer"))
    return quality.required_profile(rows, ["id_salarie", "salaire_brut", "moyen_deplacement", "adresse"])


@query
def activity_distance_check(spark, sf_dir):
    rows = roles.activities(spark, sf_dir)
    return quality.check_activity_distance(rows).select(
        "activity_no", "activity_type", "distance_km", "distance_valide"
    )


# --- streams -----------------------------------------------------------------------------------


@query
def stream_raw_kv(spark, sf_dir):
    root = scratch_path(spark, "stream_raw_kv")
    messages = roles.faulty_messages(roles.table_stream(spark, sf_dir, "events"))
    ingest.stream_raw(messages, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/table")


@query
def stream_cdc_activities(spark, sf_dir):
    root = scratch_path(spark, "stream_cdc_activities")
    messages = roles.activity_messages(roles.table_stream(spark, sf_dir, "events"))
    ingest.stream_activities(messages, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return _activity_columns(spark.read.parquet(f"{root}/table"))


@query
def stream_cdc_employees(spark, sf_dir):
    root = scratch_path(spark, "stream_cdc_employees")
    messages = roles.employee_messages(roles.table_stream(spark, sf_dir, "customer"), some_without_id=True)
    ingest.stream_employees(messages, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/table").filter("processing_timestamp is not null").select(
        "id_salarie", "salaire_brut", "moyen_deplacement", "nom", "prenom", "date_embauche",
        "type_contrat", "bu", "prime_annuelle", "salary_defaulted",
    )


@query
def stream_current_employees(spark, sf_dir):
    """Versions and deletes through the employee stream, then the state they end in."""
    root = scratch_path(spark, "stream_current_employees")
    messages = roles.version_messages(roles.table_stream(spark, sf_dir, "orders"))
    ingest.stream_employees(
        messages, f"{root}/table", f"{root}/checkpoint", current=f"{root}/current"
    ).awaitTermination()
    current = current_employees(spark.read.parquet(f"{root}/current"))
    return current.select("id_salarie", "salaire_brut", "moyen_deplacement", "prime_annuelle")


@query
def stream_alerts(spark, sf_dir):
    root = scratch_path(spark, "stream_alerts")
    messages = roles.activity_messages(roles.table_stream(spark, sf_dir, "events"))
    alerts.stream_alerts(messages, f"{root}/outbox", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/outbox")


@query
def stream_mode_report(spark, sf_dir):
    root = scratch_path(spark, "stream_mode_report")
    messages = roles.employee_messages(roles.table_stream(spark, sf_dir, "customer"))
    stream_reports.stream_mode_report(
        messages, f"{root}/report", f"{root}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/report")


def _in_runs(spark, folder, parts, start):
    """Run a stream to its end after each part of its messages has come."""
    for n, part in enumerate(parts):
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        start(stream).awaitTermination()


@query
def stream_latest_report(spark, sf_dir):
    """Versions and deletes in three runs of the stream, the last versions not last."""
    root = scratch_path(spark, "stream_latest_report")
    orders = roles.table(spark, sf_dir, "orders")
    parts = [roles.version_messages(orders.filter(F.col("o_orderkey") % 3 == n)) for n in (2, 0, 1)]
    _in_runs(spark, f"{root}/in", parts, lambda stream: views.stream_latest_report(
        stream, f"{root}/employees", f"{root}/report", f"{root}/checkpoint"))
    return views.latest_mode_report(spark.read.parquet(f"{root}/report"))


@query
def stream_once(spark, sf_dir):
    """Half of the messages, then all of them twice."""
    root = scratch_path(spark, "stream_once")
    events = roles.table(spark, sf_dir, "events")
    every = roles.activity_messages(events)
    half = roles.activity_messages(events.filter(F.col("event_id") % 2 == 0))
    _in_runs(spark, f"{root}/in", [half, every.unionByName(every)], lambda stream: ingest.stream_activities(
        delivered_once(stream), f"{root}/table", f"{root}/checkpoint"))
    return _activity_columns(spark.read.parquet(f"{root}/table"))


@query
def stream_eligibility(spark, sf_dir):
    """Deletes before the activities they delete, then corrections that move a third to another year."""
    root = scratch_path(spark, "stream_eligibility")
    events = roles.table(spark, sf_dir, "events")
    parts = [roles.dated_activity_messages(events, kind) for kind in ("d", "c", "u")]
    _in_runs(spark, f"{root}/in", parts, lambda stream: views.stream_eligibility(
        stream, f"{root}/activities", f"{root}/days", f"{root}/checkpoint"))
    return views.eligibility(spark.read.parquet(f"{root}/days"))


@query
def stream_rejects(spark, sf_dir):
    root = scratch_path(spark, "stream_rejects")
    messages = roles.faulty_messages(roles.table_stream(spark, sf_dir, "events"))
    ingest.stream_rejects(
        messages, ACTIVITY_IMAGE, f"{root}/table", f"{root}/checkpoint", key="id"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/table")


@query
def current_table(spark, sf_dir):
    """Versions in three loads, the last one twice, into a table of latest versions."""
    path = scratch_path(spark, "current_table")
    orders = roles.table(spark, sf_dir, "orders")
    for part in (2, 0, 1, 1):
        messages = roles.version_messages(orders.filter(F.col("o_orderkey") % 3 == part))
        rows = changes.decode_employee_changes(messages)
        upsert_latest(rows, path, "id_salarie", ("cdc_ts_ms", "cdc_offset"))
    current = read_latest(spark.read.parquet(path))
    return current.select("id_salarie", "salaire_brut", "moyen_deplacement")


@query
def export_kept(spark, sf_dir):
    """An export after which a table is missing and the other one empty: the old files stay."""
    path = scratch_path(spark, "export_kept")
    people = roles.employees(spark, sf_dir)
    export_dashboard(path, None, people)
    export_dashboard(path, read_if_filled(spark, f"{path}/missing"), people.limit(0))
    schema = with_decimal_comma(bonus_rows(people)).schema
    return read_csv(spark, f"{path}/bonuses.csv", ";", schema)


@query
def live_export(spark, sf_dir):
    """All live streams to their end, then the dashboard from their tables."""
    root = scratch_path(spark, "live_export")
    activities = roles.activity_messages(roles.table_stream(spark, sf_dir, "events"))
    employees = roles.employee_messages(roles.table_stream(spark, sf_dir, "customer"))
    for stream in start_live(activities, employees, root, None):
        stream.awaitTermination()
    current = current_employees(spark.read.parquet(f"{root}/current_employees"))
    log = spark.read.parquet(f"{root}/activities")
    export_dashboard(f"{root}/out", versions.current_activities(log), current)
    schema = reports.bonus_stats(bonus_rows(current)).schema
    return read_csv(spark, f"{root}/out/statistics.csv", ";", schema)
