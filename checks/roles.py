"""The given tables in the roles of employees, activities and change messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.model import DECLARED
from perkflow.operators.changes import to_messages

MODES = {
    "MACHINERY": "Marche/running",
    "HOUSEHOLD": "Vélo/Trottinette/Autres",
    "BUILDING": "Transports en commun",
    "AUTOMOBILE": "véhicule thermique/électrique",
    "FURNITURE": "véhicule thermique/électrique",
}
# One priority has no mode: versions with a missing mode.
VERSION_MODES = {
    "1-URGENT": "Marche_running",
    "2-HIGH": "velo_trottinette_autres",
    "3-MEDIUM": "Transports en commun",
    "5-LOW": "véhicule thermique/électrique",
}
ACTIVITY_TYPES = {
    "1-URGENT": "Course à pied",
    "2-HIGH": "Vélo",
    "3-MEDIUM": "Marche",
    "4-NOT SPECIFIED": "Trottinette",
    "5-LOW": "Natation",
}
# Fields that are empty for some segments, so that defaults have work to do.
SEGMENT_PRACTICE = {"MACHINERY": "Running", "HOUSEHOLD": "Tennis", "BUILDING": "", "AUTOMOBILE": "  "}
# Home towns by nation; two nations have no usable address.
PLACES = (
    "34000 Montpellier",
    "34970 Lattes",
    "34110 Frontignan",
    "34970 Saint-Clément-de-Rivière",
    "30900 Nîmes",
    "34470 Pérols",
    "34140 Mèze",
    "34730 Prades-le-Lez",
    "34130 Mauguio",
    "34740 Vendargues",
    "34800 Clermont-l'Hérault",
    "34790 Grabels",
    "34830 Clapiers",
    "34500 Béziers",
    "34690 Fabrègues",
    "34920 Le Crès",
    "34250 Palavas-les-Flots",
    "34160 Saint-Drézéry",
    "34700 Lodève",
    "34090 X",
    "34110 Balaruc",
    "34470 Lieu",
    "34980 SAINT-CLÉMENT-DE-RIVIÈRE",
    None,
    "",
)
COMPANY = "1 Place du Siège, 34000 Montpellier"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def chosen(key: str, values: dict[str, str]) -> Column:
    result = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, value in values.items():
        result = result.when(F.col(key) == name, value)
    return result


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def home(nation: str, number: Column) -> Column:
    place = F.element_at(F.array(*[F.lit(p).cast("string") for p in PLACES]), F.col(nation) + 1)
    return F.concat(number.cast("string"), F.lit(" Rue du Port, "), place)


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("id_salarie"),
        F.col("c_name").alias("nom"),
        F.concat(F.lit("P"), _text("c_nationkey")).alias("prenom"),
        _text("c_acctbal").alias("salaire_brut"),
        chosen("c_mktsegment", MODES).alias("moyen_deplacement"),
        home("c_nationkey", F.col("c_custkey") % 50).alias("adresse"),
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one version of an employee row."""
    return table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("id_salarie"),
        _text("o_totalprice").alias("salaire_brut"),
        chosen("o_orderpriority", VERSION_MODES).alias("moyen_deplacement"),
        F.col("o_orderdate").alias("version_date"),
        F.col("o_orderkey").alias("version_no"),
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("id_salarie"),
        F.col("o_orderdate").alias("start_date"),
        chosen("o_orderpriority", ACTIVITY_TYPES).alias("activity_type"),
        F.col("o_totalprice").alias("distance_m"),
        F.col("o_orderkey").alias("activity_no"),
    )


def declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_salarie"),
        chosen("c_mktsegment", SEGMENT_PRACTICE).alias(DECLARED),
    )


def declared_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations whose ids only partly occur among the event users."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id_salarie"),
        F.when(F.col("quality") == 1, "Tennis").otherwise("").alias(DECLARED),
    )


def incomplete(customers: DataFrame) -> DataFrame:
    """Employee rows with missing fields, as change messages carry them."""
    segment = F.col("c_mktsegment")
    return customers.select(
        _text("c_custkey").alias("id_salarie"),
        F.when(segment != "BUILDING", _text("c_acctbal")).alias("salaire_brut"),
        F.when(segment != "FURNITURE", chosen("c_mktsegment", MODES)).alias("moyen_deplacement"),
        F.when(F.col("c_nationkey") > 3, F.col("c_name")).alias("nom"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("P"), _text("c_nationkey"))).alias("prenom"),
        (F.col("c_nationkey") + 18352).alias("date_embauche"),
        F.when(segment == "MACHINERY", "CDD").alias("type_contrat"),
        F.concat(F.lit("BU"), _text("c_nationkey")).alias("bu"),
    )


def employee_messages(customers: DataFrame, some_without_id: bool = False) -> DataFrame:
    rows = incomplete(customers)
    if some_without_id:
        number = F.col("id_salarie")
        rows = rows.withColumn("id_salarie", F.when(number.cast("long") % 7 != 0, number))
    after = F.struct(*[F.col(name) for name in rows.columns])
    return to_messages(rows, F.col("id_salarie"), after, F.lit("c"), F.lit(1758807237827))


def activity_messages(events: DataFrame) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    after = F.struct(
        _text("event_id").alias("id"),
        _text("user_id").alias("id_salarie"),
        micros.alias("start_date"),
        F.col("event_type").alias("activity_type"),
        F.col("value").alias("distance_m"),
        F.get_json_object("props", "$.k").cast("int").alias("duration_sec"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("comment"),
    )
    return to_messages(events, F.col("event_id"), after, F.lit("c"), F.unix_millis(F.col("ts").cast("timestamp")))


def corrected_activity_messages(events: DataFrame) -> DataFrame:
    """Every event as a new activity; a third of them corrected and a fifth deleted later."""
    moment = F.unix_millis(F.col("ts").cast("timestamp"))
    number = _text("event_id").alias("id")

    def image(kind: Column) -> Column:
        return F.struct(number, _text("user_id").alias("id_salarie"), kind.alias("activity_type"))

    new = to_messages(events, F.col("event_id"), image(F.col("event_type")), F.lit("c"), moment)
    some = events.filter(F.col("event_id") % 3 == 1)
    changed = to_messages(some, F.col("event_id"), image(F.lit("corrected")), F.lit("u"), moment + 1)
    gone = events.filter(F.col("event_id") % 5 == 0)
    deleted = to_messages(
        gone, F.col("event_id"), F.lit(None).cast("string"), F.lit("d"), moment + 2, F.struct(number)
    )
    return deleted.unionByName(changed).unionByName(new)


def dated_activity_messages(events: DataFrame, kind: str) -> DataFrame:
    """New activities (c), later corrections of a third to the next year (u), or later deletes of a fifth (d)."""
    number = _text("event_id").alias("id")
    later = F.when(F.lit(kind) == "u", F.make_interval(F.lit(1))).otherwise(F.make_interval(F.lit(0)))
    start = F.unix_micros(F.col("ts").cast("timestamp") + later)
    some = {"c": 1, "u": 3, "d": 5}[kind]
    rows = events.filter(F.col("event_id") % some == 0)
    after = F.struct(number, _text("user_id").alias("id_salarie"), start.alias("start_date"))
    moment = F.unix_millis(F.col("ts").cast("timestamp")) + some
    if kind == "d":
        return to_messages(rows, F.col("event_id"), F.lit(None).cast("string"), F.lit("d"), moment, F.struct(number))
    return to_messages(rows, F.col("event_id"), after, F.lit(kind), moment)


def version_messages(orders: DataFrame) -> DataFrame:
    """Every order as a change of its employee; orders in status P delete the employee."""
    rows = orders.withColumn("offset", F.col("o_orderkey"))
    deleted = F.col("o_orderstatus") == "P"
    number = _text("o_custkey").alias("id_salarie")
    after = F.struct(
        number,
        _text("o_totalprice").alias("salaire_brut"),
        chosen("o_orderpriority", VERSION_MODES).alias("moyen_deplacement"),
    )
    return to_messages(
        rows,
        F.col("o_custkey"),
        F.when(~deleted, after),
        F.when(deleted, "d").otherwise("u"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")),
        F.when(deleted, F.struct(number)),
        "offset",
    )


def faulty_messages(events: DataFrame) -> DataFrame:
    """One kind of message per event type; only a third of the purchases is whole."""
    number = _text("event_id")
    kinds = {
        "error": F.concat(F.lit('{"payload": '), number),
        "signup": F.concat(F.lit('{"schema": '), number, F.lit("}")),
        "click": F.concat(F.lit('{"payload": {"op": "u", "ts_ms": '), number, F.lit("}}")),
        "purchase": F.concat(
            F.lit('{"payload": {"op": "c", "after": {"'),
            F.when(F.col("event_id") % 3 == 0, "comment").otherwise("id_salarie"),
            F.lit('": "'),
            number,
            F.when(F.col("event_id") % 3 == 1, '", "distance_m": "abc').otherwise(""),
            F.lit('"}}}'),
        ),
    }
    value = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, text in kinds.items():
        value = value.when(F.col("event_type") == kind, text)
    return events.select(
        number.cast("binary").alias("key"), value.cast("binary").alias("value")
    )


def plain(df: DataFrame) -> DataFrame:
    """Types that Spark and other engines show alike: doubles for decimals, text for dates."""
    casts = {T.DecimalType: "double", T.DateType: "string", T.TimestampType: "timestamp_ntz"}
    return df.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]) if type(f.dataType) in casts else f.name
            for f in df.schema.fields
        ]
    )
