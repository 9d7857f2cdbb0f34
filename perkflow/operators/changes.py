"""Change events: `{"payload": {"op", "ts_ms", "before": {row}, "after": {row}}}` as JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.functions.dates import change_date, change_time
from perkflow.functions.pay import eco_bonus, salary_amount, salary_defaulted, salary_out_of_range
from perkflow.model import ACTIVITY_IMAGE, EMPLOYEE_IMAGE
from perkflow.operators.columns import ensure_column

CORRUPT = "_corrupt_record"


def envelope(image: T.StructType, old_key: str | None = None) -> T.StructType:
    """Schema of a message. Of the old image only the key is parsed, and only on request."""
    old = [T.StructField("before", T.StructType([image[old_key]]))] if old_key else []
    payload = T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            *old,
            T.StructField("after", image),
        ]
    )
    return T.StructType([T.StructField("payload", payload)])


def payloads(
    messages: DataFrame,
    schema: T.StructType,
    wanted: Callable[[Column], Column],
    *kept: Column,
) -> DataFrame:
    """Payload fields of the messages whose payload is `wanted`, beside the `kept` columns.

    A filter on the parsed value would be pushed below the projection and parse each message a
    second time. Unpacking a filtered array of at most one payload parses once.
    """
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("d"), *kept
    )
    unpacked = F.inline(F.filter(F.array("d.payload"), wanted))
    return parsed.select(unpacked, *parsed.columns[1:])


def raw_text(messages: DataFrame) -> DataFrame:
    """Key and value of a message as text."""
    return messages.select(F.col("key").cast("string"), F.col("value").cast("string"))


def text_image(image: T.StructType) -> T.StructType:
    """The image with all fields as text, so that an unreadable field can be told from a missing one."""
    return T.StructType([T.StructField(name, T.StringType()) for name in image.names])


def read_field(field: T.StructField, text: Column) -> Column:
    """A field's text in its type, null if it cannot be read. Times may be numbers or ISO text."""
    reader = _READERS.get(field.name)
    return reader(text) if reader else text.try_cast(field.dataType)


_READERS: dict[str, Callable[[Column], Column]] = {
    "start_date": change_time,
    "date_embauche": change_date,
}


def bad_field(after: Column, image: T.StructType) -> Column:
    """Name of the first field whose text cannot be read, null if all can."""
    checks = [
        F.when(after[f.name].isNotNull() & read_field(f, after[f.name]).isNull(), f.name)
        for f in image.fields
        if f.name in _READERS or not isinstance(f.dataType, T.StringType)
    ]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def _is_delete(payload: Column) -> Column:
    return F.coalesce(payload["op"] == "d", F.lit(False))


def _is_image(payload: Column, image: T.StructType, key: str) -> Column:
    after = payload["after"]
    return after.isNotNull() & after[key].isNotNull() & bad_field(after, image).isNull()


def parse_images(
    messages: DataFrame, image: T.StructType, keep_raw: bool = False, key: str = "id_salarie"
) -> DataFrame:
    """New row image of each message beside `op` and `cdc_ts_ms`.

    Messages without a new image (deletes, tombstones, broken JSON), without a key or with a field
    that cannot be read are left out; `change_rows` and `rejects` cover them.
    """
    raw = [F.col("value").cast("string").alias("raw_value")] if keep_raw else []
    found = payloads(
        messages, envelope(text_image(image)), lambda p: _is_image(p, image, key), *raw
    )
    names = ["raw_value"] if keep_raw else []
    fields = [read_field(f, F.col(f"after.{f.name}")).alias(f.name) for f in image.fields]
    return found.select(*fields, "op", F.col("ts_ms").alias("cdc_ts_ms"), *names)


def change_rows(
    messages: DataFrame, image: T.StructType, key: str = "id_salarie", owner: str = "id_salarie"
) -> DataFrame:
    """Like `parse_images`, with deletes as rows that carry the `key` of the old image only.

    `owner` is the field that no image may lack. `cdc_offset` is the place of the message in its Kafka
    partition, null for other sources. All messages of a key are in one partition, so it orders
    changes within a millisecond.
    """
    offset = F.col("offset") if "offset" in messages.columns else F.lit(None)
    texts = text_image(image)
    found = payloads(
        messages,
        envelope(texts, key),
        lambda p: _is_image(p, image, owner) | (_is_delete(p) & _delete_key(p, key).isNotNull()),
        offset.cast("long").alias("cdc_offset"),
    )
    deleted = F.coalesce(F.col("op") == "d", F.lit(False))
    fields = {f.name: read_field(f, F.col(f"after.{f.name}")) for f in image.fields}
    fields[key] = F.when(deleted, F.coalesce(F.col(f"before.{key}"), fields[key])).otherwise(fields[key])
    return found.select(
        *[field.alias(name) for name, field in fields.items()],
        "op",
        F.col("ts_ms").alias("cdc_ts_ms"),
        "cdc_offset",
    )


def _delete_key(payload: Column, key: str) -> Column:
    return F.coalesce(payload["before"][key], payload["after"][key])


def rejects(
    messages: DataFrame, image: T.StructType, key: str = "id_salarie", owner: str = "id_salarie"
) -> DataFrame:
    """Messages that `change_rows` leaves out, with their text and the reason.

    A tombstone after a delete (a key without a value) is no reject.
    """
    schema = T.StructType(
        [*envelope(text_image(image), key).fields, T.StructField(CORRUPT, T.StringType())]
    )
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("raw_value"),
        F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("d"),
    )
    payload = F.col("d.payload")
    after, deleted = payload["after"], _is_delete(payload)
    bad = bad_field(after, image)
    reason = (
        F.when(F.col("raw_value").isNull(), "empty message")
        .when(payload.isNull() & F.col(f"d.{CORRUPT}").isNotNull(), "broken json")
        .when(payload.isNull(), "no payload")
        .when(deleted & _delete_key(payload, key).isNull(), "no key")
        .when(deleted, None)
        .when(after.isNull(), "no new image")
        .when(after[owner].isNull(), "no key")
        .when(bad.isNotNull(), F.concat(F.lit("bad field: "), bad))
    )
    # As in `payloads`: rows without a reason go by unpacking, not by a filter.
    reasons = F.filter(F.array(reason), lambda r: r.isNotNull())
    return parsed.select("raw_value", F.explode(reasons).alias("reason"))


def decode_activities(messages: DataFrame) -> DataFrame:
    """Activity rows and deletes with a true start time: the log of changes.

    `versions.current_activities` gives the state they end in.
    """
    return change_rows(messages, ACTIVITY_IMAGE, key="id")


def decode_employees(messages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Employee rows with a true hire date."""
    return parse_images(messages, EMPLOYEE_IMAGE, keep_raw)


def decode_employee_changes(messages: DataFrame) -> DataFrame:
    """Employee rows and deletes with a true hire date."""
    return change_rows(messages, EMPLOYEE_IMAGE)


def with_pay(rows: DataFrame) -> DataFrame:
    """Add the salary as money, whether it had to be assumed or is out of range, and the bonus.

    Where defaults are filled in first, set `salary_defaulted` before that.
    """
    text = F.col("salaire_brut")
    flagged = ensure_column(rows, "salary_defaulted", salary_defaulted(text))
    flagged = flagged.withColumn("salary_out_of_range", salary_out_of_range(text))
    priced = flagged.withColumn("salaire", salary_amount(text))
    return priced.withColumn("prime_annuelle", eco_bonus(F.col("salaire"), F.col("moyen_deplacement")))


def to_messages(
    df: DataFrame,
    key: Column,
    after: Column,
    op: Column,
    ts_ms: Column,
    before: Column | None = None,
    *kept: str,
) -> DataFrame:
    """Wrap rows in the change envelope, as binary key and value beside the `kept` columns."""
    old = [] if before is None else [before.alias("before")]
    payload = F.struct(op.alias("op"), ts_ms.alias("ts_ms"), *old, after.alias("after"))
    value = F.to_json(F.struct(payload.alias("payload")))
    return df.select(
        key.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), *kept
    )
