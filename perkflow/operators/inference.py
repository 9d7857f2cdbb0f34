"""Types of text columns, found in one pass.

Types form a lattice: nothing, then long, double, boolean, date and timestamp, and text above all. Each
column counts the values that read as each type, so parts of the data are judged apart and merged by adding
up; a column has the narrowest type that all its values read as. Numbers with leading zeros and numbers
beyond 64 bits are text: they are codes, and would lose digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_CODE = r"^[+-]?0\d"
_DAY = r"^\d{4}-\d{1,2}-\d{1,2}$"
_MOMENT = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


def _readers(text: Column) -> dict[str, Column]:
    """Whether a text reads as each type, narrowest first."""
    number = text.rlike(_NUMBER) & ~text.rlike(_CODE)
    return {
        "bigint": text.rlike(r"^[+-]?\d+$") & ~text.rlike(_CODE) & text.try_cast("bigint").isNotNull(),
        "double": number & ~text.rlike(r"^[+-]?\d{16,}$"),
        "boolean": F.lower(text).isin("true", "false"),
        "date": text.rlike(_DAY) & text.try_cast("date").isNotNull(),
        "timestamp": text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(),
    }


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def type_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """colonne, remplis (values that are neither null nor blank) and the number that reads as each type.

    Profiles of parts of a table, added up by column, are the profile of the table.
    """
    names = list(columns if columns is not None else text_columns(df))
    parts = []
    for name in names:
        text = F.trim(F.col(name))
        filled = F.coalesce(text != "", F.lit(False))
        counts = [F.count_if(filled & reads).alias(kind) for kind, reads in _readers(text).items()]
        parts.append(F.struct(F.lit(name).alias("colonne"), F.count_if(filled).alias("remplis"), *counts).alias(name))
    row = df.agg(*parts)
    return row.select(F.inline(F.array(*[F.col(f"`{name}`") for name in names])))


def column_types(profile: DataFrame) -> DataFrame:
    """colonne and type from a profile, or from profiles of parts."""
    kinds = list(_readers(F.lit("")))
    whole = profile.groupBy("colonne").agg(*[F.sum(name).alias(name) for name in ("remplis", *kinds)])
    found = F.when(F.col("remplis") == 0, "string")
    for kind in kinds:
        found = found.when(F.col(kind) == F.col("remplis"), kind)
    return whole.select("colonne", found.otherwise("string").alias("type"))


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns in the given types; blank becomes null where the type is not text."""
    casts = {
        name: F.trim(F.col(name)).try_cast(kind) for name, kind in types.items() if kind != "string"
    }
    return df.withColumns(casts) if casts else df


def infer_types(df: DataFrame) -> DataFrame:
    """The rows with every text column in the narrowest type that all its values read as."""
    if not text_columns(df):
        return df
    found = column_types(type_profile(df)).collect()  # one row per column
    return with_types(df, {row.colonne: row.type for row in found})
