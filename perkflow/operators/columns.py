"""Header and schema operators. They touch metadata only, never rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.model import ACCENTED, HEADER_ALIASES, HEADER_BEGINNINGS, HEADER_DROPPED, UNACCENTED

_HEADER_TABLE = str.maketrans(" -/" + ACCENTED, "___" + UNACCENTED, HEADER_DROPPED)


def clean_header(name: str) -> str:
    """Column name without blanks, accents or punctuation, in lower case."""
    return name.strip().translate(_HEADER_TABLE).lower()


def normalise_headers(
    df: DataFrame, aliases: Mapping[str, str] = HEADER_ALIASES
) -> DataFrame:
    """Clean all headers and rename known spellings and beginnings; unknown names stay."""
    names = [clean_header(name) for name in df.columns]
    names = [aliases.get(name) or _by_beginning(name) or name for name in names]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"several headers stand for the same column: {twice}")
    return df.toDF(*names)


def _by_beginning(name: str) -> str | None:
    return next((column for begin, column in HEADER_BEGINNINGS.items() if name.startswith(begin)), None)


def widen_integers(df: DataFrame) -> DataFrame:
    """Give inferred integer columns 64 bits, so that later files with larger values still fit."""
    narrow = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegerType)]
    return df.withColumns({name: F.col(name).cast("long") for name in narrow})


def discover_id(df: DataFrame, words: Sequence[str] = ("id", "salari")) -> str:
    """First column whose name contains one of `words`, else the first column."""
    for name in df.columns:
        if any(word in name.lower() for word in words):
            return name
    return df.columns[0]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the frame lacks."""
    return [name for name in required if name not in df.columns]


def ensure_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column only if it is absent."""
    return df if name in df.columns else df.withColumn(name, value)


def ensure_employee_id(df: DataFrame, name: str = "id_salarie") -> DataFrame:
    """Add an employee id if absent: an id-like column, else `EMP` and a number.

    Numbers are unique; they follow the line order of a file read in one split and leave gaps
    between splits. Write the result before using it twice.
    """
    if name in df.columns:
        return df
    named = [c for c in df.columns if "id" in c.lower() or "matricule" in c.lower()]
    if named:
        return df.withColumn(name, F.col(named[0]).cast("string"))
    return df.withColumn(name, F.format_string("EMP%03d", F.monotonically_increasing_id() + 1))
