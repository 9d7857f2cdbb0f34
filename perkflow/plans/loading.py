"""Clean the HR and practice files and load relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.functions.text import short_number_text
from perkflow.model import EMPLOYEE_DEFAULTS
from perkflow.operators.cleaning import clean_hr, clean_practice, fill_defaults
from perkflow.operators.columns import ensure_column, ensure_employee_id
from perkflow.sources.relational import EMPLOYEE_TYPES
from perkflow.sources.tabular import LINE, read_tabular


def clean_hr_file(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Tidy HR rows, the first line of each employee."""
    rows = read_tabular(spark, path, sep, infer=False, keep_order=True)
    return clean_hr(rows, LINE).drop(LINE)


def read_people(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """HR rows as they are, in one pass: ids and salaries stay text, dates become dates."""
    rows = read_tabular(spark, path, sep, infer=False)
    dates = [name for name in ("date_naissance", "date_embauche") if name in rows.columns]
    return rows.withColumns({name: F.col(name).try_cast("date") for name in dates}) if dates else rows


def clean_practice_file(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Declared practices, the first line of each employee."""
    rows = read_tabular(spark, path, sep, infer=False, keep_order=True)
    return clean_practice(rows, LINE).drop(LINE)


def numbers_as_text(df: DataFrame) -> DataFrame:
    """Doubles as text for files, whole numbers without decimals."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: short_number_text(F.col(name)) for name in doubles})


def employee_rows(hr: DataFrame) -> DataFrame:
    """HR rows in the shape of the relational employee table, missing columns and values defaulted."""
    named = ensure_employee_id(hr)
    for name, value in EMPLOYEE_DEFAULTS.items():
        named = ensure_column(named, name, F.lit(value))
    named = ensure_column(named, "date_embauche", F.lit(None).cast("date"))
    named = numbers_as_text(named)
    texts = {
        name: F.col(name).cast("string") for name in EMPLOYEE_TYPES if name != "date_embauche"
    }
    dated = {"date_embauche": F.col("date_embauche").cast("string").try_cast("date")}
    return fill_defaults(named.withColumns(texts | dated)).select(*EMPLOYEE_TYPES)
