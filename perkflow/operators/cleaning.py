"""Null handling and clean-up of the HR and practice files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perkflow.functions.dates import date_or_null
from perkflow.functions.text import title_case
from perkflow.model import EMPLOYEE_DEFAULTS
from perkflow.operators.versions import first_per_key

_TITLE_COLUMNS = ("nom", "prenom", "bu", "type_contrat", "adresse", "moyen_deplacement")
_NUMBER_COLUMNS = ("salaire_brut", "jours_cp")
_DATE_COLUMNS = ("date_naissance", "date_embauche")


def fill_defaults(df: DataFrame, defaults: Mapping[str, str] = EMPLOYEE_DEFAULTS) -> DataFrame:
    """Replace nulls by per-column defaults."""
    return df.fillna({name: value for name, value in defaults.items() if name in df.columns})


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of each column as rows (colonne, nb_nuls), in one pass over the data."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counts.unpivot([], names, "colonne", "nb_nuls")


def tidy_hr(df: DataFrame) -> DataFrame:
    """Title case for text, dates and numbers coerced; what cannot be read becomes null."""
    changes = {name: title_case(F.trim(name)) for name in _TITLE_COLUMNS if name in df.columns}
    changes |= {
        name: F.col(name).cast("string").try_cast("double")
        for name in _NUMBER_COLUMNS
        if name in df.columns
    }
    changes |= {
        name: date_or_null(F.col(name).cast("string"))
        for name in _DATE_COLUMNS
        if name in df.columns
    }
    return df.withColumns(changes)


def clean_hr(df: DataFrame, *oldest_by: str) -> DataFrame:
    """Tidy HR rows, first row of each employee by `oldest_by`."""
    return tidy_hr(first_per_key(df, "id_salarie", *oldest_by))


def clean_practice(df: DataFrame, *oldest_by: str) -> DataFrame:
    """First declaration of each employee by `oldest_by`."""
    return first_per_key(df, "id_salarie", *oldest_by)
