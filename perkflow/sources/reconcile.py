"""Tables whose loads hold the same column in different types.

Loads of equal schema are read together, each group widens its columns to the type that holds the values of
all groups, and the groups are united. Merging schemas alone fails on such tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkflow.sources import files

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[type(kind)], 0) if type(kind) in _DIGITS else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both; text where no other does."""
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if T.NullType in kinds:
        return b if isinstance(a, T.NullType) else a
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda k: _WHOLE.index(type(k)))
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds <= {T.ByteType, T.ShortType, T.FloatType, T.DoubleType, T.IntegerType} and kinds & {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    one, two = _as_decimal(a), _as_decimal(b)
    if one and two:
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def reconciled(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames with the columns of all, in types that lose nothing."""
    types: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            types[field.name] = wider(types[field.name], field.dataType) if field.name in types else field.dataType
    shaped = [
        frame.select(*[
            (F.col(name) if name in frame.columns else F.lit(None)).cast(kind).alias(name) for name, kind in types.items()
        ])
        for frame in frames
    ]
    return reduce(DataFrame.unionByName, shaped)


def read_reconciled(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table of load folders. The schema of a load is that of one of its files."""
    groups: dict[str, list[str]] = {}
    for name in sorted(files.entries(spark, path)):
        if not name.startswith(("_", ".")):
            load = f"{path}/{name}"
            groups.setdefault(spark.read.parquet(load).schema.json(), []).append(load)
    return reconciled([spark.read.parquet(*loads) for loads in groups.values()])
