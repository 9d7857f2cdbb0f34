"""Salary and bonus expressions. Money is decimal throughout."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkflow.functions.text import mode_key
from perkflow.model import BONUS_RATE, DEFAULT_SALARY, ECO_MODE_KEYS, MONEY

# A number as text, with blanks around it; no suffixes and no names such as `nan`.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_TOO_LARGE = 1e17  # MONEY has 16 digits before the point; the cast decides close to the limit


def _readable(text: Column) -> Column:
    return F.coalesce(text.rlike(_NUMBER), F.lit(False))


def _read(text: Column) -> Column:
    """Readable text as money; null beyond the range of MONEY.

    The double decides the range first: a decimal with a huge exponent would be built digit by digit.
    """
    size = F.abs(text.try_cast("double"))
    return (
        F.when(size < 0.001, F.lit(Decimal("0.00")))
        .when(size < _TOO_LARGE, text.try_cast(MONEY))
        .cast(MONEY)
    )


def salary_amount(text: Column, default: Decimal = DEFAULT_SALARY) -> Column:
    """Salary text as money; what is no number becomes `default`, a number out of range null.

    Reading takes blanks around it, signs and exponents.
    """
    return F.when(_readable(text), _read(text)).otherwise(F.lit(default)).cast(MONEY)


def salary_defaulted(text: Column) -> Column:
    """True where `salary_amount` had to use its default."""
    return ~_readable(text)


def salary_out_of_range(text: Column) -> Column:
    """True for numbers that MONEY cannot hold."""
    return _readable(text) & _read(text).isNull()


def is_eco(mode: Column) -> Column:
    """True for modes that earn the bonus, whatever their spelling; false for a missing mode."""
    return F.coalesce(mode_key(mode).isin(*ECO_MODE_KEYS), F.lit(False))


def bonus_of(salary: Column, rate: Decimal = BONUS_RATE) -> Column:
    """Share of the salary, rounded half up to cents."""
    return F.round(salary * F.lit(rate), 2).cast(MONEY)


def eco_bonus(salary: Column, mode: Column, rate: Decimal = BONUS_RATE) -> Column:
    """Yearly bonus: a share of the salary for eco modes, else zero."""
    return F.when(is_eco(mode), bonus_of(salary, rate)).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)
