"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkflow.model import ACCENTED, UNACCENTED

_MARK = "\u0001 "


def mode_key(mode: Column) -> Column:
    """Spelling-independent key of a travel mode: lower case, no accents, `/` and blanks as `_`."""
    return F.translate(F.lower(F.trim(mode)), ACCENTED + "/ ", UNACCENTED + "__")


def title_case(text: Column) -> Column:
    """Capital after every character that is not a cased letter, all other letters lower.

    `initcap` starts a word only after a blank. A mark that ends in a blank goes behind each other
    non-letter first and is taken out again.
    """
    marked = F.regexp_replace(
        text, r"([^\p{IsLowercase}\p{IsUppercase}\p{Lt} ])", "$1" + _MARK
    )
    return F.regexp_replace(F.initcap(marked), _MARK, "")


def number_text(number: Column) -> Column:
    """Shortest decimal text of a double, without exponent from 1e-4 up to 1e16."""
    plain = number.cast("string")
    size = F.abs(number)
    wide = (size >= 1e-4) & (size < 1e16) & ((size < 1e-3) | (size >= 1e7))
    digits = F.regexp_replace(number.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    return F.when(wide, F.regexp_replace(digits, r"\.$", ".0")).otherwise(plain)


def short_number_text(number: Column) -> Column:
    """Like `number_text`, with whole numbers as such."""
    return F.regexp_replace(number_text(number), r"\.0$", "")


def decimal_comma(amount: Column) -> Column:
    """Amount as text with a decimal comma."""
    return F.translate(amount.cast("string"), ".", ",")
