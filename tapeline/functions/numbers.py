"""Number repair: missing values, text to number, identifiers, units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number text, the decimal-comma form, unit divisors, sentinel.
NUMBER_TEXT = r"^([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?(?i:inf|infinity|nan))$"
DECIMAL_COMMA = r"^([+-]?\d{1,4}),(\d+)$"
UNIT_DIVISOR = {"mm": 1000.0, "cm": 100.0, "m": 1.0}
SENTINEL = 9999.0
METRE_DIGITS = 3

# Each rule below names its input once: a repeated input would be expanded again and again when
# rules are stacked, until the generated code is too large to compile.


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))


def finite(c: Column) -> Column:
    """NaN and +-inf become NULL: the one missing value of every later step. NaN sorts above inf."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_double(c: Column) -> Column:
    """Text to double, NULL when it is no number. ``inf`` and ``nan`` survive for the sensors."""
    return F.regexp_extract(F.trim(c), NUMBER_TEXT, 1).try_cast("double")


def parse_number(c: Column) -> Column:
    """Repair commas, then cast: one to four digits before a single comma make it a decimal comma,
    every other comma is a thousands mark. So ``1,736`` reads as 1.736."""
    return to_double(F.replace(F.regexp_replace(F.trim(c), DECIMAL_COMMA, "$1.$2"), F.lit(","), F.lit("")))


def null_sentinel(c: Column, sentinel: float = SENTINEL) -> Column:
    """Numeric sentinel to NULL."""
    return F.nullif(c, F.lit(sentinel))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def clean_id(c: Column) -> Column:
    """Identifier as text: trailing ``.0`` dropped, scientific notation written out, NULL as ''."""
    s = F.trim(c)
    sci = s.rlike(r"^[+-]?\d+(\.\d+)?[eE][+-]?\d+$")
    expanded = s.try_cast("decimal(38,0)").cast("string")
    return F.coalesce(F.when(sci, expanded).otherwise(F.regexp_replace(s, r"\.0$", "")), F.lit(""))


def to_meters(value: Column, unit: Column) -> Column:
    """Metres quantised to 0.001; NULL for a non-finite value or an unknown unit."""
    divisor = F.lit(None).cast("double")
    for name, d in UNIT_DIVISOR.items():
        divisor = F.when(unit == name, F.lit(d)).otherwise(divisor)
    return F.round(finite(value) / divisor, METRE_DIGITS)


def normalize_sex(c: Column, source: Column) -> Column:
    """M/F: two Korean words in the 7th survey, upper-cased letters elsewhere, else NULL."""
    s = F.trim(c)
    korean = F.when(s == "남", "M").when(s == "여", "F").otherwise(s)
    letter = F.upper(F.when(source == "7th", korean).otherwise(s))
    return F.when(letter.isin("M", "F"), letter)


def ratio(n: Column, d: Column) -> Column:
    """n / d, NULL when d is NULL or zero."""
    return F.try_divide(n.cast("double"), d.cast("double"))
