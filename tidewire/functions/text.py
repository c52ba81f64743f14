"""Column functions with the text and number rules of Python's ``str``, ``int`` and ``float``.

All of them are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells that a CSV reader with default settings takes as missing. Matched on the
# untrimmed text.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*+"
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"

# The number texts Python accepts, written with ASCII digits. Group 1 is the number
# without white space, and without the sign of a NaN.
INTEGER_TEXT = rf"\A{_SPACE}([+-]?{_DIGITS}){_SPACE}\z"
FLOAT_TEXT = (
    rf"\A{_SPACE}(?:[+-](?=(?i)nan))?"
    rf"((?i)nan|[+-]?(?:inf(?:inity)?|(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:e[+-]?{_DIGITS})?)){_SPACE}\z"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def _number(c: Column, pattern: str) -> Column:
    """The number text in ``c``, ready to cast; empty, which casts to NULL, if there is none."""
    return F.replace(F.regexp_extract(c, pattern, 1), F.lit("_"), F.lit(""))


def parse_integer(c: Column) -> Column:
    """BIGINT, or NULL where the text is no integer or does not fit in 64 bits."""
    return _number(c, INTEGER_TEXT).try_cast("bigint")


def parse_float(c: Column) -> Column:
    """DOUBLE, or NULL where the text is no number. ``nan`` and ``inf`` are numbers."""
    return _number(c, FLOAT_TEXT).try_cast("double")


def two_decimals(v: Column) -> Column:
    """``f"{v:.2f}"`` for ``|v| < 2**63``; other values as their shortest text (``1.0E20``, ``NaN``).

    ``format_number`` rounds the binary value half to even, as Python does; Spark's ``round`` and
    ``format_string`` round its shortest decimal text half up. From 2**46 on, doubles lie further
    apart than a hundredth, and the fraction is a whole number of 64ths: there the arithmetic is exact.
    """
    v = v.cast("double")
    usual = F.replace(F.format_number(v, 2), F.lit(","), F.lit(""))
    hundredths = F.rint((F.abs(v) % 1.0) * 100.0).cast("int").cast("string")
    coarse = F.concat(v.cast("bigint").cast("string"), F.lit("."), F.lpad(hundredths, 2, "0"))
    return (
        F.when(F.abs(v) < 2.0**46, usual)
        .when(F.abs(v) < 2.0**63, coarse)
        .otherwise(v.cast("string"))
    )


def round_half_even(v: Column, digits: int = 4) -> Column:
    """``round(v, digits)`` of Python for 1 <= digits <= 4: correct rounding of the binary value."""
    if not 1 <= digits <= 4:
        raise ValueError("digits must be between 1 and 4")
    unit = 10.0**-digits
    rounded = F.replace(F.format_number(v, digits), F.lit(","), F.lit("")).cast("double")
    # below one unit the double nearest to half of it, which lies above the half, rounds up
    return (
        F.when(F.abs(v) < unit, F.when(F.abs(v) >= unit / 2, F.signum(v) * unit).otherwise(v * 0.0))
        # from 2**39 on, neighbouring doubles lie further apart than the last of four decimals
        .when(F.abs(v) < 2.0**39, rounded)
        .otherwise(v if digits == 4 else F.bround(v, digits))
    )


def shortest_text(v: Column) -> Column:
    """``str(v)`` of Python for a double: the shortest digits that give it back, with an exponent below 1e-4 and from 1e16.

    The digits are Java's: before version 19 a few doubles of full length get one digit more than needed.
    """
    plain = v.cast("double").cast("string")
    form = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, first, rest, power = (F.regexp_extract(plain, form, i) for i in (1, 2, 3, 4))
    rest = F.when(rest == "0", "").otherwise(rest)
    digits, power = F.concat(first, rest), power.try_cast("int")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    missing = F.concat(F.repeat(F.lit("0"), power + 1 - F.length(digits)), F.lit(".0"))
    point = F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(400)))
    large = F.concat(sign, F.when(F.length(digits) <= power + 1, F.concat(digits, missing)).otherwise(point))
    mantissa = F.concat(sign, first, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""))
    raised = F.concat(
        mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0")
    )
    # exponents of three digits are not cut to two
    raised = F.when(F.abs(power) < 100, raised).otherwise(
        F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.abs(power).cast("string"))
    )
    return (
        F.when(F.isnan(v), "nan")
        .when(F.abs(v) == float("inf"), F.when(v > 0, "inf").otherwise("-inf"))
        .when(~plain.contains("E"), plain)
        .when(power.between(-4, -1), small)
        .when(power.between(0, 15), large)
        .otherwise(raised)
    )
