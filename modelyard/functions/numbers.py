"""Number parsing and number formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"[0-9]+(_[0-9]+)*"
_DECIMAL = rf"^[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"


def parse_float(text: Column) -> Column:
    """Text to double under the rules of a scripting-language float literal.

    Spark's own cast would also take ``7d`` or ``0x1p3``, hence the guard. Digit
    groups (``1_0``) and the words inf / infinity / nan are accepted.
    """
    t = F.lower(F.trim(text))
    word = F.regexp_replace(t, r"^[+-]", "")
    sign = F.when(t.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return (
        F.when(t.rlike(_DECIMAL), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
        .when(word.isin("inf", "infinity"), sign * F.lit(float("inf")))
        .when(word == "nan", F.lit(float("nan")))
    )


def fixed(value: Column, places: int) -> Column:
    """Fixed-point text; ``format_number`` rounds half-even on the binary value."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))


def grouped(value: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(value, 0)


def float_text(value: Column) -> Column:
    """Shortest text of a double: positional from 1e-4 up to 1e16, else like 1e-07.

    Spark writes numbers below 1e-3 and from 1e7 on as ``1.25E7``; the digits are kept
    and the point is moved.
    """
    written = value.cast("string")
    sign = F.when(F.startswith(written, F.lit("-")), "-").otherwise("")
    digits = F.replace(F.regexp_extract(written, r"^-?([0-9.]+)E", 1), F.lit("."), F.lit(""))
    short = F.regexp_replace(digits, "0+$", "")  # of 1.0E7 the zero is no digit
    power = F.regexp_extract(written, r"E(-?[0-9]+)$", 1).cast("int")
    whole = F.rpad(short, F.greatest(power + 1, F.char_length(short)), F.lit("0"))
    fraction = F.substr(whole, power + 2)
    positional = F.concat(
        F.left(whole, power + 1), F.lit("."), F.when(fraction == "", "0").otherwise(fraction)
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), short)
    rest = F.substr(short, F.lit(2))
    scientific = F.concat(
        F.left(short, F.lit(1)),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""),
        F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.char_length(F.abs(power).cast("string"))), F.lit("0")),
    )
    moved = F.when(power.between(0, 15), positional).when(power == -4, small).otherwise(scientific)
    return F.when(~F.contains(written, F.lit("E")), written).otherwise(F.concat(sign, moved))
