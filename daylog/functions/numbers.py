"""Casts with defaults, zero/empty handling, exact rounding and order-free sums."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLIONTH = Decimal("0.000001")
# Means keep twelve decimals of each value, for hours that came from milliseconds.
EXACT_MEAN = "decimal(28,12)"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def zero_to_null(number: Column) -> Column:
    return F.nullif(number, F.lit(0))


def cast_or(value: Column, type_name: str, default) -> Column:
    """Cast; absent, null, empty and unreadable values become ``default``."""
    return F.coalesce(value.try_cast(type_name), F.lit(default).cast(type_name))


def truthy_or(first: Column, second: Column) -> Column:
    """``first`` unless it is null or zero."""
    return F.coalesce(zero_to_null(first), second)


def is_truthy_number(number: Column) -> Column:
    return F.coalesce(number, F.lit(0)) != 0


def is_truthy_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def fixed(number: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, ties decided on the exact binary value (half to even)."""
    return F.replace(F.format_number(number.cast("double"), digits), F.lit(","), F.lit(""))


def round_exact(number: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even: 7.25 -> 7.2, 148.75 -> 148.8, 0.35 -> 0.3."""
    return fixed(number, digits).cast("double")


def round_whole(number: Column) -> Column:
    return F.rint(number).cast("bigint")


def truncate(number: Column) -> Column:
    return number.cast("bigint")


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)


def float_text(number: Column) -> Column:
    """Shortest decimal text of a double without an exponent: 161.2, 70.0, 12345678.5."""
    plain = F.regexp_replace(number.cast("decimal(38,10)").cast("string"), r"0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(number)
    ordinary = (size == 0) | ((size >= 1e-3) & (size < 1e7))
    return F.when(ordinary, number.cast("string")).otherwise(plain)


def exact_sum(number: Column) -> Column:
    """Sum to six decimals, equal on every run whatever order the partial sums arrive in.

    Whole parts and millionths are summed as two long integers, which stay in the fast hash aggregate;
    they meet in a decimal once per group.
    """
    whole = F.floor(number)
    millionths = F.rint((number - whole) * 1_000_000).cast("bigint")
    return F.sum(whole).cast("decimal(20,0)") + F.sum(millionths).cast("decimal(20,0)") * F.lit(MILLIONTH)


def exact_mean(number: Column) -> Column:
    """Mean of the non-null values from a decimal sum, equal on every run; null if there are none."""
    return F.sum(number.cast(EXACT_MEAN)).cast("double") / F.nullif(F.count(number), F.lit(0))


def above_zero(number: Column, when: Column | None = None) -> Column:
    """The value where it is above zero (and ``when`` holds), else null."""
    return F.when(number > 0 if when is None else (number > 0) & when, number)


def mean_skip_zero(number: Column) -> Column:
    return exact_mean(zero_to_null(number))
