"""Numeric functions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from cadastra.functions.cols import ColumnLike, as_col


def percent_ratio(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part * 100 / whole``; null for a zero denominator."""
    return F.try_divide(as_col(part) * 100, as_col(whole))


def floor_midpoint(low: ColumnLike, high: ColumnLike) -> Column:
    """Midpoint of two integers, rounded down also for negative spans."""
    low, high = as_col(low), as_col(high)
    return (F.floor((high - low) / 2) + low).cast("int")


def row_mean(*values: ColumnLike) -> Column:
    """Mean across columns of one row, nulls skipped; null if every value is null."""
    columns = [as_col(v).cast("double") for v in values]
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns])
    present = reduce(add, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, present)


def half_even_int(value: ColumnLike) -> Column:
    """Double to int with ties to even (a plain cast truncates)."""
    return F.rint(as_col(value)).cast("int")


def ordinal(value: ColumnLike) -> Column:
    """1 -> ``1st``, 2 -> ``2nd``, 11 -> ``11th``."""
    number = as_col(value).cast("bigint")
    last_two, last = F.pmod(number, F.lit(100)), F.pmod(number, F.lit(10))
    suffix = (
        F.when(last_two.between(11, 13), "th")
        .when(last == 1, "st")
        .when(last == 2, "nd")
        .when(last == 3, "rd")
        .otherwise("th")
    )
    return F.concat(number.cast("string"), suffix)


# Unit scalings (fixed values).
def square_metres_to_km2(value: ColumnLike) -> Column:
    return as_col(value) / 1e6


def mwh_to_gwh(value: ColumnLike) -> Column:
    return as_col(value) / 1000


def kilotonnes_to_tonnes(value: ColumnLike) -> Column:
    return as_col(value) * 1000
