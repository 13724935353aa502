"""Aggregations and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions.cols import ColumnLike, as_col, as_list
from cadastra.functions.numbers import half_even_int


def inverse_weighted_mean(score: ColumnLike, weight: ColumnLike) -> Column:
    """Mean of ``score`` weighted by ``1 / weight`` over rows where both are present."""
    score, weight = as_col(score), as_col(weight)
    share = F.when(score.isNotNull(), F.try_divide(F.lit(1.0), weight))
    return F.try_divide(F.sum(score * share), F.sum(share))


def strict_sum(value: ColumnLike) -> Column:
    """Sum that is null as soon as one value of the group is null."""
    value = as_col(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def strict_mean(value: ColumnLike) -> Column:
    """Mean that is null as soon as one value of the group is null."""
    value = as_col(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def flag_percent(flag: ColumnLike) -> Column:
    """Percent of all rows of the group with the flag set, one decimal, ties to even."""
    return F.bround(F.coalesce(F.sum(as_col(flag)), F.lit(0)) * 100 / F.count(F.lit(1)), 1)


def flag_sum(flag: ColumnLike) -> Column:
    return F.coalesce(F.sum(as_col(flag)), F.lit(0))


def flag_profile(
    df: DataFrame, keys, flags: list[str], means: list[str] = (), count: str = "n_rows", prefix: str = "d_"
) -> DataFrame:
    """Per group: percent and sum of every flag, rounded mean of every number, and the row count.

    One aggregate pass; the flag prefix is replaced by the suffixes ``_percent`` and ``_sum``.
    """
    short = {flag: flag.removeprefix(prefix) for flag in flags}
    return df.groupBy(*as_list(keys)).agg(
        *[flag_percent(f).alias(f"{name}_percent") for f, name in short.items()],
        *[F.bround(F.avg(m), 0).alias(m.removeprefix("n_")) for m in means],
        *[flag_sum(f).alias(f"{name}_sum") for f, name in short.items()],
        F.count("*").alias(count),
    )


def first_value(value: ColumnLike, order: ColumnLike) -> Column:
    """Value of the first row of a group in a stated order."""
    return F.min_by(as_col(value), as_col(order))


def distinct_count(value: ColumnLike, exact: bool = True) -> Column:
    """Number of distinct values; ``exact=False`` takes a sketch of bounded size instead."""
    return F.countDistinct(as_col(value)) if exact else F.approx_count_distinct(as_col(value))


def mean_as_int(value: ColumnLike) -> Column:
    return half_even_int(F.avg(as_col(value)))


def pivot_wider(
    df: DataFrame, ids, names_from: str, values_from: str, values: list | None = None,
    how: str = "sum", max_values: int | None = None,
) -> DataFrame:
    """Values of one column become columns; a null name has no column.

    Pass ``values`` where they are known: a row with another value raises. Otherwise they are looked
    up, and more than ``max_values`` of them, if given, is an error, not a cut.
    """
    if values is None:
        values = column_values(df, names_from, max_values)
    else:
        df = df.withColumn(names_from, listed(names_from, values))
    return df.groupBy(*as_list(ids)).pivot(names_from, values).agg(getattr(F, how)(values_from))


def listed(column: str, values: list) -> Column:
    """The column itself; a value that is neither null nor in ``values`` raises when it is read."""
    value = F.col(column)
    stray = F.raise_error(F.concat(F.lit(f"{column} has a value that is not listed: "), value.cast("string")))
    return F.when(value.isNull() | value.isin(*values), value).otherwise(stray)


def column_values(df: DataFrame, column: str, max_values: int | None = None) -> list:
    """Sorted distinct values of a low-cardinality column; they come to the driver.

    More than ``max_values`` of them, if given, is an error.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct()
    found = (found if max_values is None else found.limit(max_values + 1)).collect()
    if max_values is not None and len(found) > max_values:
        raise ValueError(f"{column} has more than {max_values} values")
    return sorted(row[0] for row in found)


def unpivot_longer(df: DataFrame, ids, values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """Columns become (name, value) rows."""
    return df.unpivot(as_list(ids), values, name, value)


def cross_table(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of ``rows`` against the listed values of ``columns``, missing cells 0; another value raises."""
    df = df.withColumn(columns, listed(columns, values))
    cells = [F.count_if(F.col(columns) == value).alias(str(value)) for value in values]
    return df.groupBy(rows).agg(*cells)


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Count per equal-width bin; bins 0 and ``bins + 1`` take what lies outside."""
    bin_number = F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)).cast("int")
    return df.where(F.col(value).isNotNull()).groupBy(bin_number.alias("bin")).agg(F.count("*").alias("n"))


def lump_other(value: ColumnLike, keep: list[str], other: str = "Other") -> Column:
    """Values outside ``keep`` become ``other``."""
    value = as_col(value)
    return F.when(value.isin(*keep), value).otherwise(other)


def percent_drop(df: DataFrame, period: str, value: str) -> DataFrame:
    """One row: total of the first and of the last period, and the drop between them in percent."""
    totals = df.groupBy(period).agg(F.sum(value).alias("total"))
    ends = totals.agg(F.min_by("total", period).alias("first_total"), F.max_by("total", period).alias("last_total"))
    drop = (F.col("first_total") - F.col("last_total")) * 100 / F.col("first_total")
    return ends.withColumn("percent_drop", F.bround(drop, 1))


def per_capita(
    df: DataFrame, group, period: str, unit: str, amount: str, population: str, scale: float = 1000.0
) -> DataFrame:
    """Amount per head by group and period.

    Population repeats on every row of a unit, so it is averaged per (unit, period) before the
    units are added up; a null amount or population of a unit makes its group null.
    """
    groups = as_list(group)
    units = df.groupBy(*groups, period, unit).agg(
        (strict_mean(population) * 1000).alias("population"), strict_sum(amount).alias("amount")
    )
    totals = units.groupBy(*groups, period).agg(
        strict_sum("population").alias("population"), strict_sum("amount").alias("amount")
    )
    return totals.withColumn("per_capita", F.try_divide(F.col("amount") * scale, F.col("population")))
