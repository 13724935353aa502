"""Numbering, ranking and running totals.

Ranks over summary tables (one row per area and period) use ordinary windows partitioned by the
period. Numbering or ranking a whole large table never goes through an unpartitioned window: the
rows are range-partitioned, numbered inside each partition, and shifted by the size of the
partitions before it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.functions.cols import ColumnLike, as_col, as_list
from cadastra.functions.numbers import ordinal
from cadastra.sources.inline import local_table
from cadastra.sources.staging import stage

_POS, _PART = "__pos", "__part"
# monotonically_increasing_id keeps the partition number above the lowest 33 bits.
_ID_BITS = 33


def _with_offsets(staged: DataFrame, size: Column, name: str) -> DataFrame:
    """Add the total of ``size`` over all earlier range partitions as column ``name``."""
    sizes = staged.groupBy(_PART).agg(size.cast("bigint").alias("size")).orderBy(_PART).collect()
    starts = accumulate([0] + [row["size"] for row in sizes])
    rows = [(row[_PART], start) for row, start in zip(sizes, starts)]
    # One row per shuffle partition of the staged table, so the broadcast is bounded by that number.
    offsets = local_table(staged.sparkSession, rows, f"{_PART} bigint, {name} bigint")
    return staged.join(F.broadcast(offsets), _PART)


def _range_staged(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumn(_POS, F.monotonically_increasing_id())
    # Staged so that partition numbers are facts on disk: a second evaluation could sample other bounds.
    staged = stage(numbered, label)
    return staged.withColumn(_PART, F.shiftright(_POS, _ID_BITS))


def row_numbers(df: DataFrame, order, name: str = "row_number") -> DataFrame:
    """Consecutive row number from 1 in the order of ``order``, which must identify rows."""
    columns = [as_col(c) for c in as_list(order)]
    staged = _range_staged(df, columns, "row-numbers")
    shifted = _with_offsets(staged, F.count("*"), "__start")
    inside = F.col(_POS).bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    return shifted.withColumn(name, F.col("__start") + inside + 1).drop(_POS, _PART, "__start")


def batch_numbers(df: DataFrame, key: str, size: int, name: str = "batch") -> DataFrame:
    """Distinct keys in key order, numbered in batches of exactly ``size`` from 0."""
    numbered = row_numbers(df.select(key).where(F.col(key).isNotNull()).distinct(), key, name)
    return numbered.withColumn(name, F.floor((F.col(name) - 1) / size))


def rank_of_values(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """Add the average-tie rank of ``value`` over the whole table (1, 1, 3 -> 1.5, 1.5, 3).

    Works on one row per distinct value, so a value shared by a third of all rows is one row here;
    the ranks are joined back afterwards. Null values get a null rank.
    """
    values = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__n"))
    staged = _range_staged(values, [F.col(value)], "value-ranks")
    upto = F.sum("__n").over(W.partitionBy(_PART).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    ranked = _with_offsets(staged, F.sum("__n"), "__start").withColumn("__upto", F.col("__start") + upto)
    last, count = F.col("__upto"), F.col("__n")
    ranks = ranked.select(value, (last - (count - 1) / 2).alias(name))
    return df.join(ranks, value, "left")


def average_rank(value: ColumnLike, by) -> Column:
    """Average-tie rank inside the groups of ``by`` of a summary table."""
    groups = [as_col(c) for c in as_list(by)]
    ties = F.count("*").over(W.partitionBy(*groups, as_col(value)))
    return F.rank().over(W.partitionBy(*groups).orderBy(as_col(value))) + (ties - 1) / 2


def placement(df: DataFrame, value: str, by, place: str = "place", text: str = "place_text") -> DataFrame:
    """Place from the top (highest value is 1) inside each group of a summary table, with ordinal text."""
    size = F.count("*").over(W.partitionBy(*[as_col(c) for c in as_list(by)]))
    placed = df.withColumn(place, size - average_rank(value, by) + 1)
    return placed.withColumn(text, ordinal(F.floor(place)))


def running_total(df: DataFrame, group, period: str, value: str, name: str) -> DataFrame:
    """Total per group and period, and its running total in period order.

    Rows are summed per (group, period) first, so a group's window holds one row per period
    (year, month, quarter or day), however many rows the group has.
    """
    groups = as_list(group)
    sums = df.groupBy(*groups, period).agg(F.sum(value).alias(value))
    frame = W.partitionBy(*groups).orderBy(period).rowsBetween(W.unboundedPreceding, 0)
    return sums.withColumn(name, F.sum(value).over(frame))
