"""Unions, differences and equality of frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cadastra.functions.cols import as_list
from cadastra.operators.joins import presence
from cadastra.sources.inline import local_table


def unite(*frames: DataFrame) -> DataFrame:
    """Union by name; numbers widen to the common type."""
    return reduce(DataFrame.unionByName, frames)


def unite_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union by name with missing columns null and the source name in ``tag``."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def append_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """Add hand-made rows given in column order."""
    return df.union(local_table(df.sparkSession, rows, df.schema))


def unite_distinct(*frames: DataFrame) -> DataFrame:
    return unite(*frames).distinct()


def key_difference(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` does not have; nulls compare equal."""
    return presence(a, b, key).where("in_a = 1 AND in_b = 0").select(*as_list(key))


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that the two frames hold a different number of times, with the surplus of ``a``.

    One aggregate over the union instead of two set differences: one shuffle, combined map-side.
    """
    counted = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
    surplus = counted.groupBy(*a.columns).agg(F.sum("__side").alias("surplus"))
    return surplus.where("surplus <> 0")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: number of distinct differing rows and whether the frames are equal as multisets."""
    differing = row_differences(a, b).agg(F.count("*").alias("n_differing"))
    return differing.withColumn("identical", F.col("n_differing") == 0)
