"""Grouped percentages, sums, means and counts kept up to date by the changes of a keyed table.

A flag profile is a function of sums and counts, and those add up. A changed key takes its old row out of
them (-1) and puts its new row in (+1); a new key only puts one in. So an update batch reads the partitions of
the register it touches and writes one row per touched group, whatever the size of the register, and the
profile is read from the stored sums.

Numbers are summed as decimals, not as floats: what was added can then be taken out without a residue, in
any order. Numbers that are no decimals of the chosen size (NaN, infinite, too large) count as missing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.operators.dedupe import last_after_sort
from cadastra.sources.staging import stage
from cadastra.streaming import deltas, incremental

_SIGN = "__sign"


@dataclass(frozen=True)
class Sums:
    """What is summed: groups, 0/1 flags, and numbers with the digits kept behind the point."""

    groups: tuple[str, ...]
    flags: tuple[str, ...]
    numbers: tuple[str, ...] = ()
    digits: int = 6

    @property
    def columns(self) -> list[str]:
        """Columns of the rows that go in."""
        return [*self.groups, *self.flags, *self.numbers]

    def schema(self, rows: T.StructType) -> T.StructType:
        """Schema of the stored sums."""
        groups = [T.StructField(g, rows[g].dataType) for g in self.groups]
        counts = [T.StructField(c, T.LongType()) for c in ("n_rows", *(f"{f}__set" for f in self.flags), *(f"{m}__n" for m in self.numbers))]
        return T.StructType(groups + counts + [T.StructField(f"{m}__sum", T.DecimalType(38, self.digits)) for m in self.numbers])


def sums_of(rows: DataFrame, spec: Sums, sign: Column | None = None) -> DataFrame:
    """Sums and counts per group, each row times its ``sign`` (1 without one)."""
    sign = F.lit(1) if sign is None else sign
    total = lambda c: F.sum(c).cast("long")
    as_number = {m: F.col(m).try_cast(f"decimal(28,{spec.digits})") for m in spec.numbers}
    nothing = F.lit(0).cast(f"decimal(38,{spec.digits})")
    return rows.groupBy(*spec.groups).agg(
        total(sign).alias("n_rows"),
        *[total(sign * F.coalesce(F.col(f).cast("long"), F.lit(0))).alias(f"{f}__set") for f in spec.flags],
        *[total(sign * as_number[m].isNotNull().cast("int")).alias(f"{m}__n") for m in spec.numbers],
        *[F.coalesce(F.sum(F.when(sign < 0, -as_number[m]).otherwise(as_number[m])).cast(f"decimal(38,{spec.digits})"), nothing).alias(f"{m}__sum") for m in spec.numbers],
    )


def merged_sums(parts: DataFrame, spec: Sums) -> DataFrame:
    """Sums of several batches brought together; groups whose last row was taken out disappear."""
    added = [c for c in spec.schema(parts.schema).names if c not in spec.groups]
    kinds = {f"{m}__sum": f"decimal(38,{spec.digits})" for m in spec.numbers}
    totals = parts.groupBy(*spec.groups).agg(*[F.sum(c).cast(kinds.get(c, "long")).alias(c) for c in added])
    return totals.where("n_rows <> 0")


def signed_changes(held: DataFrame, updates: DataFrame, key, order) -> DataFrame:
    """Rows of both with ``__sign``: -1 for the held row of every updated key, +1 for the last update of it.

    ``held`` may be any rows that include all held ones of the updated keys.
    """
    keys = as_list(key)
    newest = last_after_sort(updates, keys, order)
    changed = newest.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    old = held.join(changed, same_key, "left_semi")
    return old.withColumn(_SIGN, F.lit(-1)).unionByName(newest.select(*held.columns).withColumn(_SIGN, F.lit(1)))


def start_profile(register: DataFrame, root: str, spec: Sums) -> None:
    """Sums over a whole register, once, as batch 0."""
    deltas.add_batch(sums_of(register, spec), root, 0, lambda parts: merged_sums(parts, spec))


def batch_sums(
    spark: SparkSession, register: str, schema: T.StructType, updates: DataFrame, key, partition: str, order, spec: Sums
) -> DataFrame:
    """What one update batch adds to the sums, and takes from them. Reads the touched partitions only."""
    touched = [row[0] for row in updates.select(partition).distinct().collect()]
    held = incremental.touched_rows(spark, register, schema, partition, touched)
    return sums_of(signed_changes(held, updates, key, order), spec, F.col(_SIGN))


def refresh(
    spark: SparkSession, register: str, root: str, updates: DataFrame, key, partition: str, order, spec: Sums, batch: int
) -> None:
    """Apply one update batch to a partitioned register and to the sums kept for it below ``root``.

    Batches are numbered from 1. The sums of a batch are stored, and count, before the register changes; a
    repeated batch finds them stored and only applies the updates again, which gives the same register. So
    a run that dies anywhere in between is repaired by running the batch again.
    """
    updates = stage(updates, "updates")
    schema = updates.schema
    if not deltas.is_stored(spark, root, batch):
        incremental.finish_upsert(spark, register)
        added = batch_sums(spark, register, schema, updates, key, partition, order, spec)
        deltas.add_batch(added, root, batch, lambda parts: merged_sums(parts, spec))
    incremental.upsert_partitions(spark, register, updates, key, partition, order)


def stored_sums(spark: SparkSession, root: str, rows: T.StructType, spec: Sums) -> DataFrame:
    return merged_sums(deltas.parts(spark, root, spec.schema(rows)), spec)


def profile(sums: DataFrame, spec: Sums, count: str = "n_rows", prefix: str = "d_") -> DataFrame:
    """Sums in the form of :func:`aggs.flag_profile`: percent and sum of every flag, rounded means, row count."""
    short = {flag: flag.removeprefix(prefix) for flag in spec.flags}
    percent = {f: F.bround(F.col(f"{f}__set") * 100 / F.col("n_rows"), 1) for f in spec.flags}
    mean = {m: F.bround(F.try_divide(F.col(f"{m}__sum").cast("double"), F.col(f"{m}__n")), 0) for m in spec.numbers}
    return sums.select(
        *spec.groups,
        *[percent[f].alias(f"{name}_percent") for f, name in short.items()],
        *[mean[m].alias(m.removeprefix("n_")) for m in spec.numbers],
        *[F.col(f"{f}__set").alias(f"{name}_sum") for f, name in short.items()],
        F.col("n_rows").alias(count),
    )
