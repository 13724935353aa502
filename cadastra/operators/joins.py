"""Equi-joins.

No side is forced to broadcast. Spark broadcasts a lookup when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, with hot keys split by
adaptive execution.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from cadastra.functions.cols import as_list


@dataclass(frozen=True)
class Lookup:
    """One arm of a star: ``on`` maps fact column to lookup column, ``columns`` are taken over.

    ``many`` marks a left-joined table with many rows per key. Spark can split a hot key only on the
    left side of a left join, so that join is made as an inner join plus the rows without a match.
    """

    frame: DataFrame
    on: dict[str, str]
    columns: list[str] = field(default_factory=list)
    how: str = "left"
    prefix: str = "lookup"
    many: bool = False


def enrich(fact: DataFrame, *lookups: Lookup) -> DataFrame:
    """Join each lookup in turn and take over its listed columns.

    A column name that is already taken gets the lookup's prefix, so the result never has two
    columns of one name.
    """
    for number, lookup in enumerate(lookups):
        taken = set(fact.columns)
        keys = {f"__key_{number}_{i}": pair for i, pair in enumerate(lookup.on.items())}
        narrow = lookup.frame.select(
            *[F.col(right).alias(name) for name, (_, right) in keys.items()],
            *[F.col(c).alias(f"{lookup.prefix}_{c}" if c in taken else c) for c in lookup.columns],
        )
        condition = reduce(and_, [fact[left] == narrow[name] for name, (left, _) in keys.items()])
        if lookup.many and lookup.how == "left":
            matched = fact.join(narrow, condition, "inner").drop(*keys)
            unmatched = drop_listed(fact, lookup.frame, lookup.on)
            fact = matched.unionByName(unmatched, allowMissingColumns=True)
        else:
            fact = fact.join(narrow, condition, lookup.how).drop(*keys)
    return fact


def keep_listed(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key occurs in another frame (semi join; the list is never collected)."""
    return _half_join(df, keys, on, "left_semi")


def drop_listed(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key does not occur in another frame; rows with a null key stay."""
    return _half_join(df, keys, on, "left_anti")


def _half_join(df: DataFrame, keys: DataFrame, on: dict[str, str], how: str) -> DataFrame:
    names = {f"__key_{i}": pair for i, pair in enumerate(on.items())}
    # Distinct: only the left side of these joins can be split, so a hot key in the list must shrink
    # to one row per task before it is shuffled. The exchange of the aggregate serves the join too.
    listed = keys.select(*[F.col(right).alias(name) for name, (_, right) in names.items()]).distinct()
    return df.join(listed, reduce(and_, [df[left] == listed[n] for n, (left, _) in names.items()]), how)


def presence(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Keys of two registers with 0/1 columns ``in_a``, ``in_b`` and ``in_both``.

    A union and one aggregate instead of a full outer join: repeats collapse before the shuffle.
    """
    keys = as_list(key)
    both = a.select(*keys, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(*keys, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    flags = both.groupBy(*keys).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return flags.withColumn("in_both", F.col("in_a") * F.col("in_b"))


def presence_by_area(a: DataFrame, b: DataFrame, key, area) -> DataFrame:
    """Per area: number of keys, how many in each register and in both, and the fractions."""
    flags = presence(a, b, [*as_list(area), *as_list(key)])
    counts = flags.groupBy(*as_list(area)).agg(
        F.count("*").alias("n_keys"),
        *[F.sum(c).alias(f"n_{c}") for c in ("in_a", "in_b", "in_both")],
    )
    return counts.withColumns(
        {f"fraction_{c}": F.col(f"n_{c}") / F.col("n_keys") for c in ("in_a", "in_b")}
    )


def matched_share(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """One row: distinct keys of ``a``, those with a match in ``b``, and the percentage."""
    flags = presence(a, b, key).where("in_a = 1")
    return flags.agg(
        F.count("*").alias("n_keys"),
        F.sum("in_b").alias("n_matched"),
        (F.avg("in_b") * 100).alias("matched_pct"),
    )
