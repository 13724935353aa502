"""One record per key, in each of its useful meanings.

========================== ======== ============ =============== =============================
operator                   ties     null key     null date       use
========================== ======== ============ =============== =============================
latest_with_ties           kept     dropped      dropped         register views
latest_of_group            kept     a group      last            newest rows of each group
latest_row                 one      a group      last            one row, stated tie-break
first_of_latest            one      a group      dropped         position of the maximum
last_after_sort            one      a group      first           sort, then last row
last_per_source            one per  a group      first           per file, then united
                           source
latest_overall             one      no key       ignored         newest row of a table
drop_repeated_keys         none     a group      no date         only keys that occur once
latest_of_single_source    one      a group      first           keys found in one file only
first_per_subset           one      a group      last            distinct by some columns
========================== ======== ============ =============== =============================
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.functions.cols import as_col, as_list

_RN = "__rn"


def latest_with_ties(df: DataFrame, key, ts: str, among: DataFrame | None = None) -> DataFrame:
    """All rows that carry the latest ``ts`` of their key; null keys and null dates drop out.

    The maximum per key is a narrow aggregate with map-side combine. The wide rows are then
    semi-joined on (key, ts), not on key alone: rows of one hot key spread over its dates, and
    what is left of the skew (many ties on one date) is split by adaptive execution.

    ``among`` is a filtered ``df``: the latest date is still that of the whole table, but only the
    filtered rows are shuffled and returned.
    """
    keys = as_list(key)
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    rows = df if among is None else among
    return rows.join(newest, [*keys, ts], "left_semi").select(*df.columns)


def latest_of_group(df: DataFrame, key, ts: str) -> DataFrame:
    """The same, but a null key is a group of its own and a group without any date keeps its rows.

    The maximum of a group without dates is null, so a null-safe comparison with it is all that
    differs. No window: a rank would bring all ties of one key into one task.
    """
    keys = [*as_list(key), ts]
    newest = df.groupBy(*as_list(key)).agg(F.max(ts).alias(ts)).toDF(*[f"__{k}" for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(newest, same, "left_semi")


def latest_row(df: DataFrame, key, ts: str, tiebreak) -> DataFrame:
    """Exactly one row per key: latest ``ts``, then the highest tie-break. A null date loses."""
    order = [F.col(ts).desc_nulls_last(), *[as_col(c).desc_nulls_last() for c in as_list(tiebreak)]]
    return _first_row(df, as_list(key), order)


def first_of_latest(df: DataFrame, key, ts: str, position) -> DataFrame:
    """First row in ``position`` order among the latest of each key; keys without a date drop out."""
    order = [F.col(ts).desc(), *[as_col(c).asc() for c in as_list(position)]]
    return _first_row(df.where(F.col(ts).isNotNull()), as_list(key), order)


def first_per_subset(df: DataFrame, subset, order) -> DataFrame:
    """One row per distinct ``subset``: the first in ``order``."""
    return _first_row(df, as_list(subset), [as_col(c).asc_nulls_last() for c in as_list(order)])


def _first_row(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    # Spark pushes the limit of 1 below the shuffle, so each map task sends one row per key.
    numbered = df.withColumn(_RN, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(_RN) == 1).drop(_RN)


def last_after_sort(df: DataFrame, key, order) -> DataFrame:
    """Last row per key after sorting by ``order`` with nulls first; a null key is a group.

    An aggregate with map-side combine, so the null group may be as large as it likes.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(*[as_col(c) for c in as_list(order)]))
    return df.groupBy(*as_list(key)).agg(row.alias("__row")).select("__row.*")


def last_per_source(df: DataFrame, source: str, key, order) -> DataFrame:
    """:func:`last_after_sort` inside each source (file), all sources united in one shuffle."""
    return last_after_sort(df, [source, *as_list(key)], order)


def latest_of_single_source(df: DataFrame, source: str, key, order) -> DataFrame:
    """:func:`last_per_source` followed by :func:`drop_repeated_keys`, in one aggregate.

    A key that occurs in several sources would be left with one row per source and then be dropped,
    so only keys of a single source remain, each with its last row.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(*[as_col(c) for c in as_list(order)]))
    found = df.groupBy(*as_list(key)).agg(
        row.alias("__row"), F.min(source).alias("__first"), F.max(source).alias("__last"),
        F.count(source).alias("__named"), F.count("*").alias("__n"),
    )
    # A null source is a source of its own.
    one = (F.col("__named") == 0) | ((F.col("__named") == F.col("__n")) & (F.col("__first") == F.col("__last")))
    return found.where(one).select("__row.*")


def latest_overall(df: DataFrame, ts: str, tiebreak) -> DataFrame:
    """The newest row of a table (top-1 per task, then one merge)."""
    order = [F.col(ts).desc_nulls_last(), *[as_col(c).desc() for c in as_list(tiebreak)]]
    return df.orderBy(*order).limit(1)


def drop_repeated_keys(df: DataFrame, key) -> DataFrame:
    """Rows whose key occurs exactly once; every row of a repeated key goes, nulls count as equal.

    A count with map-side combine that carries one row along: a key held by a third of the table
    shrinks to one partial row per task before the shuffle.
    """
    one = df.groupBy(*as_list(key)).agg(F.count("*").alias("__n"), F.first(F.struct(*df.columns)).alias("__row"))
    return one.where(F.col("__n") == 1).select("__row.*")
