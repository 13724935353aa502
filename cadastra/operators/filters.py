"""Filters that need a value from the table itself.

The value comes from a scalar subquery, so the plan has no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadastra.functions.cols import ColumnLike, as_col
from cadastra.functions.dates import last_complete_year


def maximum(df: DataFrame, value: ColumnLike) -> Column:
    """Maximum of the table as a scalar usable in expressions over any frame."""
    return df.select(F.max(as_col(value))).scalar()


def minimum(df: DataFrame, value: ColumnLike) -> Column:
    return df.select(F.min(as_col(value))).scalar()


def at_maximum(df: DataFrame, value: ColumnLike) -> DataFrame:
    """Rows at the maximum of the whole table."""
    return df.where(as_col(value) == maximum(df, value))


def at_extremes(df: DataFrame, value: ColumnLike) -> DataFrame:
    """Rows at the minimum or the maximum of the whole table."""
    return df.where((as_col(value) == minimum(df, value)) | (as_col(value) == maximum(df, value)))


def in_years(df: DataFrame, date: str, first, last=None) -> DataFrame:
    """Rows of the years ``first`` to ``last`` (integers or scalar columns; ``None``: without end).

    Compares the stored column itself, so that files and row groups outside are skipped.
    """
    kind = df.schema[date].dataType

    def start(year) -> Column:
        return F.make_date(F.lit(year), F.lit(1), F.lit(1)).cast(kind)

    rows = df.where(F.col(date) >= start(first))
    return rows if last is None else rows.where(F.col(date) < start(last + 1))


def _year_edge(df: DataFrame, end: Column, months: int = 0) -> Column:
    """First day of the year of a bound, some months on, as a scalar."""
    return df.select(F.add_months(F.trunc(end, "year"), months)).scalar()


def in_latest_year(df: DataFrame, date: str) -> DataFrame:
    """Rows of the calendar year of the latest date of the whole table."""
    return df.where(F.col(date) >= _year_edge(df, F.max(date)).cast(df.schema[date].dataType))


def in_extreme_years(df: DataFrame, date: str) -> DataFrame:
    """Rows of the first or the last calendar year of the whole table."""
    kind = df.schema[date].dataType
    second, last = _year_edge(df, F.min(date), 12), _year_edge(df, F.max(date))
    return df.where((F.col(date) < second.cast(kind)) | (F.col(date) >= last.cast(kind)))


def _drawn(key: str, seed: int) -> Column:
    """Seeded hash of a row's key, and the key, in the order in which rows are drawn."""
    return F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("hash"), F.col(key).alias("key"))


def _cell(drawn: Column, digits: int) -> Column:
    return F.conv(F.substring(drawn["hash"], 1, digits), 16, 10).cast("int")


#: Leading hash digits by which rows are counted: 65,536 cells over a table, 4,096 in each of many areas.
_DIGITS, _AREA_DIGITS = 4, 3


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows (all, if there are fewer) by a seeded hash of the key, which must identify rows.

    The same rows on every run and with any partitioning. The hash of the ``n``-th row is found first: rows
    are counted by leading digits, and only the keys of the one cell in which the ``n``-th lies, 1 of 65,536,
    are put in order. The sample is then a filter, so no task gathers rows. A row with a null key is drawn last.
    """
    drawn = _drawn(key, seed)
    known = df.where(F.col(key).isNotNull())
    counts = known.groupBy(_cell(drawn, _DIGITS).alias("cell")).agg(F.count("*").alias("n")).orderBy("cell").collect()  # one row per cell
    before = 0
    for row in counts:
        if before + row["n"] >= n:
            break
        before += row["n"]
    else:
        missing = df.where(F.col(key).isNull()).limit(n - before)
        return known.unionAll(missing) if before < n else known
    if n <= 0:
        return df.limit(0)
    at_cut = known.where(_cell(drawn, _DIGITS) == row["cell"]).select(drawn.alias("drawn"))
    last = at_cut.orderBy("drawn").limit(n - before).agg(F.max("drawn").alias("last"))
    return known.where(drawn <= last.scalar())


def sample_rows_per_area(df: DataFrame, area: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of every area (all, if it has fewer), drawn like :func:`sample_rows`; rows with a null key or area are left out.

    An area may hold any share of the table: only its counts by cell, 4,096 at most, and the keys of the cell at
    its cut are brought together.
    """
    drawn = _drawn(key, seed)
    known = df.where(F.col(key).isNotNull() & F.col(area).isNotNull())
    cells = known.groupBy(F.col(area).alias("__area"), _cell(drawn, _AREA_DIGITS).alias("__cell")).agg(F.count("*").alias("n"))
    upto = W.partitionBy("__area").orderBy("__cell").rowsBetween(W.unboundedPreceding, 0)
    cuts = cells.withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") >= n) & (F.col("upto") - F.col("n") < n))
    cuts = cuts.select("__area", "__cell", (F.lit(n) - F.col("upto") + F.col("n")).alias("wanted"))
    rows = known.select(F.col(area).alias("__a"), drawn.alias("drawn"))
    at_cut = rows.join(cuts, (F.col("__a") == F.col("__area")) & (_cell(F.col("drawn"), _AREA_DIGITS) == F.col("__cell")))
    place = F.row_number().over(W.partitionBy("__area").orderBy("drawn"))
    last = at_cut.withColumn("__place", place).where(F.col("__place") == F.col("wanted")).select("__area", F.col("drawn").alias("__last"))
    joined = known.join(last, F.col(area) == F.col("__area"), "left")
    return joined.where(F.col("__last").isNull() | (drawn <= F.col("__last"))).select(*df.columns)


def trailing_years(df: DataFrame, date: str, years: int) -> DataFrame:
    """Rows from ``years`` years before the last complete year up to and including it."""
    kind = df.schema[date].dataType
    bounds = df.select(last_complete_year(F.max(date)).alias("y"))
    # Bounds in the type of the column itself, so that files and row groups outside can be skipped.
    start = bounds.select(F.make_date(F.col("y") - years, F.lit(1), F.lit(1)).cast(kind)).scalar()
    stop = bounds.select(F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast(kind)).scalar()
    return df.where((F.col(date) >= start) & (F.col(date) < stop))
