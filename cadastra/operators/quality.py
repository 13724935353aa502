"""Gates and reports about keys, references, values and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.operators.joins import drop_listed
from cadastra.sources.writers import catalog_tables


class GateError(ValueError):
    """A quality gate found rows it must not find."""


def repeated_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*as_list(key)).agg(F.count("*").alias("n")).where("n > 1")


def orphan_keys(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct child keys without a parent; null keys are not orphans."""
    keys = child.select(*on).dropna().distinct()
    return drop_listed(keys, parent, on)


def unknown_values(requested: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """Requested values that never occur in ``column`` of ``df``; must be empty to go on."""
    return requested.join(df.select(column).distinct(), column, "left_anti")


def require_none(found: DataFrame, message: str) -> None:
    """Raise :class:`GateError` when a gate report has rows."""
    example = found.limit(1).collect()
    if example:
        raise GateError(f"{message}, e.g. {example[0].asDict()}")


def require_in(value, allowed: list, what: str) -> None:
    if value not in allowed:
        raise GateError(f"{what} must be one of {allowed}, not {value!r}")


def require_between(value, low, high, what: str) -> None:
    """Raise unless ``low <= value <= high`` (a year in its window)."""
    if value is None or not low <= value <= high:
        raise GateError(f"{what} must lie between {low} and {high}, not {value!r}")


def outside_window(df: DataFrame, column: str, low, high) -> DataFrame:
    """Distinct values of a column outside ``low``..``high``, null included; must be empty to go on."""
    inside = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return df.where(~inside).select(column).distinct()


def missing_percent(column: str) -> Column:
    return F.avg(F.col(column).isNull().cast("int")) * 100


def profile(df: DataFrame, columns: list[str] | None = None, sketches: bool = True) -> DataFrame:
    """One row per column: type, min, max, distinct (approximate), mean, spread, quartiles, count, null %.

    A single aggregate over the table. Quartiles and distinct counts are bounded-memory sketches and
    most of its cost; ``sketches=False`` leaves them out.
    """
    types = dict(df.dtypes)
    rows = []
    for name in columns or df.columns:
        col = F.col(name)
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        number = col.cast("double") if numeric else F.lit(None).cast("double")
        quartiles = F.percentile_approx(number, [0.25, 0.5, 0.75]) if numeric else F.array(*[F.max(number)] * 3)
        sketched = [
            F.approx_count_distinct(col).alias("approx_unique"),
            *[quartiles[i].alias(f"q{q}") for i, q in enumerate((25, 50, 75))],
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(types[name]).alias("column_type"),
                F.min(col).cast("string").alias("min"),
                F.max(col).cast("string").alias("max"),
                *(sketched if sketches else []),
                F.avg(number).alias("avg"),
                F.stddev(number).alias("std"),
                F.count(F.lit(1)).alias("count"),
                missing_percent(name).alias("null_percentage"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def with_column_notes(df: DataFrame, notes: dict[str, dict[str, str]]) -> DataFrame:
    """Attach comment, unit and label to columns; they travel with the schema and into Parquet."""
    for name, note in notes.items():
        df = df.withMetadata(name, note)
    return df


def column_notes(df: DataFrame) -> DataFrame:
    """One row per column: position, type, comment, unit, label and the number of non-null values."""
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(position).alias("position"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            *[F.lit(field.metadata.get(k)).cast("string").alias(k) for k in ("comment", "unit", "label")],
            F.count(field.name).alias("n_values"),
        )
        for position, field in enumerate(df.schema, start=1)
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def catalog_columns(spark: SparkSession, tables: list[str] | None = None, database: str | None = None) -> DataFrame:
    """Columns and row count, one row per column, of all stored tables of a database, or of those named (views too)."""
    if tables is None:
        named = {table: f"{database}.{table}" if database else table for table in catalog_tables(spark, database)}
    else:
        named = {table: table for table in tables}
    if not named:
        raise LookupError("no table to describe")
    reports = []
    for table, full in named.items():
        df = spark.table(full)
        fields = [
            F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"))
            for f in df.schema
        ]
        counted = df.agg(F.count("*").alias("n_rows"))
        reports.append(
            counted.select(F.lit(table).alias("table_name"), "n_rows", F.inline(F.array(*fields)))
        )
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def score_report(df: DataFrame, entity: str, score: str, red: float, below: float) -> DataFrame:
    """Mean score per entity with flags for "red" and "below the bar"."""
    means = df.groupBy(entity).agg(F.avg(score).alias("mean_score"), F.count("*").alias("n"))
    return means.withColumns(
        {
            "is_red": (F.col("mean_score") < red).cast("int"),
            "is_below": (F.col("mean_score") < below).cast("int"),
        }
    )


def entities_missing(df: DataFrame, entity: str, column: str) -> DataFrame:
    """Entities with rows that lack a value (a licence number), and how many rows that are."""
    return df.where(F.col(column).isNull()).groupBy(entity).agg(F.count("*").alias("n_missing"))


def split_valid(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition and rows that do not; null counts as not."""
    ok = F.coalesce(condition, F.lit(False))
    return df.where(ok), df.where(~ok)


def conforming_share(df: DataFrame, condition: Column) -> DataFrame:
    """One row: rows that meet a condition, rows that do not (null counts as not), and the percentage."""
    ok = F.coalesce(condition.cast("int"), F.lit(0))
    return df.agg(
        F.sum(ok).alias("n_valid"),
        F.sum(1 - ok).alias("n_invalid"),
        (F.avg(ok) * 100).alias("valid_pct"),
    )
