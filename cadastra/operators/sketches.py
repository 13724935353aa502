"""Column profiles that can be stored and merged: an append is profiled without reading the table again.

Counts, extremes, sums and two sketches are kept per column, per partition of a table or per batch. They add up:
the profile of a whole is merged from those of its parts. Distinct values come from a HyperLogLog sketch
(standard error about 1.04 / sqrt(2 ** bits), 1.6 % with 12 bits), quartiles from a KLL sketch (rank error about
1.3 % with its default size). Both have a bounded size, whatever they have seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.streaming import deltas

HLL_BITS = 12
_STATE = (
    "column_name string, column_type string, n_rows bigint, n_values bigint, low_text string, high_text string, low double, high double,"
    " total double, spread double, distinct_sketch binary, quantile_sketch binary"
)


def _countable(df: DataFrame, name: str) -> Column:
    """The column in a type the distinct sketch takes."""
    kind = df.schema[name].dataType
    return F.col(name) if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else F.col(name).cast("string")


def column_sketches(df: DataFrame, columns: list[str] | None = None, by=(), bits: int = HLL_BITS) -> DataFrame:
    """One row per column (and group of ``by``) with all that a profile needs, from one aggregate over ``df``.

    Numbers are profiled as doubles, NaN counting as a missing number but as a value; other columns by
    their text, so that the extremes of times are those of their ISO form.
    """
    types, rows = dict(df.dtypes), []
    for name in columns or [c for c in df.columns if c not in as_list(by)]:
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        number = F.nanvl(F.col(name).cast("double"), F.lit(None)) if numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if numeric else F.col(name).cast("string")
        none = F.lit(None).cast("binary")
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(types[name]).alias("column_type"), F.count(F.lit(1)).alias("n_rows"), F.count(name).alias("n_values"),
            F.min(text).alias("low_text"), F.max(text).alias("high_text"), F.min(number).alias("low"), F.max(number).alias("high"),
            F.sum(number).alias("total"), (F.var_pop(number) * F.count(number)).alias("spread"),
            F.hll_sketch_agg(_countable(df, name), bits).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(number) if numeric else none).alias("quantile_sketch"),
        ))
    grouped = df.groupBy(*as_list(by)).agg(F.array(*rows).alias("__rows"))
    return grouped.select(*as_list(by), F.inline("__rows"))


def merge_sketches(parts: DataFrame, by=()) -> DataFrame:
    """Rows of several parts brought down to one per column (and group of ``by``)."""
    mean = F.try_divide(F.col("total"), F.col("n_values"))
    merged = parts.groupBy(*as_list(by), "column_name", "column_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("total").alias("total"),
        # Squared distances from the common mean: those within the parts and those between their means.
        F.sum("spread").alias("__within"), F.sum(F.col("total") * mean).alias("__squares"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )
    between = F.greatest(F.col("__squares") - F.try_divide(F.col("total") * F.col("total"), F.col("n_values")), F.lit(0.0))
    numeric = F.col("total").isNotNull()
    return merged.withColumns({
        "spread": F.when(numeric, F.col("__within") + between), "quantile_sketch": F.when(numeric, F.col("quantile_sketch")),
    }).select(*as_list(by), *[part.split()[0] for part in _STATE.split(", ")])


def profile_of(sketches: DataFrame, by=()) -> DataFrame:
    """The columns of :func:`quality.profile`, from sketches instead of rows."""
    quartile = {q: F.when(F.col("total").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q / 100))) for q in (25, 50, 75)}
    mean = F.try_divide(F.col("total"), F.col("n_values"))
    return sketches.select(
        *as_list(by), "column_name", "column_type",
        F.coalesce("low_text", F.col("low").cast("string")).alias("min"), F.coalesce("high_text", F.col("high").cast("string")).alias("max"),
        F.hll_sketch_estimate("distinct_sketch").alias("approx_unique"), *[quartile[q].alias(f"q{q}") for q in quartile],
        mean.alias("avg"), F.sqrt(F.try_divide(F.col("spread"), F.col("n_values") - 1)).alias("std"),
        F.col("n_rows").alias("count"), (F.try_divide(F.col("n_rows") - F.col("n_values"), F.col("n_rows")) * 100).alias("null_percentage"),
    )


def append_profiled(batch: DataFrame, path: str, sketches: str, number: int, columns: list[str] | None = None, by=()) -> None:
    """Append a batch to a Parquet table as ``batch=<number>`` and its sketches to those stored beside it.

    Only the batch is read. A repeated batch replaces its own rows and counts once in the sketches.
    """
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/batch={number}")
    deltas.add_batch(column_sketches(stored, columns, by), sketches, number, lambda parts: merge_sketches(parts, by))


def stored_sketches(spark: SparkSession, sketches: str, schema: T.StructType | None = None, by=()) -> DataFrame:
    """The merged sketches of all batches; ``schema`` gives the types of the columns of ``by``."""
    groups = [schema[c] for c in as_list(by)] if by else []
    return merge_sketches(deltas.parts(spark, sketches, T.StructType(groups + T.StructType.fromDDL(_STATE).fields)), by)
