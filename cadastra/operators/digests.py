"""Differences of stored tables by digests: only what differs is read.

A table is stored by buckets of its key, with one digest per bucket: the number of rows and two sums over hashes
of whole rows. Sums do not depend on the order of rows, and repeated rows count each time. Two versions of a
table are compared by their digests, a few numbers per bucket; rows are read and compared in the buckets that
differ only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.operators.sets import row_differences
from cadastra.sources.writers import rebalanced

BUCKET = "__bucket"


def bucket_of(key, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*as_list(key)), F.lit(buckets)).cast("int")


def digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per bucket: rows, and sums of two independent hashes of them. Columns may not hold maps."""
    # Null and a value never hash alike: the null marks go in as well.
    nulls = [F.col(c).isNull() for c in columns]
    first = F.xxhash64(*columns, *nulls)
    second = F.xxhash64(F.lit("second"), *columns, *nulls)
    wide = lambda h: F.sum(h.cast("decimal(20,0)")).alias  # noqa: E731  cannot overflow
    return df.groupBy(BUCKET).agg(F.count("*").alias("n_rows"), wide(first)("digest_1"), wide(second)("digest_2"))


def store_digested(df: DataFrame, path: str, key, buckets: int) -> None:
    """Write a table by buckets of its key, and its digests to ``<path>.digests``."""
    marked = df.withColumn(BUCKET, bucket_of(key, buckets))
    rebalanced(marked, [BUCKET]).write.partitionBy(BUCKET).parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    digests(stored, df.columns).coalesce(1).write.parquet(f"{path}.digests")


def differing_buckets(spark: SparkSession, one: str, two: str) -> list[int]:
    """Buckets whose digests differ, or that only one of the two has. Reads digests only."""
    a, b = (spark.read.parquet(f"{path}.digests") for path in (one, two))
    surplus = row_differences(a, b).select(BUCKET).distinct()
    return sorted(row[0] for row in surplus.collect())  # at most the number of buckets


def stored_differences(spark: SparkSession, one: str, two: str, schema: T.StructType) -> DataFrame:
    """:func:`sets.row_differences` of two tables of :func:`store_digested` with one key and bucket number."""
    wanted = F.col(BUCKET).isin(differing_buckets(spark, one, two))
    with_bucket = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    a, b = (spark.read.schema(with_bucket).parquet(path).where(wanted).select(*schema.names) for path in (one, two))
    return row_differences(a, b)
