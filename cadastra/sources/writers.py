"""Sinks and multi-table loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import ColumnLike, as_col


def replace_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> DataFrame:
    """Write ``path`` anew as Parquet and return the stored table."""
    rebalanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of one table partition together, in files of even size: hot partitions are split again."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_catalog_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace an external catalog table."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_bucketed_table(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Create or replace a catalog table of ``buckets`` files, bucketed and sorted by ``key``.

    Tables of one bucket number join on their keys, and aggregate by them, without a shuffle.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append after bringing columns into the order and types of ``schema``; a mismatch raises."""
    df.to(schema).write.mode("append").parquet(path)


def conform_update(df: DataFrame, stamp: str, schema: T.StructType | None = None) -> DataFrame:
    """Update batch in register form: upper-case names, ``-`` to ``_``, ``filename = update - <stamp>``."""
    named = df.toDF(*[c.upper().replace("-", "_") for c in df.columns])
    stamped = named.withColumn("filename", F.lit(f"update - {stamp}"))
    return stamped.to(schema) if schema is not None else stamped


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a non-materialised view; only its plan is kept."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def catalog_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the stored tables of a database (the current one by default); temporary views are not stored."""
    listed = spark.catalog.listTables(database)
    return sorted(table.name for table in listed if not table.isTemporary)


def export_tables(
    spark: SparkSession, directory: str, tables: list[str] | None = None, database: str | None = None
) -> dict[str, str]:
    """Write tables to ``<directory>/<table>`` as Parquet: all stored ones of a database, or those named (views too)."""
    if tables is None:
        named = {table: f"{database}.{table}" if database else table for table in catalog_tables(spark, database)}
    else:
        named = {table: table for table in tables}
    paths = {table: f"{directory}/{table}" for table in named}
    for table, path in paths.items():
        spark.table(named[table]).write.mode("overwrite").parquet(path)
    return paths


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Headed CSV, nulls as empty cells."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", "").csv(path)


def geojson_features(df: DataFrame, x: ColumnLike, y: ColumnLike, properties: list[str]) -> DataFrame:
    """One GeoJSON point feature per row as column ``value`` (JSON lines)."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(as_col(x), as_col(y)).alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")
    )
    return df.select(F.to_json(feature).alias("value"))


def geojson_carried(df: DataFrame, geometry: ColumnLike, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row as column ``value``, its geometry a GeoJSON text carried as it is (null: none)."""
    fields = [F.lit('{"type":"Feature","geometry":'), F.coalesce(as_col(geometry), F.lit("null"))]
    fields += [F.lit(',"properties":'), F.to_json(F.struct(*properties)), F.lit("}")]
    return df.select(F.concat(*fields).alias("value"))


def json_list(df: DataFrame, column: str, most: int = 100_000) -> DataFrame:
    """One row, ``value``: the sorted distinct values of a short column (codes of areas) as a JSON list.

    The list is one cell, so a column with more than ``most`` values raises when the result is evaluated.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    few = values.limit(most + 1).agg(F.sort_array(F.collect_list(column)).alias("values"))
    too_many = F.raise_error(F.lit(f"{column} has more than {most} values"))
    return few.select(F.to_json(F.when(F.size("values") <= most, F.col("values")).otherwise(too_many)).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, x: ColumnLike, y: ColumnLike, properties: list[str]) -> None:
    geojson_features(df, x, y, properties).write.mode("overwrite").text(path)


_COMMITS = "version string, committed_at timestamp, table string"


def publish_tables(
    spark: SparkSession, root: str, frames: dict[str, DataFrame],
    gates: Callable[[dict[str, DataFrame]], None] = lambda stored: None,
    write: Callable[[DataFrame, str, str], None] = lambda df, name, path: df.write.parquet(path),
) -> str:
    """All-or-nothing load of several tables.

    Each load goes to a folder of its own, the gates run over what was stored, and only then one
    commit record per table is appended in a single write. Readers follow the newest commit, so a
    failed load leaves the previous version in place. No rename is needed.
    """
    path = f"load-{uuid.uuid4().hex}"
    for name, df in frames.items():
        write(df, name, f"{root}/{path}/{name}")
    gates({name: spark.read.parquet(f"{root}/{path}/{name}") for name in frames})
    commit = spark.range(1).select(
        F.lit(path).alias("version"), F.current_timestamp().alias("committed_at"),
        F.explode(F.array(*[F.lit(n) for n in frames])).alias("table"),
    )
    commit.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return path


def published_paths(spark: SparkSession, root: str, names: list[str]) -> dict[str, str]:
    """Folders of the newest committed versions of several tables, from one look at the commits.

    A load that commits meanwhile is seen by none of them. Of equal commit times the larger version counts.
    """
    commits = spark.read.schema(_COMMITS).parquet(f"{root}/commits").where(F.col("table").isin(*names))
    newest = commits.groupBy("table").agg(F.max(F.struct("committed_at", "version"))["version"].alias("version"))
    versions = {row["table"]: row["version"] for row in newest.collect()}  # one row per table
    for name in names:
        if name not in versions:
            raise LookupError(f"{name} was never published under {root}")
    return {name: f"{root}/{versions[name]}/{name}" for name in names}


def published_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """The newest committed versions of several tables; see :func:`published_paths`."""
    return {name: spark.read.parquet(path) for name, path in published_paths(spark, root, names).items()}


def published_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest committed version of a table."""
    return published_tables(spark, root, [name])[name]
