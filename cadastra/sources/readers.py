"""Scans. Files are split, pruned and read in parallel by Spark; nothing loops over rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.operators.sets import unite
from cadastra.sources.inline import local_table
from cadastra.sources.schemas import DATATYPES
from cadastra.sources.staging import stage

CORRUPT = "_corrupt_record"
_FEATURE_IDS = ("ObjectId", "OBJECTID", "FID")


def read_declared_csv(spark: SparkSession, path, schema: T.StructType, **options) -> DataFrame:
    """Headed CSV files mapped to ``schema`` by position, source file in ``filename``.

    Short rows are padded with nulls; empty and header-only files add no rows.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).options(**options)
    return reader.csv(path).withColumn("filename", F.col("_metadata.file_path"))


def read_tolerant_csv(spark: SparkSession, path, schema: T.StructType, **options) -> DataFrame:
    """Bad cells become null and the raw line is kept in ``_corrupt_record`` (null for good lines).

    Spark only checks the cells a query asks for, so the rows are parsed at once, with all their
    columns, and written to the scratch folder: the flag is right whatever is selected later.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).options(**options).csv(path)
    )
    return stage(rows, "parsed")


def split_tolerant(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows of :func:`read_tolerant_csv` without the flag, and the lines that did not parse cleanly with their raw text."""
    bad = parsed.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "line")
    return parsed.drop(CORRUPT), bad


def read_subset_csv(
    spark: SparkSession, path, subset: T.StructType, file_columns: list[str], **options
) -> DataFrame:
    """Only the columns of ``subset`` from files that hold ``file_columns``; bad cells become null.

    The other columns are declared as text and never converted.
    """
    wanted = {f.name: f for f in subset}
    whole = T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in file_columns])
    reader = spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE").options(**options)
    return reader.csv(path).select(*[f"`{f.name}`" for f in subset])


def read_text_csv(spark: SparkSession, path, columns: list[str], **options) -> DataFrame:
    """Every column as text; casts follow explicitly with :func:`cast_columns`."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).options(**options).csv(path)


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast several columns; ``strict`` raises on bad text, otherwise bad text becomes null."""
    return df.withColumns(
        {c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()}
    )


def read_inferred_csv(spark: SparkSession, path, sep: str = ",", columns: list[str] | None = None) -> DataFrame:
    """Types inferred by an extra pass over the files; for small or exploratory files."""
    df = spark.read.option("header", True).option("inferSchema", True).option("sep", sep).csv(path)
    return df.select(*columns) if columns else df


def path_key(pattern: str, group: int = 1) -> Column:
    """Key found in the path of the source file, empty when the pattern does not match."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def read_by_path_key(
    reader, paths, pattern: str, keys: list[str], name: str = "path_key"
) -> DataFrame:
    """Read many files with ``reader(paths)`` and keep those whose path holds one of ``keys``.

    The filter is on file metadata alone, so Spark drops the other files before opening them.
    For large archives write a ``partitionBy`` layout instead and filter on the partition column.
    """
    found = path_key(pattern)
    return reader(paths).where(found.isin(*keys)).withColumn(name, found)


def schema_from_metadata(
    meta: DataFrame, table: str, table_col: str = "filename", name_col: str = "column", type_col: str = "datatype",
    position_col: str | None = None,
) -> T.StructType:
    """Schema of one table from a metadata frame with one row per column; those rows come to the driver."""
    rows = meta.where(F.col(table_col) == table).select(name_col, type_col, *as_list(position_col or []))
    found = rows.collect()
    if position_col:
        found = sorted(found, key=lambda row: row[position_col])
    return T.StructType([T.StructField(r[name_col], DATATYPES.get(r[type_col], T.StringType())) for r in found])


def schema_from_json(spark: SparkSession, path, table: str) -> T.StructType:
    """Schema of one table from a JSON descriptor ``{"tables": [{"url", "tableSchema": {"columns"}}]}``."""
    shape = "tables array<struct<url string, tableSchema struct<columns array<struct<name string, datatype string>>>>>"
    tables = spark.read.schema(shape).option("multiLine", True).json(path).select(F.inline("tables"))
    columns = tables.select(F.col("url"), F.posexplode("tableSchema.columns").alias("position", "c"))
    meta = columns.select(F.col("url").alias("filename"), "position", F.col("c.name").alias("column"), "c.datatype")
    return schema_from_metadata(meta, table, position_col="position")


def features_to_rows(features: DataFrame, column: str = "features", drop=_FEATURE_IDS) -> DataFrame:
    """Array of ``{attributes, geometry}`` structs to flat rows without the housekeeping ids."""
    rows = features.select(F.inline(column))
    parts = [c for c in ("attributes", "geometry") if c in rows.columns]
    flat = rows.select(*[f"{part}.*" for part in parts])
    return flat.drop(*drop)


def promote_header(
    raw: DataFrame, key: str, key_label: str, total_pattern: str | None = None, missing: str | None = "x"
) -> DataFrame:
    """Sheet read as text, with banner rows above its header, to a proper table.

    The header is the row whose ``key`` column holds ``key_label``. Banner rows (no key), the header
    itself and total rows go; the ``missing`` marker becomes null.
    """
    header = raw.where(F.col(key) == key_label).limit(1).collect()
    if not header:
        raise ValueError(f"no header row: {key_label!r} not found in {key}")
    body = raw.where(F.col(key).isNotNull() & (F.col(key) != key_label))
    if total_pattern:
        body = body.where(~F.col(key).rlike(total_pattern))
    if missing is not None:
        body = body.select(*[F.nullif(F.col(c), F.lit(missing)).alias(c) for c in body.columns])
    return body.toDF(*header[0])


def year_names(text: str, template: str = "{year}") -> dict[str, int]:
    """Names of a yearly table series from a title that holds its first and last year."""
    import re

    years = [int(y) for y in re.findall(r"\d{4}", text)]
    return {template.format(year=y): y for y in range(min(years), max(years) + 1)}


def read_series(read_one, names: dict[str, int], period: str = "year") -> DataFrame:
    """Read each named table of a series and unite them, its period as a column."""
    return unite(*[read_one(name).withColumn(period, F.lit(value)) for name, value in names.items()])


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small hand-made lookup."""
    return local_table(spark, rows, schema)


def nested_codes(spark: SparkSession, nested: dict[str, list], schema: str) -> DataFrame:
    """``{name: [code, other code]}`` to one row per name with the codes as columns."""
    return local_table(spark, [(name, *codes) for name, codes in nested.items()], schema)
