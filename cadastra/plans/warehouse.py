"""The certificate warehouse: load, check and publish its tables, and define its views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.dates import parse_timestamp
from cadastra.functions.geo import point_text
from cadastra.operators import names
from cadastra.operators.sets import append_rows
from cadastra.plans import certificates
from cadastra.sources import gates, readers, schemas, writers

# Table -> column that must be unique in it. The 2011 area lookup has none: it is known to repeat.
UNIQUE_KEYS = {
    "domestic": "lmk_key",
    "non_domestic": "lmk_key",
    "postcodes": "pcds",
    "tenure": "lsoa21cd",
    "imd": "lsoa11cd",
    "authorities": "ladcd",
}


def read_certificates(spark: SparkSession, path, schema: T.StructType = schemas.DOMESTIC) -> DataFrame:
    """Certificate files with declared types, lower-case names and their source in ``filename``."""
    return names.lower_names(readers.read_declared_csv(spark, path, schema))


def read_certificate_files(spark: SparkSession, path) -> DataFrame:
    """The column subset used for ingest, from files with hyphenated names; the file is ``source``.

    Lodgement times that do not parse become null, so those rows lose against dated ones.
    """
    columns = schemas.hyphenated(schemas.DOMESTIC).names
    subset = readers.read_subset_csv(spark, path, schemas.DOMESTIC_SUBSET, columns)
    found = subset.withColumn("source", F.col("_metadata.file_path"))
    plain = names.swap_chars(found, {"-": "_"})
    return plain.withColumn("lodgement_datetime", parse_timestamp("lodgement_datetime", "yyyy-MM-dd HH:mm:ss"))


def read_postcodes(spark: SparkSession, path) -> DataFrame:
    """Postcode directory with its point as text."""
    directory = readers.read_declared_csv(spark, path, schemas.POSTCODES)
    return directory.withColumn("geom_text", point_text("long", "lat"))


def read_authorities(spark: SparkSession, path, extra: list[tuple] = ()) -> DataFrame:
    """Authority lookup as ladcd, ladnm, cauthcd, cauthnm, with hand-made members added."""
    raw = spark.read.schema(schemas.AUTHORITIES).option("header", True).csv(path).drop("ObjectId")
    lookup = names.strip_digit_names(raw)
    return append_rows(lookup, list(extra)) if extra else lookup


def load(spark: SparkSession, root: str, tables: dict[str, DataFrame], unique: dict[str, str] = UNIQUE_KEYS) -> list[tuple[str, str, int]]:
    """Store all tables, or none of them when a key repeats; the report of the gates.

    Tables are evaluated once; their keys are checked on the stored key columns.
    """
    return gates.publish_checked(spark, root, tables, {table: gates.Checks(unique=(key,)) for table, key in unique.items() if table in tables})


def define_views(spark: SparkSession, root: str, region: str) -> list[str]:
    """Views over the newest published tables: domestic, domestic of a region, non-domestic of a region.

    All views read the versions that are newest when they are defined. Call this again after a load.
    """
    tables = writers.published_tables(spark, root, ["domestic", "non_domestic", "postcodes", "tenure", "imd", "authorities"])
    domestic, non_domestic, postcodes, tenure, imd, authorities = tables.values()
    views = {
        "epc_domestic_vw": certificates.domestic_view(domestic, postcodes, tenure, imd),
        "epc_domestic_region_vw": certificates.domestic_view(domestic, postcodes, tenure, imd, authorities, region),
        "epc_non_domestic_region_vw": certificates.non_domestic_view(non_domestic, postcodes, authorities, region),
    }
    for name, view in views.items():
        writers.publish_view(view, name)
    return list(views)
