"""The warehouse for users of SQL: functions and views that live in the catalog, not in a session.

Published tables become external catalog tables. Views and functions are defined over those once; a later
load moves the tables to its folders (:func:`register_tables`), and new sessions see the new rows through the
same views. A session that has read a table before keeps its files until it refreshes it (:func:`refresh`).
Tables move one after another, so a query that starts meanwhile may meet two loads; the frames of
:func:`writers.published_tables` never do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cadastra.sources import writers

#: name -> (parameters, type of the result, body). The rules are those of the functions named behind.
FUNCTIONS = {
    # functions.bands.year_by_range
    "nominal_year": ("band STRING", "INT", r"""
        CASE WHEN regexp_replace(band, '[A-Za-z:!\\s]', '') = '' THEN NULL
            WHEN contains(lower(band), 'before') THEN 1899
            WHEN contains(band, '-') THEN CAST(rint((
                try_cast(split_part(regexp_replace(band, '[A-Za-z:!\\s]', ''), '-', 1) AS INT)
                + try_cast(split_part(regexp_replace(band, '[A-Za-z:!\\s]', ''), '-', 2) AS INT)) / 2) AS INT)
            ELSE try_cast(regexp_replace(band, '[A-Za-z:!\\s]', '') AS INT) END"""),
    # functions.bands.epoch
    "construction_epoch": ("year INT", "STRING", """
        CASE WHEN year < 1900 THEN 'Before 1900' WHEN year <= 1930 THEN '1900 - 1930' WHEN year > 1930 THEN '1930 to present' ELSE 'Unknown' END"""),
    # functions.domain.tenure
    "standard_tenure": ("tenure STRING", "STRING", """
        CASE WHEN contains(tenure, 'wner') THEN 'Owner occupied' WHEN contains(tenure, 'rivate') THEN 'Private rented'
            WHEN contains(tenure, 'ocial') THEN 'Social rented' ELSE 'Unknown' END"""),
}

TABLES = ("domestic", "postcodes", "tenure", "imd", "authorities")

#: Latest certificates per property with geography, tenure, deprivation, year, epoch and date parts.
_DOMESTIC_VIEW = """
WITH newest AS (SELECT uprn, max(lodgement_datetime) AS lodgement_datetime FROM {db}.domestic GROUP BY uprn
), latest AS (SELECT c.* FROM {db}.domestic c LEFT SEMI JOIN newest n ON c.uprn = n.uprn AND c.lodgement_datetime = n.lodgement_datetime
), geography AS (
  SELECT p.*, t.* EXCEPT (lsoa21cd), i.* EXCEPT (lsoa11cd)
  FROM {db}.postcodes p LEFT JOIN {db}.tenure t ON p.lsoa21 = t.lsoa21cd LEFT JOIN {db}.imd i ON p.lsoa11 = i.lsoa11cd
)
SELECT c.*, g.*, a.ladnm, a.cauthnm, {db}.nominal_year(c.construction_age_band) AS nominal_construction_year,
  {db}.construction_epoch({db}.nominal_year(c.construction_age_band)) AS construction_epoch,
  day(c.lodgement_datetime) AS lodgement_day, month(c.lodgement_datetime) AS lodgement_month, year(c.lodgement_datetime) AS lodgement_year
FROM latest c LEFT JOIN geography g ON c.postcode = g.pcds LEFT JOIN {db}.authorities a ON c.local_authority = a.ladcd
"""


def define_functions(spark: SparkSession, database: str) -> None:
    """Create or replace the SQL functions of :data:`FUNCTIONS` in a database; other sessions can use them."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"DROP FUNCTION IF EXISTS {database}.{name}")
        spark.sql(f"CREATE FUNCTION {database}.{name}({parameters}) RETURNS {result} RETURN {body}")


def register_tables(spark: SparkSession, root: str, database: str, names: tuple[str, ...] = TABLES) -> None:
    """Point the catalog tables at the newest published versions, all from one look at the commits.

    A load must keep the columns of the tables: views are bound to them.
    """
    for name, path in writers.published_paths(spark, root, list(names)).items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{path}'")
        else:
            spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}'")
    refresh(spark, database, names)


def refresh(spark: SparkSession, database: str, names: tuple[str, ...] = TABLES) -> None:
    """Let a session that has read the tables before see where they lie now."""
    for name in names:
        spark.catalog.refreshTable(f"{database}.{name}")


def define_views(spark: SparkSession, database: str) -> None:
    """Create or replace the lasting views over the tables and functions of a database."""
    spark.sql(f"CREATE OR REPLACE VIEW {database}.epc_domestic_vw AS {_DOMESTIC_VIEW.format(db=database)}")


def publish(spark: SparkSession, root: str, database: str) -> None:
    """Database, tables, functions and views over what is published below ``root``; call it after every load."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    register_tables(spark, root, database)
    define_functions(spark, database)
    define_views(spark, database)
