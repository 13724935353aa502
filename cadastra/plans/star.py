"""The certificate star on bucketed tables: latest certificates and their geography without a shuffle.

Tables are written bucketed and sorted once per load. Certificates are bucketed by property, so the latest
of each property is found bucket by bucket; the result is written bucketed by postcode, as is the directory,
so the view joins bucket with bucket. A bucket is one task: this is for keys that are many and even, such as
properties and postcodes. For a table in which one key may hold a large share, take
:func:`certificates.domestic_view`, whose shuffles are split at hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cadastra.operators import joins
from cadastra.operators.joins import Lookup
from cadastra.plans import certificates
from cadastra.sources import writers

#: What a task should read of a bucket.
BUCKET_BYTES = 256 * 1024**2


def bucket_count(table_bytes: int) -> int:
    """Buckets of about :data:`BUCKET_BYTES`, a power of two, so that tables of different size still fit each other."""
    return 1 << (max(1, -(-table_bytes // BUCKET_BYTES)) - 1).bit_length()


def latest_in_buckets(certs: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows at the latest ``ts`` of their key, ties kept, for a table bucketed by ``key``.

    Joined on the key alone, the date compared afterwards: with the date among the join keys Spark would
    shuffle by both.
    """
    newest = certs.groupBy(F.col(key).alias("__key")).agg(F.max(ts).alias("__newest"))
    joined = certs.join(newest, (F.col(key) == F.col("__key")) & (F.col(ts) >= F.col("__newest")))
    return joined.select(*certs.columns)


def store_star(
    spark: SparkSession, prefix: str, path: str, certs: DataFrame, postcodes: DataFrame, tenure: DataFrame, imd: DataFrame,
    buckets: int, postcode_columns: list[str] = certificates.POSTCODE_COLUMNS,
) -> None:
    """Write ``<prefix>_certificates``, ``<prefix>_latest`` and ``<prefix>_directory`` as bucketed catalog tables below ``path``."""
    by_property = writers.replace_bucketed_table(certs, f"{prefix}_certificates", f"{path}/certificates", "uprn", buckets)
    latest = latest_in_buckets(by_property, "uprn", "lodgement_datetime")
    writers.replace_bucketed_table(latest, f"{prefix}_latest", f"{path}/latest", "postcode", buckets)
    directory = certificates.directory(postcodes.select(*postcode_columns), tenure, imd)
    writers.replace_bucketed_table(directory, f"{prefix}_directory", f"{path}/directory", "pcds", buckets)


def star_view(spark: SparkSession, prefix: str, authorities: DataFrame, region: str | None = None) -> DataFrame:
    """:func:`certificates.domestic_view` from the stored star: facts and directory are joined where they lie."""
    latest, directory = spark.table(f"{prefix}_latest"), spark.table(f"{prefix}_directory")
    if region is not None:
        latest = certificates.in_region(latest, authorities, region)
    return certificates.with_derived(joins.enrich(
        latest,
        Lookup(directory, {"postcode": "pcds"}, directory.columns, prefix="pc"),
        Lookup(authorities, {"local_authority": "ladcd"}, ["ladnm", "cauthnm", "ladcd"], prefix="la"),
    ))
