"""Tables that grow by small batches: a base, the batches since, and a log that says which of them count.

A batch is written to a folder of its own and counts once its number stands in the log, so a batch that
failed half-way is never read and a repeated one counts once. When the batches since the last base hold as
many rows as the base, both are merged into a new base. So what is written follows the batches, over time at
most a few times their size, and what is read is at most about twice the merged table.

How rows of several batches combine is up to the owner of the table, see :mod:`retract` (sums add up) and
:func:`incremental.latest_table` (the latest row of a key counts).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from cadastra.sources.inline import local_table

_LOG = "batch bigint, is_base boolean, n_rows bigint"
#: Number of the batch a row came with.
BATCH = "__batch"


def _log(spark: SparkSession, root: str) -> list:
    """Entries from the newest base on, in the order of batches: bounded by the batches between two bases."""
    try:
        entries = spark.read.schema(_LOG).parquet(f"{root}/log").distinct()
        newest = entries.where("is_base").agg(F.max("batch").alias("b")).first()["b"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if newest is not None:
        entries = entries.where((F.col("batch") > newest) | ((F.col("batch") == newest) & F.col("is_base")))
    return sorted(entries.collect())


def _store(df: DataFrame, root: str, batch: int, is_base: bool) -> None:
    """Write one part, then its log entry; the number of its rows comes from the write itself."""
    counted = Observation()
    rows = df.drop(BATCH).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("overwrite").parquet(_part(root, batch, is_base))
    n = counted.get["n"]
    local_table(df.sparkSession, [(batch, is_base, n)], _LOG).coalesce(1).write.mode("append").parquet(f"{root}/log")


def _part(root: str, batch: int, is_base: bool) -> str:
    return f"{root}/{'base' if is_base else 'batch'}={batch}"


def is_stored(spark: SparkSession, root: str, batch: int) -> bool:
    """Whether a batch counts already, on its own or within a base."""
    return any(entry["batch"] == batch or entry["is_base"] and entry["batch"] > batch for entry in _log(spark, root))


def add_batch(df: DataFrame, root: str, batch: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Store a batch under its number, unless it is stored already; numbers grow from batch to batch.

    ``merge`` brings the rows of several parts, told apart by :data:`BATCH`, down to one part.
    """
    spark = df.sparkSession
    if is_stored(spark, root, batch):
        return
    _store(df, root, batch, False)
    entries = _log(spark, root)
    base = sum(entry["n_rows"] for entry in entries if entry["is_base"])
    since = [entry["n_rows"] for entry in entries if not entry["is_base"]]
    if len(since) > 1 and sum(since) >= base:
        _store(merge(parts(spark, root, df.drop(BATCH).schema)), root, batch, True)


def parts(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of the base and of all batches since, with their batch number in :data:`BATCH`."""
    found = [
        spark.read.schema(schema).parquet(_part(root, entry["batch"], entry["is_base"])).withColumn(BATCH, F.lit(entry["batch"]).cast("long"))
        for entry in _log(spark, root)
    ]
    if not found:
        return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(0).cast("long"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out
