"""High-water-mark loads, keyed upserts, page reassembly and latest-per-key streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cadastra.functions.cols import as_list
from cadastra.functions.dates import month_after, month_before
from cadastra.operators.dedupe import last_after_sort
from cadastra.operators.sets import unite
from cadastra.sources.staging import fresh_dir, stage
from cadastra.sources.writers import conform_update, rebalanced
from cadastra.streaming import deltas


def load_window(stored: DataFrame, date: str, today: dt.date) -> DataFrame:
    """One row: first month to load (month after the newest stored date) and last (month before today)."""
    newest = F.max(F.to_date(F.col(date)))
    return stored.agg(
        month_after(newest).alias("from_month"), month_before(F.lit(today)).alias("to_month")
    )


def rows_to_load(stored: DataFrame, incoming: DataFrame, date: str, today: dt.date) -> DataFrame:
    """Incoming rows inside the load window; all complete months when nothing is stored yet."""
    window = load_window(stored, date, today)
    kind = incoming.schema[date].dataType
    # Bounds in the type of the column itself, so that files and row groups outside can be skipped.
    start = window.select(F.col("from_month").cast(kind)).scalar()
    stop = window.select(F.add_months("to_month", 1).cast(kind)).scalar()
    return incoming.where((start.isNull() | (F.col(date) >= start)) & (F.col(date) < stop))


def upsert(current: DataFrame, updates: DataFrame, key, order) -> DataFrame:
    """Updates replace current rows of the same key; new keys are added.

    ``order`` decides between several updates of one key: the last one is taken. The current table
    is only anti-joined with the update keys: while those are small it is not shuffled at all.
    """
    keys = as_list(key)
    if not as_list(order):
        raise ValueError("order must say which of several updates of a key is the last")
    newest = last_after_sort(updates, keys, order)
    replaced = newest.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return unite(current.join(replaced, same_key, "left_anti"), newest)


def upsert_partitions(
    spark: SparkSession, path: str, updates: DataFrame, key, partition: str, order
) -> None:
    """Upsert into a Parquet table partitioned by ``partition``; only touched partitions are rewritten.

    The partition column must follow from the key (a month of a date in the key), so that a key never
    moves. The touched partition values, one per partition of the batch, come to the driver and filter the
    scan of the table, so other partitions are not even listed.

    The merged rows of the touched partitions are staged, noted beside the table in ``<path>.pending``, and
    only then written over it. A run that dies while partitions are being replaced leaves the note, and the
    next run writes the staged rows again before it reads the table (:func:`finish_upsert`): no row is lost,
    and a repeated run of the same updates gives the same table. Staged rows must outlive the run, so the
    scratch folder is the shared one. Readers of a touched partition see it missing for the time of its swap.
    """
    finish_upsert(spark, path)
    updates = stage(updates, "updates")  # read three times: partitions, keys, rows
    touched = [row[0] for row in updates.select(partition).distinct().collect()]
    if not touched:
        return
    staged = fresh_dir(spark, "upsert")
    upsert(touched_rows(spark, path, updates.schema, partition, touched), updates, key, order).write.parquet(staged)
    _note_pending(spark, path, staged, partition)
    finish_upsert(spark, path)


_PENDING = "staged string, part string"


def _note_pending(spark: SparkSession, path: str, staged: str | None, part: str | None) -> None:
    note = spark.range(1 if staged else 0).select(F.lit(staged).cast("string").alias("staged"), F.lit(part).cast("string").alias("part"))
    note.coalesce(1).write.mode("overwrite").parquet(f"{path}.pending")


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Write the rows of an upsert that was staged and not confirmed; without one, nothing happens."""
    try:
        notes = spark.read.schema(_PENDING).parquet(f"{path}.pending").collect()  # one row at most
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    for note in notes:
        merged = spark.read.parquet(note["staged"])
        writer = rebalanced(merged, [note["part"]]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(note["part"]).parquet(path)
        _note_pending(spark, path, None, None)


def touched_rows(spark: SparkSession, path: str, schema: T.StructType, partition: str, values: list) -> DataFrame:
    """Rows of a partitioned table in the partitions of some values (null included)."""
    column = F.col(partition)
    wanted = column.isin(*[v for v in values if v is not None])
    if None in values:
        wanted = wanted | column.isNull()
    return spark.read.schema(schema).parquet(path).where(wanted).select(*schema.names)


def update_batch(pulls: list[DataFrame], stamp: str, schema: T.StructType | None = None) -> DataFrame:
    """Per-key pulls united, brought into register form and stamped."""
    return conform_update(unite(*pulls), stamp, schema)


def read_pages(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Pages of one result, each with its own header and some of them empty, as one table."""
    return spark.read.schema(schema).option("header", True).csv(path)


# --- streaming twins -------------------------------------------------------------------------


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """New files of a folder as a stream; the checkpoint of the query is the high-water mark."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def stream_latest(stream: DataFrame, key, order, value_columns: list[str]) -> DataFrame:
    """Latest values per key of a stream, as an aggregate with one state row per key.

    State grows with the number of distinct keys, not with the number of events.
    """
    latest = F.max_by(F.struct(*value_columns), F.struct(*as_list(order)))
    return stream.groupBy(*as_list(key)).agg(latest.alias("__row")).select(*as_list(key), "__row.*")


def run_to_folder(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "update", state_partitions: int | None = None
) -> list:
    """Process all available files; every batch goes to a folder of its own.

    A batch that is repeated after a failure overwrites its own folder, so nothing counts twice. Returns the
    progress of the batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run_batches(stream, write, checkpoint, mode, state_partitions)


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    state_partitions: int | None = None,
) -> list:
    """Run a stream over all available files, wait for it, and return the progress of its batches.

    ``state_partitions`` sets how many partitions hold the state. The number is fixed by the first
    run on a checkpoint; without it the session's shuffle partitions are taken.
    """
    conf, key = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    try:
        if state_partitions:
            conf.set(key, str(state_partitions))
        query = (
            stream.writeStream.outputMode(mode).foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        conf.set(key, before)  # a started query keeps its own copy of the settings
    query.awaitTermination()
    return query.recentProgress


def run_latest_table(latest: DataFrame, path: str, checkpoint: str, key, state_partitions: int | None = None) -> None:
    """Keep :func:`stream_latest` as a table of one row per key, whatever the number of batches.

    A batch writes its changed keys, one row each; now and then all parts are merged into one (see
    :mod:`deltas`). So the bytes written follow the batches, not the table. A repeated batch counts once. Read
    it with :func:`latest_table`.
    """
    keys = as_list(key)

    def store(batch: DataFrame, batch_id: int) -> None:
        deltas.add_batch(batch, path, batch_id, lambda parts: _newest_rows(parts, keys))

    run_batches(latest, store, checkpoint, "update", state_partitions)


def _newest_rows(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: that of its last batch, which holds the latest values the stream has seen."""
    values = [c for c in parts.columns if c not in (*keys, deltas.BATCH)]
    newest = parts.groupBy(*keys).agg(F.max_by(F.struct(*values), deltas.BATCH).alias("__row"))
    return newest.select(*keys, "__row.*")


def latest_table(spark: SparkSession, path: str, schema: T.StructType, key) -> DataFrame:
    """The table of :func:`run_latest_table` in the columns of ``schema``."""
    return _newest_rows(deltas.parts(spark, path, schema), as_list(key)).select(*schema.names)


def run_upserts(
    stream: DataFrame, path: str, checkpoint: str, key, partition: str, order
) -> None:
    """Upsert every batch of a stream into a partitioned Parquet table."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_partitions(batch.sparkSession, path, batch, key, partition, order)

    run_batches(stream, merge, checkpoint)
