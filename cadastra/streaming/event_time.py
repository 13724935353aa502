"""Streams by the time of their events: late and repeated events, closed windows, expiring state.

A watermark is the newest event time seen minus an allowed delay. Events behind it are late and left out; it
moves between batches only, so all events of one batch are judged alike. What can no longer change is given
out once and its state is dropped: memory follows the events of the last ``delay``, not the history.

=====================  ==========================================  =======================================
Operator               State, dropped when the watermark passes    Given out
=====================  ==========================================  =======================================
:func:`first_arrivals`  one row per key; its time plus the delay   a key's first event, at once
:func:`closed_windows`  one row per window and group; window end   one row per window and group, when closed
:func:`closed_visits`   one row per key and visit; its end         the latest event of a visit, when over
=====================  ==========================================  =======================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions.cols import ColumnLike, as_list


def with_watermark(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """The stream with a watermark ``delay`` behind its event time.

    Watermarks need a moment, so a time without a zone is read in the zone of the session. Events with a null
    time never come behind a watermark and never end a window; they are left out.
    """
    return stream.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def first_arrivals(stream: DataFrame, key) -> DataFrame:
    """Every key once: repeats within the delay of the watermark are dropped, at whatever time they claim."""
    return stream.dropDuplicatesWithinWatermark(as_list(key))


def closed_windows(stream: DataFrame, time: str, width: str, aggregates: list[Column], groups=(), slide: str | None = None) -> DataFrame:
    """``window_start, window_end``, the groups and the aggregates of every window the watermark has passed."""
    windowed = stream.groupBy(F.window(F.col(time), width, slide), *as_list(groups)).agg(*aggregates)
    return windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in windowed.columns if c != "window"])


def closed_visits(stream: DataFrame, key, time: str, gap: ColumnLike, values: list[str]) -> DataFrame:
    """The latest event of every visit: events of one key less than ``gap`` apart; ties go to the larger values.

    A key's row leaves the state once its visit is over, so state holds the active keys only.
    """
    keys = as_list(key)
    latest = F.max(F.struct(time, *values)).alias("__latest")
    visits = stream.groupBy(*keys, F.session_window(F.col(time), gap).alias("__visit")).agg(latest, F.count("*").alias("n_events"))
    return visits.select(*keys, F.col("__visit.start").alias("visit_start"), F.col("__visit.end").alias("visit_end"), "n_events", "__latest.*")


def state_rows(progress: list) -> int:
    """Rows of state after the last of some batches, from the progress of a query."""
    held = [sum(operator["numRowsTotal"] for operator in batch["stateOperators"]) for batch in progress]
    return held[-1] if held else 0


def late_rows(progress: list) -> int:
    """Events left out as late in all of some batches."""
    return sum(operator["numRowsDroppedByWatermark"] for batch in progress for operator in batch["stateOperators"])
