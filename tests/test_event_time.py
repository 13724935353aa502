"""Late, repeated and expired events, against plain calculations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cadastra.streaming import event_time, incremental

SCHEMA = "id int, who string, at timestamp_ntz, v int"
START = dt.datetime(2024, 1, 1)


def event(id, who, hours, v=1):
    return id, who, None if hours is None else START + dt.timedelta(hours=hours), v


def run(spark, tmp_path, waves, build):
    """One run per wave; rows given out and progress of each."""
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "cp"))
    reports = []
    for wave in waves:
        spark.createDataFrame(wave, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
        stream = event_time.with_watermark(incremental.stream_files(spark, feed, spark.createDataFrame([], SCHEMA).schema), "at", "6 hours")
        built = build(stream)
        reports += incremental.run_to_folder(built, out, checkpoint, "append", 2)
    return spark.read.schema(built.schema).parquet(out).select(*built.columns), reports


def test_repeats_and_late_events_are_dropped_and_state_is_bounded(spark, tmp_path):
    waves = [[event(100 * w + i, "a", 10 * w + i % 10) for i in range(50)] for w in range(8)]
    for w in range(1, 8):
        waves[w] += waves[w - 1][8:12]  # repeats within the delay of the newest one, or late
        waves[w].append(event(9000 + w, "a", 10 * (w - 1) - 1))  # late by more than the delay
        waves[w].append(event(8000 + w, "a", 10 * (w - 1) + 5))  # late, within the delay
    waves[3].append(event(7000, "a", None))
    out, reports = run(spark, tmp_path, waves, lambda s: event_time.first_arrivals(s, "id"))
    ids = sorted(r["id"] for r in out.collect())
    assert ids == sorted([100 * w + i for w in range(8) for i in range(50)] + [8000 + w for w in range(1, 8)])
    assert event_time.late_rows(reports) >= 7
    assert 0 < event_time.state_rows(reports) <= 120  # of 407 keys, those of the last hours


def test_windows_are_given_out_once_when_closed(spark, tmp_path):
    waves = [
        [event(1, "a", 0), event(2, "a", 5), event(3, "b", 11)],
        [event(4, "a", 6), event(5, "b", 30), event(6, "a", 1)],  # the last one counts: its window is still open
        [event(7, "a", 2), event(8, "b", 31), event(9, "b", 60)],  # the first one is late
        [event(10, "b", 61)],
    ]
    sums = [F.count("*").alias("n"), F.sum("v").alias("v")]
    out, reports = run(spark, tmp_path, waves, lambda s: event_time.closed_windows(s, "at", "12 hours", sums, "who"))
    got = sorted((r["who"], (r["window_start"] - START).total_seconds() / 3600, r["n"]) for r in out.collect())
    assert got == [("a", 0.0, 4), ("b", 0.0, 1), ("b", 24.0, 2)]
    assert event_time.late_rows(reports) == 1 and event_time.state_rows(reports) == 1  # the window that is still open


def test_visits_expire(spark, tmp_path):
    waves = [
        [event(1, "a", 0, 1), event(2, "a", 3, 2), event(3, "b", 1, 3)],
        [event(4, "a", 9, 4), event(5, "b", 4, 5), event(6, "b", 4, 6)],
        [event(7, "c", 40, 7)],
        [event(8, "c", 80, 8)],
    ]
    out, reports = run(spark, tmp_path, waves, lambda s: event_time.closed_visits(s, "who", "at", "5 hours", ["v", "id"]))
    got = sorted((r["who"], (r["visit_start"] - START).total_seconds() / 3600, r["n_events"], r["v"]) for r in out.collect())
    assert got == [("a", 0.0, 2, 2), ("a", 9.0, 1, 4), ("b", 1.0, 3, 6), ("c", 40.0, 1, 7)]
    assert event_time.state_rows(reports) == 1  # the last visit of c; idle keys are gone
