"""Incremental loads: batch operators and their streaming twins must agree."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from cadastra.operators import dedupe
from cadastra.sources import writers
from cadastra.streaming import deltas, incremental

SCHEMA = "k int, day date, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def d(month, day=1, year=2024):
    return dt.date(year, month, day)


def test_load_window_rolls_over_the_year(spark):
    stored = frame(spark, (1, d(11, 30, 2023), 1), (2, d(1, 5, 2023), 1))
    row = incremental.load_window(stored, "day", d(1, 15)).first()
    assert (row.from_month, row.to_month) == (d(12, 1, 2023), d(12, 1, 2023))


def test_rows_to_load(spark, rows):
    stored = frame(spark, (1, d(2, 10), 1))
    incoming = frame(spark, (1, d(2, 28), 1), (2, d(3, 1), 1), (3, d(4, 30), 1), (4, d(5, 1), 1))
    assert rows(incremental.rows_to_load(stored, incoming, "day", d(5, 20)), "k") == [(2,), (3,)]
    assert rows(incremental.rows_to_load(stored.where("false"), incoming, "day", d(5, 20)), "k") == [(1,), (2,), (3,)]


def test_upsert_replaces_adds_and_breaks_ties(spark, rows):
    current = frame(spark, (1, d(1), 10), (2, d(1), 20), (None, d(1), 30))
    updates = frame(spark, (2, d(1), 21), (2, d(1), 22), (3, d(1), 33), (None, d(1), 31))
    got = rows(incremental.upsert(current, updates, ["k", "day"], "v"), "k", "v")
    assert got == [(1, 10), (2, 22), (3, 33), (None, 31)]


def test_upsert_partitions_touches_only_its_partitions_and_repeats_safely(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_table(frame(spark, (1, d(1), 1), (2, d(1), 2), (3, d(2), 3)), path, ["day"])
    untouched = set((tmp_path / "t" / "day=2024-02-01").iterdir())
    updates = frame(spark, (2, d(1), 20), (9, d(3), 9))
    for _ in range(2):
        incremental.upsert_partitions(spark, path, updates, ["k", "day"], "day", "v")
        assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "v") == [(1, 1), (2, 20), (3, 3), (9, 9)]
    assert set((tmp_path / "t" / "day=2024-02-01").iterdir()) == untouched


def test_streamed_upserts_equal_batch(spark, rows, tmp_path):
    path, feed, checkpoint = (str(tmp_path / n) for n in ("t", "feed", "cp"))
    base = frame(spark, *[(i, d(1 + i % 3), i) for i in range(30)])
    writers.replace_table(base, path, ["day"])
    waves = [frame(spark, (1, d(2), 100), (50, d(1), 50)), frame(spark, (1, d(2), 200), (2, d(3), 7))]
    expected = base
    for wave in waves:
        wave.coalesce(1).write.mode("append").parquet(feed)
        stream = incremental.stream_files(spark, feed, base.schema)
        incremental.run_upserts(stream, path, checkpoint, ["k", "day"], "day", "v")
        expected = incremental.upsert(expected, wave, ["k", "day"], "v")
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "day", "v") == rows(expected, "k", "day", "v")


def test_latest_per_key_stream_equals_batch(spark, rows, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "cp"))
    data = [(i % 7, d(1 + i % 12), i) for i in range(200)]
    for start in (0, 100):  # the second wave holds older and newer rows of known keys
        frame(spark, *data[start:start + 100]).repartition(3).write.mode("append").parquet(feed)
        stream = incremental.stream_files(spark, feed, frame(spark, data[0]).schema, maxFilesPerTrigger=2)
        latest = incremental.stream_latest(stream, "k", ["day", "v"], ["day", "v"])
        incremental.run_latest_table(latest, out, checkpoint, "k")
    got = rows(incremental.latest_table(spark, out, latest.schema, "k"), "k", "day", "v")
    assert got == rows(dedupe.last_after_sort(frame(spark, *data), "k", ["day", "v"]), "k", "day", "v")


def written(path) -> dict:
    return {file: file.stat().st_size for file in path.rglob("part-*.parquet") if file.parent.name != "log"}


def test_a_latest_table_writes_what_its_batches_hold(spark, tmp_path):
    """Small batches into a large table: few rows are written, and few parts are read, however many batches there are."""
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "cp"))
    spark.range(20_000).selectExpr("cast(id AS int) k", "date'2024-01-01' day", "0 v").coalesce(1).write.parquet(feed)
    schema, sizes = frame(spark, (0, d(1), 0)).schema, []
    for wave in range(12):
        if wave:
            frame(spark, *[(7 * wave + k, d(2), wave) for k in range(6)]).coalesce(1).write.mode("append").parquet(feed)
        before = written(tmp_path / "out")
        latest = incremental.stream_latest(incremental.stream_files(spark, feed, schema), "k", ["day", "v"], ["day", "v"])
        incremental.run_latest_table(latest, out, checkpoint, "k", state_partitions=2)
        sizes.append(sum(size for file, size in written(tmp_path / "out").items() if file not in before))
    assert max(sizes[3:]) < sizes[0] / 10
    table = incremental.latest_table(spark, out, latest.schema, "k")
    assert table.count() == 20_000 and sorted(r["v"] for r in table.where("v > 0").collect())[-6:] == [11] * 6
    assert table.where("k = 82").first()["v"] == 11 and table.where("k = 75").first()["v"] == 10


def test_parts_are_merged_when_they_outgrow_their_base(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    schema = frame(spark, (0, d(1), 0)).schema
    for batch in (*range(9), 8, 3):  # the last two are repeats
        part = frame(spark, *[(k, d(1), 100 * batch + k) for k in range(batch % 3, 4)])
        deltas.add_batch(part, root, batch, lambda parts: incremental._newest_rows(parts, ["k"]))
    assert rows(incremental._newest_rows(deltas.parts(spark, root, schema), ["k"]), "k", "v") == [(0, 600), (1, 701), (2, 802), (3, 803)]
    assert len(deltas._log(spark, root)) <= 4 and deltas.is_stored(spark, root, 2) and not deltas.is_stored(spark, root, 9)
    assert deltas.parts(spark, str(tmp_path / "none"), schema).count() == 0


def test_a_batch_that_died_is_not_read(spark, rows, tmp_path, monkeypatch):
    """Written without a log entry: it does not count, and the repeated batch writes it again."""
    root, schema = str(tmp_path / "t"), frame(spark, (0, d(1), 0)).schema
    merge = lambda parts: incremental._newest_rows(parts, ["k"])
    deltas.add_batch(frame(spark, (1, d(1), 1)), root, 0, merge)
    frame(spark, (1, d(1), 99), (5, d(1), 99)).write.parquet(f"{root}/batch=1")
    assert rows(merge(deltas.parts(spark, root, schema)), "k", "v") == [(1, 1)]
    deltas.add_batch(frame(spark, (1, d(1), 2)), root, 1, merge)
    assert rows(merge(deltas.parts(spark, root, schema)), "k", "v") == [(1, 2)]


def test_an_upsert_that_died_between_two_partitions_is_finished(spark, rows, tmp_path, monkeypatch):
    """A touched partition is deleted and its replacement never written: nothing is lost."""
    path = str(tmp_path / "t")
    writers.replace_table(frame(spark, (1, d(1), 1), (2, d(1), 2), (3, d(2), 3), (4, d(3), 4)), path, ["day"])
    updates = frame(spark, (2, d(1), 20), (9, d(2), 9))

    def die(*_):
        shutil.rmtree(tmp_path / "t" / "day=2024-01-01")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "rebalanced", die)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.upsert_partitions(spark, path, updates, ["k", "day"], "day", "v")
    assert not (tmp_path / "t" / "day=2024-01-01").exists()
    incremental.upsert_partitions(spark, path, updates, ["k", "day"], "day", "v")
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "v") == [(1, 1), (2, 20), (3, 3), (4, 4), (9, 9)]
    # Also by a later upsert of other keys, which would otherwise go on from the damaged table.
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "rebalanced", die)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.upsert_partitions(spark, path, frame(spark, (1, d(1), 10)), ["k", "day"], "day", "v")
    incremental.upsert_partitions(spark, path, frame(spark, (2, d(1), 21)), ["k", "day"], "day", "v")
    assert rows(spark.read.schema(SCHEMA).parquet(path), "k", "v") == [(1, 10), (2, 21), (3, 3), (4, 4), (9, 9)]


def test_one_key_twice_in_a_batch(spark, rows):
    current, updates = frame(spark, (1, d(1), 1), (2, d(1), 5)), frame(spark, (1, d(1), 8), (1, d(1), 7))
    assert rows(incremental.upsert(current, updates, "k", "v"), "k", "v") == [(1, 8), (2, 5)]
    with pytest.raises(ValueError, match="order"):
        incremental.upsert(current, updates, "k", ())


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "table")
    frame(spark, (1, d(1), 1), (2, d(2), 2)).write.partitionBy("day").parquet(path)
    found = incremental.touched_rows(spark, path, frame(spark, (1, d(1), 1)).schema, "day", [d(2)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-02-01" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert len(found.inputFiles()) <= 2 and found.count() == 1
    with_null = incremental.touched_rows(spark, path, frame(spark, (1, d(1), 1)).schema, "day", [None])
    assert with_null.count() == 0


def test_a_checkpoint_is_the_high_water_mark(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "cp"))
    for wave in range(3):
        frame(spark, (wave, d(1), wave)).write.mode("append").parquet(feed)
        incremental.run_to_folder(incremental.stream_files(spark, feed, frame(spark, (0, d(1), 0)).schema), out, checkpoint, "append")
        assert spark.read.parquet(out).count() == wave + 1


def test_pages_with_repeated_headers_and_empty_pages(spark, rows, tmp_path):
    pages = {"a": "k,day,v\n1,2024-01-01,1\n", "b": "k,day,v\n", "c": "", "d": "k,day,v\n2,2024-01-02,2\n"}
    for name, body in pages.items():
        (tmp_path / f"{name}.csv").write_text(body)
    schema = frame(spark, (0, d(1), 0)).schema
    assert rows(incremental.read_pages(spark, str(tmp_path), schema), "k", "v") == [(1, 1), (2, 2)]
    assert incremental.read_pages(spark, str(tmp_path / "b.csv"), schema).count() == 0


def test_update_batch(spark):
    pull = spark.createDataFrame([(1, F.lit("x") is not None)], "`lmk-key` int, `a-b` boolean")
    batch = incremental.update_batch([pull, pull], "2024/02/01 00:00:00")
    assert batch.columns == ["LMK_KEY", "A_B", "filename"] and batch.count() == 2
