"""Sums kept by changes against sums over the whole register."""

from __future__ import annotations

import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from cadastra.operators import aggs
from cadastra.streaming import deltas, incremental, retract

SCHEMA = "k int, part int, area string, d_a int, d_b int, n_x double, stamp int"
SPEC = retract.Sums(("area",), ("d_a", "d_b"), ("n_x",))


def made(rng, keys, stamp):
    return [
        (k, k % 5, rng.choice(["N", "S", "W", None]), rng.choice([0, 1, None]), rng.randrange(2), rng.choice([None, 0.1, 0.2, rng.random() * 99]), stamp) for k in keys
    ]


def whole(spark, path):
    register = spark.read.schema(SCHEMA).parquet(path)
    return aggs.flag_profile(register, "area", ["d_a", "d_b"], ["n_x"])


def start(spark, tmp_path, rows):
    register, sums = str(tmp_path / "register"), str(tmp_path / "sums")
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.write.partitionBy("part").parquet(register)
    retract.start_profile(frame, sums, SPEC)
    return register, sums, frame.schema


def refresh(spark, register, sums, rows, batch):
    retract.refresh(spark, register, sums, spark.createDataFrame(rows, SCHEMA), "k", "part", "stamp", SPEC, batch)


def kept(spark, sums, schema):
    return retract.profile(retract.stored_sums(spark, sums, schema, SPEC), SPEC)


def test_batches_equal_a_full_aggregate(spark, rows, tmp_path):
    rng = random.Random(4)
    register, sums, schema = start(spark, tmp_path, made(rng, range(60), 0))
    for batch in range(1, 6):
        keys = [rng.randrange(80) for _ in range(25)]  # known and new keys, some twice
        refresh(spark, register, sums, [r[:-1] + (10 * batch + i,) for i, r in enumerate(made(rng, keys, 0))], batch)
        got, want = rows(kept(spark, sums, schema)), rows(whole(spark, register))
        assert got == want and kept(spark, sums, schema).columns == whole(spark, register).columns


def test_nothing_is_left_of_what_is_taken_out(spark, tmp_path):
    """Floats would leave a residue; a group without rows disappears."""
    register, sums, schema = start(spark, tmp_path, [(k, k % 5, "N", 1, 0, 0.1 * k, 0) for k in range(10)] + [(99, 4, "S", 0, 0, float("nan"), 0)])
    refresh(spark, register, sums, [(k, k % 5, "S", None, 1, 0.7, 1) for k in range(10)], 1)
    stored = retract.stored_sums(spark, sums, schema, SPEC).collect()
    assert [(r["area"], r["n_rows"], r["d_a__set"], r["n_x__n"], float(r["n_x__sum"])) for r in stored] == [("S", 11, 0, 10, 7.0)]


def test_only_touched_partitions_are_read(spark, tmp_path):
    register, sums, schema = start(spark, tmp_path, made(random.Random(1), range(50), 0))
    updates = spark.createDataFrame(made(random.Random(2), [3, 8, 103], 1), SCHEMA)
    added = retract.batch_sums(spark, register, schema, updates, "k", "part", "stamp", SPEC)
    scans = [line for line in added._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*part#\d+ = 3\)", line) for line in scans)
    assert added.count() <= 4


@pytest.mark.parametrize("dies_in", ["deltas", "register"])
def test_a_batch_that_died_is_repaired_by_running_it_again(spark, rows, tmp_path, monkeypatch, dies_in):
    rng = random.Random(9)
    register, sums, schema = start(spark, tmp_path, made(rng, range(30), 0))
    batch = made(rng, range(20, 40), 1)

    def die(*_, **__):
        if dies_in == "register":
            shutil.rmtree(tmp_path / "register" / "part=1")
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if dies_in == "register":
            patch.setattr(incremental, "rebalanced", die)
        else:
            patch.setattr(deltas, "local_table", die)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(spark, register, sums, batch, 1)
    for _ in range(2):  # once more after it is through: it counts once
        refresh(spark, register, sums, batch, 1)
        assert rows(kept(spark, sums, schema)) == rows(whole(spark, register))
    assert spark.read.parquet(register).agg(F.countDistinct("k"), F.count("*")).first() == (40, 40)


def test_empty_register_and_batch(spark, rows, tmp_path):
    register, sums, schema = start(spark, tmp_path, [])
    refresh(spark, register, sums, [], 1)
    assert rows(kept(spark, sums, schema)) == []
    refresh(spark, register, sums, made(random.Random(3), range(4), 1), 2)
    assert rows(kept(spark, sums, schema)) == rows(whole(spark, register))
