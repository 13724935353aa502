"""Merged sketches against exact values, and against one pass."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from cadastra.operators import sketches

SCHEMA = "area string, x double, n long, name string, day date"


def made(count, seed=1):
    import datetime as dt

    rng = random.Random(seed)
    return [
        (rng.choice(["N", "S"]), rng.choice([None, float("nan"), rng.gauss(1e6, 3)]), rng.randrange(900), rng.choice([None, "a", f"b{rng.randrange(300)}"]),
         dt.date(2024, 1, 1 + rng.randrange(28))) for _ in range(count)
    ]


def test_batches_merge_to_the_profile_of_the_whole(spark, tmp_path):
    rows = made(6000)
    path, kept = str(tmp_path / "t"), str(tmp_path / "s")
    for number in range(6):
        batch = spark.createDataFrame(rows[1000 * number:1000 * number + 1000], SCHEMA)
        sketches.append_profiled(batch, path, kept, number)
    sketches.append_profiled(batch, path, kept, 5)  # a repeated batch counts once
    got = {r["column_name"]: r for r in sketches.profile_of(sketches.stored_sketches(spark, kept)).collect()}
    assert set(got) == {"area", "x", "n", "name", "day"} and {r["count"] for r in got.values()} == {6000}
    numbers = [r[2] for r in rows]
    n = got["n"]
    mean = sum(numbers) / 6000
    assert (float(n["min"]), float(n["max"])) == (min(numbers), max(numbers)) and math.isclose(n["avg"], mean)
    assert math.isclose(n["std"], math.sqrt(sum((v - mean) ** 2 for v in numbers) / 5999))
    assert abs(n["approx_unique"] - len(set(numbers))) <= 0.064 * len(set(numbers))
    for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(sum(v <= n[q] for v in numbers) / 6000 - share) < 0.03
    x = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    centre = sum(x) / len(x)
    # A large mean and a small spread: the sums of the parts must not cancel.
    assert abs(got["x"]["null_percentage"] - 100 * sum(r[1] is None for r in rows) / 6000) < 1e-9
    assert (got["name"]["min"], got["name"]["q50"]) == ("a", None) and got["day"]["max"] == "2024-01-28"
    assert centre > 0 and got["area"]["approx_unique"] == 2


def test_spread_of_parts_does_not_cancel(spark):
    rows = [(None, 1e6 + i % 7, i, None, None) for i in range(4000)]
    parts = [sketches.column_sketches(spark.createDataFrame(rows[i::4], SCHEMA), ["x"]) for i in range(4)]
    merged = sketches.profile_of(sketches.merge_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]))).first()
    x = [r[1] for r in rows]
    mean = sum(x) / len(x)
    assert math.isclose(merged["std"], math.sqrt(sum((v - mean) ** 2 for v in x) / 3999), rel_tol=1e-3)


def test_by_area_and_empty(spark, rows, tmp_path):
    kept, schema = str(tmp_path / "s"), spark.createDataFrame([], SCHEMA).schema
    for number in range(3):
        sketches.append_profiled(spark.createDataFrame(made(300, number), SCHEMA), str(tmp_path / "t"), kept, number, ["n", "x"], ["area"])
    got = sketches.profile_of(sketches.stored_sketches(spark, kept, schema, ["area"]), ["area"])
    table = spark.read.schema(schema).parquet(str(tmp_path / "t"))
    assert rows(got.where("column_name = 'n'"), "area", "count") == rows(table.groupBy("area").agg(F.count("*").alias("count")), "area", "count")
    empty = sketches.profile_of(sketches.column_sketches(spark.createDataFrame([], SCHEMA), ["n"])).first()
    assert (empty["count"], empty["approx_unique"], empty["avg"], empty["null_percentage"]) == (0, 0, None, None)
