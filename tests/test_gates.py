"""Gates checked while tables are written: how often frames are read, what a refusal leaves behind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.operators import filters, quality
from cadastra.sources import gates, writers

CHECKS = {
    "child": gates.Checks({"v is positive": "v > 0"}, ("id", ["p", "id"]), {"parent": {"p": "k"}}, least_rows=2),
    "parent": gates.Checks(unique=("k",)),
}


def counted(spark, rows, schema):
    """A frame that counts how many of its rows are read."""
    reads = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    return spark.createDataFrame(rows, schema).mapInArrow(pass_on, schema), reads


def test_a_load_reads_its_frames_once(spark, tmp_path):
    child, reads = counted(spark, [(i, i % 3, 1) for i in range(30)] + [(None, None, 1)], "id int, p int, v int")
    parent = spark.createDataFrame([(0,), (1,), (2,), (None,), (None,)], "k int")
    report = gates.publish_checked(spark, str(tmp_path), {"child": child, "parent": parent}, CHECKS)
    assert reads.value == 31
    assert [r[:2] for r in report] == [
        ("child", "at least 2 rows"), ("child", "v is positive"), ("child", "id is unique"), ("child", "p+id is unique"),
        ("child", "p is in parent"), ("parent", "k is unique"),
    ] and {r[2] for r in report} == {0}
    assert writers.published_table(spark, str(tmp_path), "child").count() == 31


def test_a_refused_load_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, 0, 5), (2, 0, 5)], "id int, p int, v int")
    parent = spark.createDataFrame([(0,)], "k int")
    gates.publish_checked(spark, root, {"child": one, "parent": parent}, CHECKS)
    bad = spark.createDataFrame([(1, 0, -5), (1, 7, None), (1, 7, 3)], "id int, p int, v int")
    with pytest.raises(quality.GateError, match="v is positive") as refused:
        gates.publish_checked(spark, root, {"child": bad, "parent": parent.unionAll(parent)}, CHECKS)
    assert {(t, g): n for t, g, n in refused.value.report if n} == {
        ("child", "v is positive"): 2, ("child", "id is unique"): 2, ("child", "p+id is unique"): 1, ("child", "p is in parent"): 1, ("parent", "k is unique"): 1,
    }
    assert writers.published_table(spark, root, "child").count() == 2
    empty = {"child": one.limit(0), "parent": parent.limit(0)}
    with pytest.raises(quality.GateError, match="at least 2 rows"):
        gates.publish_checked(spark, root, empty, CHECKS)
    with pytest.raises(KeyError, match="parent"):
        gates.publish_checked(spark, root, {"child": one}, {"child": CHECKS["child"]})


def test_tables_of_one_look_are_of_one_load(spark, tmp_path, monkeypatch):
    """A load that commits while tables are looked up is seen by all of them or by none."""
    root = str(tmp_path)
    frames = lambda n: {name: spark.range(n) for name in "abc"}
    writers.publish_tables(spark, root, frames(1))
    readers, looks = type(spark.read), []
    plain = readers.parquet

    def parquet(self, path, *more, **options):
        found = plain(self, path, *more, **options)
        looks.append(path)
        if len(looks) == 1:  # right after the commits were opened, and again between two tables
            found = spark.createDataFrame(found.collect(), found.schema)
        if len(looks) <= 2:
            monkeypatch.setattr(readers, "parquet", plain)
            writers.publish_tables(spark, root, frames(len(looks) + 1))
            monkeypatch.setattr(readers, "parquet", parquet)
        return found

    monkeypatch.setattr(readers, "parquet", parquet)
    sizes = {df.count() for df in writers.published_tables(spark, root, list("abc")).values()}
    assert sizes == {1}
    monkeypatch.setattr(readers, "parquet", plain)
    assert {df.count() for df in writers.published_tables(spark, root, list("abc")).values()} == {3}
    with pytest.raises(LookupError, match="zzz"):
        writers.published_tables(spark, root, ["a", "zzz"])


def test_json_list_is_bounded(spark):
    codes = spark.range(5).selectExpr("cast(id as string) code")
    assert writers.json_list(codes, "code", most=5).first()["value"] == '["0","1","2","3","4"]'
    with pytest.raises(Exception, match="more than 4 values"):
        writers.json_list(codes, "code", most=4).collect()
    assert writers.json_list(codes.limit(0), "code").first()["value"] == "[]"


def test_samples_equal_a_full_sort(spark, rows):
    frame = spark.range(3000).selectExpr("id AS k", "cast(CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 400 = 1 THEN 'rare' ELSE concat('a', id % 7) END AS string) area", "id * 2 AS v")
    drawn = F.md5(F.concat(F.lit("5:"), F.col("k").cast("string")))
    for n in (0, 1, 7, 500, 2999, 3000, 5000):
        assert rows(filters.sample_rows(frame, "k", n, 5)) == rows(frame.orderBy(drawn, "k").limit(n))
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("area").orderBy(drawn, "k"))
    for n in (1, 5, 300, 2000):
        assert rows(filters.sample_rows_per_area(frame, "area", "k", n, 5)) == rows(frame.withColumn("p", place).where(F.col("p") <= n).drop("p"))
    with_null = frame.unionAll(spark.createDataFrame([(None, "hot", 1)], "k long, area string, v long"))
    assert filters.sample_rows(with_null, "k", 3001).count() == 3001 and filters.sample_rows(frame.limit(0), "k", 3).count() == 0


def test_a_sample_gathers_no_rows_in_one_task(spark):
    frame = spark.range(100_000).selectExpr("id AS k", "repeat('x', 50) AS wide").repartition(8)
    plan = filters.sample_rows(frame, "k", 40_000)._jdf.queryExecution().executedPlan().toString()
    outer = plan.split("Subquery")[0]
    assert "TakeOrdered" not in outer and "GlobalLimit" not in outer and "SinglePartition" not in outer
