"""What must hold when one key has a third of all rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cadastra.operators import dedupe, joins, names, windows
from cadastra.operators.joins import Lookup
from cadastra.session import SETTINGS, tune


@pytest.fixture
def small_shuffles(spark):
    """Thresholds scaled down, so that adaptive execution sees the test's hot key as it would a large one."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows=200_000):
    """A third of the rows share key 0; the payload keeps them from shrinking."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(0, rows, 1, 8).select("id", key.alias("k"), (F.col("id") % 11).alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("x"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()  # compiles its own plan
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_enrichment_splits_a_hot_key(small_shuffles):
    spark = small_shuffles
    lookup = spark.range(5000).select(F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    joined = joins.enrich(hot(spark), Lookup(lookup, {"k": "key"}, ["name"]))
    assert "skew=true" in final_plan(joined)
    # also when an aggregate on the same key follows
    assert "skew=true" in final_plan(joined.groupBy("k").agg(F.max("name").alias("name"), F.max("x").alias("x")))


def test_left_join_to_many_rows_per_key_splits_the_hot_key(small_shuffles):
    spark = small_shuffles
    few = spark.range(6000).select(F.col("id").alias("key"))
    many = hot(spark).where("k <> 1")
    joined = joins.enrich(few, Lookup(many, {"key": "k"}, ["id", "x"], many=True))
    assert "skew=true" in final_plan(joined)
    plain = joins.enrich(few, Lookup(many, {"key": "k"}, ["id", "x"]))
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0


def test_key_lists_shrink_before_the_shuffle(small_shuffles):
    spark = small_shuffles
    few = spark.range(6000).select(F.col("id").alias("key"))
    for half_join in (joins.keep_listed, joins.drop_listed):
        plan = half_join(few, hot(spark), {"key": "k"})._jdf.queryExecution().executedPlan().toString()
        right = plan.rsplit("Exchange hashpartitioning", 1)[1]
        assert "HashAggregate(keys=[__key_0" in right


def test_ties_of_a_hot_key_do_not_share_one_partition(small_shuffles):
    spark = small_shuffles
    data = hot(spark)
    by_key_and_date = dedupe.latest_with_ties(data, "k", "t")
    plan = by_key_and_date._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "t#" in plan.split("LeftSemi")[0]
    assert by_key_and_date.count() == data.join(data.groupBy("k").agg(F.max("t").alias("t")), ["k", "t"]).count()


@pytest.mark.parametrize("operator", [
    lambda d: dedupe.latest_row(d, "k", "t", "id"), lambda d: dedupe.last_after_sort(d, "k", ["t", "id"]),
    lambda d: dedupe.drop_repeated_keys(d, "k"), lambda d: dedupe.first_per_subset(d, "k", "id"),
])
def test_one_row_operators_shrink_before_the_shuffle(spark, operator):
    """Below the exchange there is a partial aggregate or a partial group limit."""
    plan = operator(hot(spark, 1000))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning", 1)[1]
    assert "partial_" in below or "Partial" in below


def test_small_groups_of_a_hot_key_reach_the_shuffle_small(spark):
    """Rows written to the shuffle are bounded by tasks x keys, not by the table."""
    data = hot(spark, 60_000).where("k = 0")
    out = dedupe.last_after_sort(data, "k", ["t", "id"])
    out.collect()
    assert out.count() == 1 and out.first().id == data.where("t = 10").agg(F.max("id")).first()[0]


@pytest.mark.parametrize("settings", [
    {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
    {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
     "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"},
])
def test_numbers_and_ranks_run_on_across_partitions(small_shuffles, settings):
    """Several range partitions, all of them or merged in part."""
    spark = small_shuffles
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        data = spark.range(0, 40_000, 1, 5).select((F.col("id") * 7919 % 40_009).alias("v"), (F.col("id") % 500).alias("w"))
        numbered = windows.row_numbers(data, ["w", "v"], "n").collect()
        ranked = windows.rank_of_values(data.where("w < 400 OR v < 20000"), "w").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    order = sorted((r.w, r.v) for r in numbered)
    assert [(r.w, r.v) for r in sorted(numbered, key=lambda r: r.n)] == order
    assert sorted(r.n for r in numbered) == list(range(1, 40_001))
    counts, below, expected = Counter(r.w for r in ranked), 0, {}
    for w in sorted(counts):
        expected[w] = below + (counts[w] + 1) / 2
        below += counts[w]
    assert {r.w: r.rank for r in ranked} == expected


def test_settings_and_shuffle_size(spark):
    tune(spark, shuffle_bytes=10 * 1024**4)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(spark.conf.get(key)) == 40960
    spark.conf.unset(key)
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())


def test_operators_chain_with_transform(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "K int, T int, V string")
    out = df.transform(names.lower_names).transform(dedupe.latest_row, "k", "t", "v").transform(
        lambda d: joins.keep_listed(d, d.select(F.col("k").alias("key")), {"k": "key"}))
    assert [tuple(r) for r in out.collect()] == [(1, 2, "b")]
