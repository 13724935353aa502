"""Windows, joins, sets, aggregates and quality gates on small frames."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadastra.operators import aggs, filters, joins, names, quality, sets, windows
from cadastra.operators.joins import Lookup


def test_row_numbers_are_consecutive_over_all_partitions(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = {r.v: r.n for r in windows.row_numbers(df, "v", "n").collect()}
    assert got == {v: v + 1 for v in values}
    descending = {r.v: r.n for r in windows.row_numbers(df, F.desc("v"), "n").collect()}
    assert descending == {v: 1000 - v for v in values}
    assert windows.row_numbers(df.where("false"), "v").count() == 0


def test_batch_numbers(spark):
    df = spark.createDataFrame([(v % 250,) for v in range(600)] + [(None,)], "v int")
    got = {r.v: r.batch for r in windows.batch_numbers(df, "v", 100).collect()}
    assert got == {v: v // 100 for v in range(250)}


def test_rank_of_values_averages_ties(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 3.0), ("n", None)], "k string, v double")
    assert rows(windows.rank_of_values(df, "v"), "k", "rank") == [("a", 1.5), ("b", 1.5), ("c", 3.0), ("n", None)]


def test_rank_of_values_with_a_value_in_a_third_of_rows(spark):
    rng = random.Random(3)
    values = [5 if i % 3 == 0 else rng.randrange(400) for i in range(900)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    expected = {v: sum(x < v for x in values) + (values.count(v) + 1) / 2 for v in set(values)}
    assert {r.v: r.rank for r in windows.rank_of_values(df, "v").collect()} == expected


def test_placement(spark, rows):
    df = spark.createDataFrame([("x", 1, 1.0), ("y", 1, 2.0), ("z", 1, 2.0), ("x", 2, 9.0)], "k string, year int, v double")
    got = rows(windows.placement(df, "v", "year"), "k", "year", "place", "place_text")
    assert got == [("x", 1, 3.0, "3rd"), ("x", 2, 1.0, "1st"), ("y", 1, 1.5, "1st"), ("z", 1, 1.5, "1st")]


def test_running_total(spark, rows):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 7.0)], "g string, year int, v double")
    got = rows(windows.running_total(df, "g", "year", "v", "cum"), "g", "year", "v", "cum")
    assert got == [("a", 1, 3.0, 3.0), ("a", 2, 5.0, 8.0), ("b", 1, 7.0, 7.0)]


def test_enrich_prefixes_clashing_names(spark):
    fact = spark.createDataFrame([(1, "n1"), (2, None), (None, "n3")], "k int, name string")
    look = spark.createDataFrame([(1, "L1")], "key int, name string")
    out = joins.enrich(fact, Lookup(look, {"k": "key"}, ["name"], prefix="look"))
    assert out.columns == ["k", "name", "look_name"]
    assert {tuple(r) for r in out.collect()} == {(1, "n1", "L1"), (2, None, None), (None, "n3", None)}


def test_half_joins_and_null_keys(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows(joins.keep_listed(fact, keys, {"k": "key"})) == [(1,)]
    assert rows(joins.drop_listed(fact, keys, {"k": "key"})) == [(2,), (None,)]


def test_presence_and_share(spark, rows):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 3)], "area string, k int")
    b = spark.createDataFrame([("x", 2), ("y", 4)], "area string, k int")
    got = rows(joins.presence_by_area(a, b, "k", "area"), "area", "n_keys", "n_in_a", "n_in_b", "n_in_both", "fraction_in_a")
    assert got == [("x", 2, 2, 1, 1, 1.0), ("y", 2, 1, 1, 0, 0.5)]
    assert tuple(joins.matched_share(a, b, "k").first()) == (3, 1, pytest.approx(100 / 3))


def test_scalar_filters(spark, rows):
    df = spark.createDataFrame([(dt.date(2019, 5, 1),), (dt.date(2020, 1, 1),), (dt.date(2021, 6, 30),), (dt.date(2018, 1, 1),)], "d date")
    assert rows(filters.at_maximum(df, "d")) == [(dt.date(2021, 6, 30),)]
    assert rows(filters.at_extremes(df, F.year("d"))) == [(dt.date(2018, 1, 1),), (dt.date(2021, 6, 30),)]
    assert rows(filters.trailing_years(df, "d", 1)) == [(dt.date(2019, 5, 1),), (dt.date(2020, 1, 1),)]


def test_null_propagation_and_weights(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 4.0), (3.0, None), (5.0, 0.0)], "s double, w double")
    got = df.agg(aggs.strict_sum("s"), F.sum("s"), aggs.strict_mean("w"), aggs.inverse_weighted_mean("s", "w")).first()
    assert tuple(got) == (None, 9.0, None, 1.0)


def test_flag_profile_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 0, 11.0), ("a", None, None)], "k string, d_x int, n_y double")
    out = aggs.flag_profile(df, "k", ["d_x"], ["n_y"])
    assert out.columns == ["k", "x_percent", "y", "x_sum", "n_rows"]
    assert tuple(out.first()) == ("a", 33.3, 10.0, 1, 3)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_pivot_round_trip_and_value_bound(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "a", 7)], "id int, n string, v int")
    wide = aggs.pivot_wider(df, "id", "n", "v")
    assert rows(wide, "id", "a", "b") == [(1, 5, 6), (2, 7, None)]
    assert rows(aggs.unpivot_longer(wide, "id", ["a", "b"]).dropna()) == [(1, "a", 5), (1, "b", 6), (2, "a", 7)]
    with pytest.raises(ValueError):
        aggs.pivot_wider(df, "id", "n", "v", max_values=1)
    with pytest.raises(Exception, match="not listed"):
        aggs.pivot_wider(df, "id", "n", "v", [df.first()["n"]]).collect()


def test_percent_drop_and_lump(spark, rows):
    df = spark.createDataFrame([(2005, "T", 200.0), (2010, "X", 1.0), (2021, "T", 130.0)], "y int, s string, v double")
    assert tuple(aggs.percent_drop(df, "y", "v").first()) == (200.0, 130.0, 35.0)
    assert rows(df.select(aggs.lump_other("s", ["T"]))) == [("Other",), ("T",), ("T",)]


def test_sets(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k long")
    assert sets.unite(a, b).schema["k"].dataType.simpleString() == "bigint"
    assert rows(sets.row_differences(a, b)) == [(1, "x", 1)]
    assert not sets.same_rows(a, b).first().identical
    assert sets.same_rows(a, a.select("v", "k")).first().identical
    assert rows(sets.append_rows(a, [(9, None)])) == [(1, "x"), (1, "x"), (2, "y"), (9, None)]
    assert rows(sets.key_difference(a, a.where("k = 1"), "k")) == [(2,)]
    tagged = sets.unite_tagged({"p": a.select("k"), "q": b.select("v")}, "src")
    assert rows(tagged, "src", "k", "v")[0] == ("p", 1, None)


def test_gates(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(quality.repeated_keys(df, "k")) == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphan_keys(df, parent, {"k": "id"})) == [(2,)]
    with pytest.raises(quality.GateError):
        quality.require_none(quality.repeated_keys(df, "k"), "repeated")
    quality.require_none(quality.repeated_keys(df, "k").where("false"), "repeated")
    with pytest.raises(quality.GateError):
        quality.require_in("cars", ["core", "wider"], "grouping")


def test_profile_and_notes(spark):
    df = spark.createDataFrame([(1, "b"), (3, None), (2, "a")], "n int, s string")
    got = {r.column_name: r for r in quality.profile(df).collect()}
    assert (got["n"].min, got["n"].max, got["n"].avg, got["n"].q50, got["n"]["count"]) == ("1", "3", 2.0, 2.0, 3)
    assert (got["s"].min, got["s"].avg, got["s"].approx_unique) == ("a", None, 2)
    assert got["s"].null_percentage == pytest.approx(100 / 3)
    noted = quality.column_notes(quality.with_column_notes(df, {"n": {"unit": "kWh"}})).collect()
    assert [(r.column_name, r.unit, r.n_values) for r in noted] == [("n", "kWh", 3), ("s", None, 2)]


def test_year_window_gates(spark, rows):
    quality.require_between(2020, 2019, 2021, "year")
    for wrong in (2018, 2022, None):
        with pytest.raises(quality.GateError, match="year must lie between"):
            quality.require_between(wrong, 2019, 2021, "year")
    df = spark.createDataFrame([(2019,), (2018,), (None,), (2018,)], "y int")
    assert rows(quality.outside_window(df, "y", 2019, 2021), "y") == [(2018,), (None,)]


def test_names_of_found_values(spark):
    df = spark.createDataFrame([("Semi-Detached",), ("Flat",), (None,)], "form string")
    assert names.value_names(df, "form", "d_") == {"d_flat": "Flat", "d_semi_detached": "Semi-Detached"}
    with pytest.raises(ValueError, match="share a name"):
        names.value_names(df.unionAll(spark.createDataFrame([("flat",)], "form string")), "form")


def test_sample_does_not_depend_on_partitions(spark, rows):
    df = spark.range(1000)
    one, two = (rows(filters.sample_rows(d, "id", 40, 7), "id") for d in (df, df.repartition(9)))
    assert one == two and len(one) == 40 and rows(filters.sample_rows(df, "id", 40, 8), "id") != one
    assert filters.sample_rows(df, "id", 5000).count() == 1000
