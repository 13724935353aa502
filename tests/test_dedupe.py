"""Every meaning of "latest per key" on one shared fixture, and against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from cadastra.operators import dedupe

D = dt.date


@pytest.fixture(scope="module")
def certs(spark):
    data = [
        ("a", D(2023, 1, 1), 1, "f1"), ("a", D(2023, 2, 1), 2, "f1"), ("c", D(2023, 1, 1), 3, "f1"),
        ("d", D(2023, 1, 1), 4, "f1"), ("e", D(2023, 1, 1), 5, "f1"), ("e", D(2023, 3, 1), 6, "f2"),
        ("t", D(2023, 5, 1), 7, "f1"), ("t", D(2023, 5, 1), 8, "f1"),  # a tie on the latest date
        (None, D(2023, 1, 1), 9, "f1"), (None, D(2023, 2, 1), 10, "f1"),  # null key
        ("n", None, 11, "f1"),  # only date is null
    ]
    return spark.createDataFrame(data, "uprn string, ld date, lmk int, file string")


def kept(df):
    return sorted(r.lmk for r in df.collect())


def test_latest_with_ties(certs):
    assert kept(dedupe.latest_with_ties(certs, "uprn", "ld")) == [2, 3, 4, 6, 7, 8]


def test_latest_with_ties_among_a_subset_uses_the_date_of_the_whole_table(certs):
    subset = certs.where("file = 'f1'")
    assert kept(dedupe.latest_with_ties(certs, "uprn", "ld", among=subset)) == [2, 3, 4, 7, 8]


def test_latest_of_group(certs):
    assert kept(dedupe.latest_of_group(certs, "uprn", "ld")) == [2, 3, 4, 6, 7, 8, 10, 11]


def test_latest_row(certs):
    assert kept(dedupe.latest_row(certs, "uprn", "ld", "lmk")) == [2, 3, 4, 6, 8, 10, 11]


def test_first_of_latest(certs):
    assert kept(dedupe.first_of_latest(certs, "uprn", "ld", "lmk")) == [2, 3, 4, 6, 7, 10]


def test_last_after_sort(certs):
    assert kept(dedupe.last_after_sort(certs, "uprn", ["ld", "lmk"])) == [2, 3, 4, 6, 8, 10, 11]


def test_latest_overall(certs):
    assert kept(dedupe.latest_overall(certs, "ld", "lmk")) == [8]


def test_last_per_source_then_drop(certs):
    per_file = dedupe.last_per_source(certs, "file", "uprn", ["ld", "lmk"])
    assert kept(per_file) == [2, 3, 4, 5, 6, 8, 10, 11]
    two_steps = kept(dedupe.drop_repeated_keys(per_file, "uprn"))
    assert two_steps == [2, 3, 4, 8, 10, 11]  # e is in two files
    assert kept(dedupe.latest_of_single_source(certs, "file", "uprn", ["ld", "lmk"])) == two_steps


def test_drop_repeated_keys(certs):
    assert kept(dedupe.drop_repeated_keys(certs, "uprn")) == [3, 4, 11]


def test_first_per_subset(certs):
    assert kept(dedupe.first_per_subset(certs, ["uprn", "file"], "lmk")) == [1, 3, 4, 5, 6, 7, 9, 11]


def test_column_order_and_empty_input(certs):
    for op in (lambda d: dedupe.latest_with_ties(d, "uprn", "ld"), lambda d: dedupe.latest_of_group(d, "uprn", "ld"),
               lambda d: dedupe.last_after_sort(d, "uprn", ["ld"]), lambda d: dedupe.drop_repeated_keys(d, "uprn")):
        assert op(certs).columns == certs.columns
        assert op(certs.where("false")).count() == 0


def test_one_key_holding_a_third_of_the_rows(spark):
    """Brute force on skewed data with many ties."""
    rng = random.Random(5)
    data = [(None if rng.random() < 0.1 else (0 if i % 3 == 0 else rng.randrange(50)), rng.randrange(8), i) for i in range(900)]
    df = spark.createDataFrame(data, "k int, t int, i int")
    newest, last, counts = {}, {}, {}
    for k, t, i in data:
        newest[k] = max(newest.get(k, t), t)
        last[k] = max(last.get(k, (t, i)), (t, i))
        counts[k] = counts.get(k, 0) + 1
    got = {r.i for r in dedupe.latest_of_group(df, "k", "t").collect()}
    assert got == {i for k, t, i in data if newest[k] == t}
    assert {r.i for r in dedupe.latest_with_ties(df, "k", "t").collect()} == {i for k, t, i in data if k is not None and newest[k] == t}
    assert {r.i for r in dedupe.last_after_sort(df, "k", ["t", "i"]).collect()} == {i for _, i in last.values()}
    assert {r.i for r in dedupe.latest_row(df, "k", "t", "i").collect()} == {i for _, i in last.values()}
    assert {r.i for r in dedupe.drop_repeated_keys(df, "k").collect()} == {i for k, t, i in data if counts[k] == 1}


def test_a_null_source_is_a_source_of_its_own(spark, rows):
    certs = spark.createDataFrame(
        [(1, None, 5), (2, None, 1), (2, "a", 2), (3, "a", 1), (3, "a", 4), (4, "a", 1), (4, "b", 2)], "uprn int, file string, v int"
    )
    assert rows(dedupe.latest_of_single_source(certs, "file", "uprn", "v"), "uprn", "v") == [(1, 5), (3, 4)]
