"""Column functions against worked values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadastra.functions import bands, dates, domain, geo, numbers, text
from cadastra.operators import names


def one(spark, column, **values):
    """Value of a column over one row of string/number literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(column.alias("out")).first().out


BANDS = [
    # band, range rule, exact range rule, digit rule, group mean, label, mean of years
    ("England and Wales: before 1900", 1899, 1899.0, 1899, 1900, "Before 1900", 1900.0),
    ("England and Wales: 1900-1929", 1914, 1914.5, 1914, 1915, "Between 1900 and 1929", 1914.5),
    ("England and Wales: 1930-1949", 1940, 1939.5, 1939, 1940, "Between 1930 and 1949", 1939.5),
    ("England and Wales: 2007 onwards", 2007, 2007.0, 2007, 2007, "After 2007", 2007.0),
    ("2021", 2021, 2021.0, 2021, 2021, "After 2021", 2021.0),
    ("NO DATA!", None, None, None, None, None, None),
    ("INVALID!", None, None, None, None, None, None),
    (None, None, None, None, None, None, None),
]


@pytest.mark.parametrize("band,by_range,exact,by_digits,group,label,mean", BANDS)
def test_construction_bands(spark, band, by_range, exact, by_digits, group, label, mean):
    row = spark.createDataFrame([(band,)], "b string").select(
        bands.year_by_range("b"), bands.year_by_range_exact("b"), bands.year_by_digits("b"),
        bands.band_struct("b")["mean_year"], bands.band_struct("b")["label"], bands.mean_of_years("b"),
    ).first()
    assert tuple(row) == (by_range, exact, by_digits, group, label, mean)


def test_group_rule_fields(spark):
    made = spark.createDataFrame([("1900-1929",), ("before 1900",)], "b string")
    got = [tuple(r.s) for r in made.select(bands.band_struct("b").alias("s")).collect()]
    assert got == [(1900, 1929, None, 1915, "Between 1900 and 1929"), (None, None, 1900, 1900, "Before 1900")]


@pytest.mark.parametrize("year,label", [
    (1899, "Before 1900"), (1900, "1900 - 1930"), (1930, "1900 - 1930"), (1931, "1930 to present"), (None, "Unknown")])
def test_epoch(spark, year, label):
    assert one(spark, bands.epoch(F.lit(year).cast("int"))) == label


@pytest.mark.parametrize("value,lenient,strict", [
    ("owner-occupied", "Owner occupied", "Owner occupied"), ("Owner-occupied", "Owner occupied", "Owner occupied"),
    ("rental (private)", "Private rented", "Private rented"), ("Rented (private)", "Private rented", "Private rented"),
    ("rental (social)", "Social rented", "Social rented"), ("Social", "Social rented", "Unknown"),
    ("other", "Unknown", "Unknown"), (None, "Unknown", "Unknown")])
def test_tenure(spark, value, lenient, strict):
    made = F.lit(value).cast("string")
    assert one(spark, domain.tenure(made)) == lenient
    assert one(spark, domain.tenure_strict(made)) == strict


@pytest.mark.parametrize("value,low,high,mean", [
    ("£4,000 - £6,000", 4000, 6000, 5000.0), ("£30", 30, None, None), (None, None, None, None)])
def test_cost_bounds(spark, value, low, high, mean):
    assert tuple(one(spark, domain.cost_bounds(F.lit(value).cast("string")))) == (low, high, mean)


@pytest.mark.parametrize("label,day", [
    ("2023 Q4", dt.date(2023, 10, 1)), ("2009 4", dt.date(2009, 10, 1)), ("2010 Q1", dt.date(2010, 1, 1)), ("x", None)])
def test_quarter_start(spark, label, day):
    assert one(spark, dates.quarter_start(F.lit(label))) == day


def test_month_from_label(spark):
    assert one(spark, dates.month_from_label(F.lit("jul_23_total_devices"))) == dt.date(2023, 7, 1)
    assert one(spark, dates.month_from_label(F.lit("notes"))) is None


def test_months_around_a_year_end(spark):
    january = F.lit(dt.date(2024, 1, 31))
    assert one(spark, dates.month_before(january)) == dt.date(2023, 12, 1)
    assert one(spark, dates.month_after(F.lit(dt.date(2023, 12, 31)))) == dt.date(2024, 1, 1)


@pytest.mark.parametrize("day,year", [(dt.date(2023, 12, 31), 2023), (dt.date(2023, 12, 30), 2022)])
def test_last_complete_year(spark, day, year):
    assert one(spark, dates.last_complete_year(F.lit(day))) == year


def test_parse_timestamp_is_lenient(spark):
    assert one(spark, dates.parse_timestamp(F.lit("2024-02-30 00:00:00"), "yyyy-MM-dd HH:mm:ss")) is None
    assert one(spark, dates.parse_timestamp(F.lit("2024-02-29 01:02:03"), "yyyy-MM-dd HH:mm:ss")) == dt.datetime(2024, 2, 29, 1, 2, 3)


@pytest.mark.parametrize("n,out", [
    (1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th"), (11, "11th"), (12, "12th"), (13, "13th"), (21, "21st"), (112, "112th")])
def test_ordinal(spark, n, out):
    assert one(spark, numbers.ordinal(F.lit(n))) == out


def test_numbers(spark):
    assert one(spark, numbers.floor_midpoint(F.lit(1930), F.lit(1949))) == 1939
    assert one(spark, numbers.floor_midpoint(F.lit(0), F.lit(-7))) == -4
    assert one(spark, numbers.row_mean(F.lit(None).cast("double"), F.lit(3.0))) == 3.0
    assert one(spark, numbers.row_mean(F.lit(None).cast("double"))) is None
    assert one(spark, numbers.percent_ratio(F.lit(1), F.lit(0))) is None
    assert [one(spark, numbers.half_even_int(F.lit(v))) for v in (0.5, 1.5, 2.5)] == [0, 2, 2]


def test_text(spark):
    assert one(spark, text.strip_digits(F.lit("T20S23E"))) == "tse"
    assert one(spark, text.resource_name("domestic", F.lit("E06"), F.lit("Exeter, City of St. X"))) == "domestic-E06-Exeter-City-of-St-X.zip"
    assert one(spark, text.code_prefix(F.lit("E01000001 : City"))) == "E01000001"
    assert tuple(one(spark, text.lat_lon(F.lit("51.45, -2.59")))) == (51.45, -2.59)
    assert one(spark, text.extract_first(F.lit("abc"), "[0-9]+")) is None


@pytest.mark.parametrize("band,out", [("A", "A"), ("A+", "A"), ("C", "B_G"), (None, None)])
def test_rating_category(spark, band, out):
    assert one(spark, domain.rating_category(F.lit(band).cast("string"))) == out


def test_names():
    assert names.numbered_names(["A123", "B456", "C789"], drop_digits=True) == ["a", "b", "c"]
    assert names.numbered_names(["A1", "A2"], drop_digits=True) == ["a_1", "a"]
    assert names.numbered_names(["A1", "A2", "A3", "B"], drop_digits=True) == ["a_1", "a_2", "a", "b"]
    assert names.clean_name(" Local Authority /\n Region  Code (note) ") == "local_authority_region_code_note"


def test_name_rules(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "`d_a-b` int, n_c double, other string")
    assert names.swap_chars(df, {"-": "_"}).columns == ["d_a_b", "n_c", "other"]
    assert names.affix_names(df, "d_", suffix="_percent").columns == ["a-b_percent", "n_c", "other"]
    assert names.matching(df, numeric=True) == ["d_a-b", "n_c"]
    assert names.matching(df, "^n_") == ["n_c"]


def test_points(spark):
    wkt = geo.point_text(F.lit(1.5), F.lit(-2.0))
    assert one(spark, wkt) == "POINT (1.5 -2.0)"
    assert tuple(one(spark, geo.point_coords(wkt))) == (1.5, -2.0)
    assert tuple(one(spark, geo.point_coords(F.lit("POLYGON ((0 0, 1 1, 1 0, 0 0))")))) == (None, None)


def test_projection_matches_the_published_worked_example(spark):
    """Projection alone: 52 39 27.2531 N, 1 43 4.5177 E is E 651409.903, N 313177.270."""
    import math

    lat, lon = 52 + 39 / 60 + 27.2531 / 3600, 1 + 43 / 60 + 4.5177 / 3600
    point = spark.createDataFrame([(math.radians(lat), math.radians(lon))], "lat double, lon double")
    row = geo.project_airy(point, "lat", "lon", "e", "n").first()
    assert row.e == pytest.approx(651409.903, abs=0.002) and row.n == pytest.approx(313177.270, abs=0.002)
    back = geo.unproject_airy(spark.createDataFrame([(651409.903, 313177.270)], "e double, n double"), "e", "n", "a", "o").first()
    assert math.degrees(back.a) == pytest.approx(lat, abs=1e-8) and math.degrees(back.o) == pytest.approx(lon, abs=1e-8)


def test_datum_shift_is_within_stated_accuracy(spark):
    """Same station on WGS84: 52 39 28.8282 N, 1 42 57.8663 E, to 5 m."""
    lat, lon = 52 + 39 / 60 + 28.8282 / 3600, 1 + 42 / 60 + 57.8663 / 3600
    row = geo.wgs84_to_grid(spark.createDataFrame([(lat, lon)], "lat double, lon double"), "lat", "lon").first()
    assert abs(row.easting - 651409.903) < 5 and abs(row.northing - 313177.270) < 5


def test_reprojected_points_lie_in_the_expected_range(spark):
    grid = spark.createDataFrame([(358500.0, 173000.0)], "x double, y double")
    row = geo.grid_to_wgs84(grid, "x", "y").first()
    assert row.long < 1 and row.lat > 51
    assert row.lat == pytest.approx(51.455, abs=0.01) and row.long == pytest.approx(-2.6, abs=0.01)
