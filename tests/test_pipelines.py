"""Indicator pipelines on small register tables with hand-worked results."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadastra.operators import quality
from cadastra.plans import certificates, indicators


@pytest.fixture(scope="module")
def register(spark):
    certs = spark.createDataFrame([
        ("l1", "u1", "BS1 1AA", "E1", dt.datetime(2020, 5, 1), "England and Wales: 1900-1929", "C"),
        ("l2", "u1", "BS1 1AA", "E1", dt.datetime(2022, 6, 2), "England and Wales: 1930-1949", "B"),
        ("l3", "u2", "BS2 2BB", "E1", dt.datetime(2021, 1, 1), "England and Wales: before 1900", "D"),
        ("l4", "u3", None, "E2", dt.datetime(2021, 1, 1), None, "A"),
        ("l5", "u4", "BS1 1AA", "E1", dt.datetime(2019, 1, 1), "2021", "A"),
        ("l6", "u4", "ZZ9 9ZZ", "E2", dt.datetime(2020, 1, 1), "2021", "A"),  # moved out of the region
        ("l7", None, "BS1 1AA", "E1", dt.datetime(2020, 1, 1), "2021", "A"),
    ], "lmk_key string, uprn string, postcode string, local_authority string, lodgement_datetime timestamp_ntz, "
       "construction_age_band string, current_energy_rating string")
    postcodes = spark.createDataFrame([("BS1 1AA", "S1", "O1", 1.0), ("BS2 2BB", "S2", "O2", 2.0)],
                                      "pcds string, lsoa21 string, lsoa11 string, lat double").withColumn("long", F.lit(0.0))
    tenure = spark.createDataFrame([("S1", 5, 7)], "lsoa21cd string, owned int, lat int")
    imd = spark.createDataFrame([("O1", 100)], "lsoa11cd string, imd19 int")
    authorities = spark.createDataFrame([("E1", "Exeter", "C1", "West"), ("E2", "Leeds", "C2", "North")],
                                        "ladcd string, ladnm string, cauthcd string, cauthnm string")
    return certs, postcodes, tenure, imd, authorities


def test_domestic_view(register, rows):
    certs, postcodes, tenure, imd, authorities = register
    view = certificates.domestic_view(certs, postcodes, tenure, imd, authorities, postcode_columns=postcodes.columns)
    assert len(set(view.columns)) == len(view.columns)
    got = rows(view, "lmk_key", "lsoa21", "owned", "imd19", "ladnm", "nominal_construction_year", "construction_epoch", "lodgement_year")
    assert got == [
        ("l2", "S1", 5, 100, "Exeter", 1940, "1930 to present", 2022),
        ("l3", "S2", None, None, "Exeter", 1899, "Before 1900", 2021),
        ("l4", None, None, None, "Leeds", None, "Unknown", 2021),
        ("l6", None, None, None, "Leeds", 2021, "1930 to present", 2020),
    ]


def test_domestic_view_of_a_region_leaves_out_moved_properties(register, rows):
    certs, postcodes, tenure, imd, authorities = register
    view = certificates.domestic_view(certs, postcodes, tenure, imd, authorities, "West", postcodes.columns)
    assert rows(view, "lmk_key", "cauthnm") == [("l2", "West"), ("l3", "West")]


def test_non_domestic_view(register, rows):
    certs, postcodes, _, _, authorities = register
    view = certificates.non_domestic_view(certs, postcodes, authorities, "North")
    assert view.count() == 0  # neither property of the region has a known postcode
    west = certificates.non_domestic_view(certs, postcodes, authorities, "West")
    assert rows(west, "lmk_key", "ladnm", "lsoa21") == [("l2", "Exeter", "S1"), ("l3", "Exeter", "S2")]
    assert "postcode" not in west.columns


def test_portal_view_numbers_rows_in_key_order(register, rows):
    certs, postcodes, tenure, _, authorities = register
    dated = certs.withColumn("n_nominal_construction_date", F.lit(1925))
    tenure = tenure.withColumnRenamed("lsoa21cd", "lsoacd")
    imd = tenure.select("lsoacd", F.lit(3).alias("imd_decile"))
    view = certificates.portal_view(dated, postcodes, tenure, imd, authorities, "West", postcodes.columns)
    assert rows(view, "rowname", "lmk_key", "n_imd_decile", "construction_epoch")[0] == (1, "l1", 3, "1900 - 1930")
    assert [r[0] for r in rows(view, "rowname")] == [1, 2, 3, 4, 5]


def test_ingest_drops_properties_found_in_two_files(spark, rows):
    raw = spark.createDataFrame([
        ("a", "u1", "1", "2020-01-01 00:00:00", "owner-occupied", "1900-1929"),
        ("a", "u1", "2", "2021-01-01 00:00:00", "Rented (social)", "1930-1949"),
        ("a", "u2", "3", "2021-01-01 00:00:00", None, None), ("b", "u2", "4", "2022-01-01 00:00:00", None, None),
    ], "file string, uprn string, lmk string, lodgement_datetime string, tenure string, construction_age_band string")
    raw = raw.withColumn("lodgement_datetime", F.col("lodgement_datetime").cast("timestamp_ntz"))
    out = certificates.ingest(raw, "file", ["lodgement_datetime", "lmk"])
    got = rows(out, "lmk", "date", "year", "month", "tenure_epc", "n_nominal_construction_date")
    assert got == [("2", "2021-01-01", 2021, 1, "Social rented", 1939)]


def test_band_by_rating(register, rows):
    out = certificates.band_by_rating(register[0], ["A", "B", "C", "D"])
    assert ("2021", 3, None, None, None) in rows(out, "construction_age_band", "A", "B", "C", "D")


def test_rating_distribution_includes_rows_without_area(register, rows):
    certs, postcodes, *_ = register
    areas = postcodes.select("pcds", F.col("lsoa21").alias("msoa21nm"))
    assert rows(certificates.rating_distribution(certs, areas, F.col("msoa21nm") == "S1")) == [("A", 1), ("B", 1)]
    assert rows(certificates.rating_distribution(certs, areas, F.col("msoa21nm").isNull())) == [("A", 2)]


def test_a_rated_share(register, rows):
    certs, *_, authorities = register
    bands = certs.withColumnRenamed("current_energy_rating", "asset_rating_band")
    out = indicators.a_rated_share(bands, authorities)
    assert rows(out, "cauthnm", "a", "b_g", "a_to_rest_pct") == [("North", 2, None, None), ("West", 2, 3, 66.7)]


@pytest.fixture(scope="module")
def emissions(spark):
    return spark.createDataFrame([
        ("E1", 2020, "road", 10.0, 100.0), ("E1", 2020, "rail", 5.0, 100.0), ("E1", 2021, "road", 8.0, 100.0),
        ("E2", 2020, "road", 30.0, 200.0), ("E2", 2021, "road", 30.0, 200.0), ("E9", 2021, "road", 4.0, 50.0),
        ("E1", 2021, "homes", 99.0, 100.0),
    ], "local_authority_code string, calendar_year int, la_ghg_sub_sector string, territorial_emissions_kt_co2e double, "
       "mid_year_population_thousands double")


def test_emissions_per_capita_with_an_extra_member(spark, emissions, rows):
    authorities = spark.createDataFrame([("E1", "West"), ("E2", "North")], "ladcd string, cauthnm string")
    out = indicators.emissions_per_capita(emissions, authorities, ["road", "rail"], [("E9", "West")], ("West", "West (inc NS)"))
    got = rows(out, "cauthnm", "calendar_year", "population", "amount", "per_capita")
    assert got == [("North", 2020, 200000.0, 30.0, 0.15), ("North", 2021, 200000.0, 30.0, 0.15),
                   ("West (inc NS)", 2020, 100000.0, 15.0, 0.15), ("West (inc NS)", 2021, 150000.0, 12.0, 0.08)]
    places = indicators.latest_places(out, "per_capita", "calendar_year")
    assert rows(places, "cauthnm", "place_text") == [("North", "1st"), ("West (inc NS)", "2nd")]


def test_unknown_sub_sector_is_refused(emissions):
    indicators.check_sub_sectors(emissions, ["road"])
    with pytest.raises(quality.GateError):
        indicators.check_sub_sectors(emissions, ["road", "space travel"])


def test_sector_totals_and_chart(spark, rows):
    raw = spark.createDataFrame([("B", 2005, "Domestic", 5.0), ("B", 2005, "Waste", 1.0), ("B", 2005, "LULUCF", 2.0),
                                 ("NS", 2005, "Domestic", 50.0), ("B", 2004, "Domestic", 9.0)],
                                "local_authority string, calendar_year int, la_ghg_sector string, territorial_emissions_kt_co2e double")
    totals = indicators.sector_totals(raw, ["Domestic"], 2005, ["NS"])
    assert rows(totals) == [(2005, "Domestic", 5.0), (2005, "Other", 3.0)]
    assert rows(indicators.sector_chart(totals, ["Domestic", "Other"])) == [(2005, 5.0, 3.0)]


def test_car_ratio(spark, rows):
    traffic = spark.createDataFrame([(1, "E1", 2020, 50.0, 100.0), (1, "E1", 2021, 60.0, 100.0), (2, "E8", 2021, 1.0, 2.0)],
                                    "local_authority_id int, local_authority_code string, year int, cars_and_taxis double, all_motor_vehicles double")
    authorities = spark.createDataFrame([("E1", "West")], "ladcd string, cauthnm string")
    lookup = indicators.traffic_lookup(traffic, authorities)
    assert rows(lookup) == [(1, "E1", 2021)]
    members = lookup.join(authorities, "ladcd")
    assert rows(indicators.car_ratio_series(traffic, members)) == [("West", 2020, 50.0), ("West", 2021, 60.0)]


def test_chargers_long(spark, rows):
    wide = spark.createDataFrame([("E1", "Exeter", "10", "x"), ("E9", "Elsewhere", "1", "1")],
                                 "local_authority_region_code string, local_authority_region_name string, "
                                 "jul_23_total_public_charging_devices string, oct_22_per_100k_population string")
    authorities = spark.createDataFrame([("E1", "West")], "ladcd string, cauthnm string")
    got = rows(indicators.chargers_long(wide, authorities), "cauthnm", "end_date", "variable", "value")
    assert got == [("West", dt.date(2022, 10, 1), "per_100k_population", None),
                   ("West", dt.date(2023, 7, 1), "total_charging_devices", 10.0)]


def test_licences_long(spark, rows):
    wide = spark.createDataFrame([("S1", "Cars", 5, 6), ("S9", "Cars", 1, 1)], "lsoa11cd string, body string, `2023 Q4` int, `2018 Q1` int")
    areas = spark.createDataFrame([("S1",)], "lsoa string")
    assert rows(indicators.licences_long(wide, areas, "lsoa", "2019-01-01")) == [("S1", "Cars", 5, dt.date(2023, 10, 1))]
    assert indicators.licences_long(wide, areas, "lsoa").count() == 2


def test_improvement_costs(spark, rows):
    recs = spark.createDataFrame([("1", "Wall", "£4,000 - £6,000"), ("1", "Wall", "£30"), ("2", "Roof", None), ("3", "Heat", "£10 - £20")],
                                 "improvement_id string, improvement_id_text string, indicative_cost string")
    out = indicators.improvement_costs(recs)
    assert [tuple(r) for r in out.collect()] == [("Wall", 5000.0, 2), ("Heat", 15.0, 1)]


def test_sites_and_tracker_and_tenure(spark, rows):
    raw = spark.createDataFrame([(7, "51.5,-2.5", "p", None, "Road")], "siteid int, geo_point_2d string, photopath string, colocated string, location string")
    site = indicators.monitoring_sites(raw, "base/").first()
    assert (site.site_id, site.latitude, site.colocated, site.thumbnail_photo) == (7, 51.5, 0, "base/thumbs/7.jpg")
    sheet = spark.createDataFrame([(1, "do", "x"), (2, None, "y")], "ID int, Action string, `Action areas` string")
    tracker = indicators.action_tracker({"instructions": sheet, "Climate Resilience ": sheet}, ["instructions"],
                                        {"Climate Resilience ": "Climate Resilience"},
                                        columns=["pillar", "action_areas", "id", "action"])
    with pytest.raises(Exception, match="update_for_march_2024"):
        indicators.action_tracker({"s": sheet}).collect()
    assert rows(tracker, "pillar", "action_areas", "id", "action") == [("Climate Resilience ", "Climate Resilience", "1", "do")]
    tenure = spark.createDataFrame([("A", "S1", "Owned: Total", 5), ("A", "S1", "Private rented", 7)],
                                   "GEOGRAPHY_NAME string, GEOGRAPHY_CODE string, C2021_TENURE_9_NAME string, OBS_VALUE bigint")
    wide = indicators.tenure_wide(tenure)
    assert rows(wide, "lsoa_name", "lsoa21cd", "owned_total", "private_rented") == [("A", "S1", 5, 7)]
