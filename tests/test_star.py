"""Bucketed tables without shuffles, and the SQL layer from another session."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cadastra.functions import bands, domain
from cadastra.plans import certificates, sql_layer, star
from cadastra.sources import writers

BANDS = [
    "England and Wales: before 1900", "England and Wales: 1900-1929", "1930-1949", "England and Wales: 2007 onwards", "2021", "NO DATA!", "", None,
    "INVALID!", "1950 - 1966", "1967-", "Before 1950",
]


@pytest.fixture
def register(spark):
    certs = spark.createDataFrame(
        [(f"c{i}", f"u{i % 13}", f"P{i % 5}", f"E{i % 3}", f"2020-01-{1 + i % 9:02d} 10:00:00", BANDS[i % len(BANDS)]) for i in range(80)] + [("x", "u1", None, "E1", None, None)],
        "lmk_key string, uprn string, postcode string, local_authority string, lodgement_datetime string, construction_age_band string",
    ).withColumn("lodgement_datetime", F.to_timestamp("lodgement_datetime"))
    return {
        "domestic": certs,
        "postcodes": spark.createDataFrame([(f"P{i}", f"S{i % 3}", f"O{i % 2}") for i in range(4)], "pcds string, lsoa21 string, lsoa11 string"),
        "tenure": spark.createDataFrame([("S0", 5), ("S1", 7)], "lsoa21cd string, owned int"),
        "imd": spark.createDataFrame([("O0", 10)], "lsoa11cd string, imd19 int"),
        "authorities": spark.createDataFrame([("E0", "Town", "West"), ("E1", "City", "North")], "ladcd string, ladnm string, cauthnm string"),
    }


COLUMNS = ["lmk_key", "uprn", "lsoa21", "owned", "imd19", "ladnm", "nominal_construction_year", "construction_epoch", "lodgement_day"]


def plain_view(register, region=None):
    certs, postcodes, tenure, imd, authorities = (register[n] for n in ("domestic", "postcodes", "tenure", "imd", "authorities"))
    return certificates.domestic_view(certs, postcodes, tenure, imd, authorities, region, postcode_columns=postcodes.columns)


def test_star_joins_where_its_buckets_lie(spark, rows, register, tmp_path):
    certs, postcodes, tenure, imd, authorities = (register[n] for n in ("domestic", "postcodes", "tenure", "imd", "authorities"))
    star.store_star(spark, "star_test", str(tmp_path), certs, postcodes, tenure, imd, 4, postcodes.columns)
    for region in (None, "West"):
        assert rows(star.star_view(spark, "star_test", authorities, region), *COLUMNS) == rows(plain_view(register, region), *COLUMNS)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        latest, directory = spark.table("star_test_latest"), spark.table("star_test_directory")
        joined = latest.join(directory, latest["postcode"] == directory["pcds"], "left")
        newest = star.latest_in_buckets(spark.table("star_test_certificates"), "uprn", "lodgement_datetime")
        for frame in (joined, newest):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    star.store_star(spark, "star_test", str(tmp_path), certs.limit(0), postcodes, tenure, imd, 4, postcodes.columns)
    assert star.star_view(spark, "star_test", authorities).count() == 0
    assert [star.bucket_count(n) for n in (0, 1, star.BUCKET_BYTES, star.BUCKET_BYTES + 1, 5 * star.BUCKET_BYTES)] == [1, 1, 1, 2, 8]


def test_functions_agree_with_the_columns(spark, register):
    spark.sql("CREATE DATABASE IF NOT EXISTS sql_rules")
    sql_layer.define_functions(spark, "sql_rules")
    texts = spark.createDataFrame([(b,) for b in [*BANDS, "Owner-occupied", "Rented (social)", "rental (private)", "Social"]], "t string")
    got = texts.select(
        F.expr("sql_rules.nominal_year(t)").eqNullSafe(bands.year_by_range("t")), F.expr("sql_rules.standard_tenure(t)").eqNullSafe(domain.tenure("t")),
        F.expr("sql_rules.construction_epoch(sql_rules.nominal_year(t))").eqNullSafe(bands.epoch(bands.year_by_range("t"))),
    ).distinct().collect()
    assert [tuple(r) for r in got] == [(True, True, True)]


def test_views_outlive_the_session_and_follow_loads(spark, rows, register, tmp_path):
    root, database = str(tmp_path / "w"), "warehouse_test"
    writers.publish_tables(spark, root, register)
    sql_layer.publish(spark, root, database)
    other = spark.newSession()
    view = f"SELECT {', '.join(COLUMNS)} FROM {database}.epc_domestic_vw"
    assert rows(other.sql(view)) == rows(plain_view(register), *COLUMNS)
    second = {**register, "domestic": register["domestic"].where("lmk_key <> 'c77'"), "tenure": register["tenure"].where("owned > 5")}
    writers.publish_tables(spark, root, second)
    assert rows(other.sql(view)) == rows(plain_view(register), *COLUMNS)  # a load is seen once it is registered
    sql_layer.register_tables(spark, root, database)
    assert rows(spark.newSession().sql(view)) == rows(plain_view(second), *COLUMNS)
    sql_layer.refresh(other, database)
    assert rows(other.sql(view)) == rows(plain_view(second), *COLUMNS)
    writers.publish_tables(spark, str(tmp_path / "part"), {"domestic": register["domestic"]})
    with pytest.raises(LookupError, match="never published"):
        sql_layer.register_tables(spark, str(tmp_path / "part"), database)
