"""The certificate warehouse from files to views, on the full register layout."""

from __future__ import annotations

import csv

import pytest

from cadastra.operators import quality
from cadastra.plans import certificates, warehouse
from cadastra.sources import schemas


def write(path, schema, *records):
    """A headed CSV file with the columns of a schema; columns not given stay empty."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as handle:
        rows = csv.DictWriter(handle, schema.names)
        rows.writeheader()
        rows.writerows(records)
    return str(path)


def cert(key, uprn, when, la="E1", band="England and Wales: 1930-1949", postcode="AA1 1AA", **more):
    return dict(LMK_KEY=key, UPRN=uprn, LODGEMENT_DATETIME=when, LOCAL_AUTHORITY=la, CONSTRUCTION_AGE_BAND=band,
                POSTCODE=postcode, CO2_EMISSIONS_CURRENT="2.50", **more)


@pytest.fixture
def tables(spark, tmp_path):
    write(tmp_path / "dom" / "a.csv", schemas.DOMESTIC, cert("d1", "u1", "2020-01-01 10:00:00"), cert("d2", "u1", "2021-01-01 10:00:00"))
    write(tmp_path / "dom" / "b.csv", schemas.DOMESTIC, cert("d3", "u2", "2021-01-01 10:00:00", la="E2"))
    nondom = dict(LMK_KEY="n1", UPRN="7", LODGEMENT_DATETIME="2022-03-04 05:06:07", LOCAL_AUTHORITY="E9", POSTCODE="AA1 1AA")
    write(tmp_path / "nondom.csv", schemas.NON_DOMESTIC, nondom)
    write(tmp_path / "postcodes.csv", schemas.POSTCODES, dict(pcds="AA1 1AA", lsoa21="S1", lsoa11="O1", lat="51.5", long="-2.5", imd="12"))
    write(tmp_path / "la.csv", schemas.AUTHORITIES,
          dict(LAD22CD="E1", LAD22NM="Town, City of", CAUTH22CD="C1", CAUTH22NM="West", ObjectId="1"),
          dict(LAD22CD="E2", LAD22NM="Other", CAUTH22CD="C2", CAUTH22NM="North", ObjectId="2"))
    return {
        "domestic": warehouse.read_certificates(spark, str(tmp_path / "dom")),
        "non_domestic": warehouse.read_certificates(spark, str(tmp_path / "nondom.csv"), schemas.NON_DOMESTIC),
        "postcodes": warehouse.read_postcodes(spark, str(tmp_path / "postcodes.csv")),
        "authorities": warehouse.read_authorities(spark, str(tmp_path / "la.csv"), [("E9", "Added", "C1", "West")]),
        "tenure": spark.createDataFrame([("S1", 3)], "lsoa21cd string, owned int"),
        "imd": spark.createDataFrame([("O1", 99)], "lsoa11cd string, imd19 int"),
    }


def test_load_then_views(spark, rows, tables, tmp_path):
    root = str(tmp_path / "db")
    warehouse.load(spark, root, tables)
    assert tables["authorities"].columns == ["ladcd", "ladnm", "cauthcd", "cauthnm"]
    warehouse.define_views(spark, root, "West")
    every = spark.table("epc_domestic_vw")
    got = rows(every, "lmk_key", "geom_text", "owned", "imd19", "nominal_construction_year", "lodgement_year")
    assert got == [("d2", "POINT (-2.5 51.5)", 3, 99, 1940, 2021), ("d3", "POINT (-2.5 51.5)", 3, 99, 1940, 2021)]
    assert every.schema["co2_emissions_current"].dataType.simpleString() == "decimal(10,2)"
    assert rows(spark.table("epc_domestic_region_vw"), "lmk_key", "ladnm") == [("d2", "Town, City of")]
    assert rows(spark.table("epc_non_domestic_region_vw"), "lmk_key", "ladnm", "lsoa21") == [("n1", "Added", "S1")]


def test_a_repeated_key_refuses_the_whole_load(spark, tables, tmp_path):
    root = str(tmp_path / "db")
    twice = {**tables, "postcodes": tables["postcodes"].union(tables["postcodes"])}
    with pytest.raises(quality.GateError, match="postcodes: pcds is unique"):
        warehouse.load(spark, root, twice)
    with pytest.raises(Exception):
        warehouse.define_views(spark, root, "West")


def test_ingest_from_files_per_authority(spark, rows, tmp_path):
    layout = schemas.hyphenated(schemas.DOMESTIC)
    assert len(schemas.DOMESTIC_SUBSET) == 50 and set(schemas.DOMESTIC_SUBSET.names) <= set(layout.names)

    def record(key, uprn, when, **more):
        return {"lmk-key": key, "uprn": uprn, "lodgement-datetime": when, "tenure": "Rented (social)",
                "construction-age-band": "England and Wales: before 1900", **more}

    write(tmp_path / "c" / "epc_E1.csv", layout, record("1", "10", "2020-01-01 00:00:00"), record("2", "10", "not a time"),
          record("3", "20", "2020-01-01 00:00:00", **{"photo-supply": "?"}))
    write(tmp_path / "c" / "epc_E2.csv", layout, record("4", "20", "2021-01-01 00:00:00"), record("5", "30", "2021-05-06 00:00:00"))
    raw = warehouse.read_certificate_files(spark, str(tmp_path / "c"))
    assert raw.where("lmk_key = '3'").first().photo_supply is None
    out = certificates.ingest(raw, "source", ["lodgement_datetime", "lmk_key"])
    got = rows(out, "lmk_key", "uprn", "date", "month", "tenure_epc", "n_nominal_construction_date")
    assert got == [("1", 10, "2020-01-01", 1, "Social rented", 1899), ("5", 30, "2021-05-06", 5, "Social rented", 1899)]
