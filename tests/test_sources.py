"""Files in and out: lineage, short rows, quarantine, schemas, atomic loads, exports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from cadastra.operators import quality
from cadastra.sources import readers, schemas, writers
from cadastra.sources.inline import local_table
from cadastra.sources.staging import fresh_dir, scratch_root, stage

SHAPE = T.StructType().add("id", T.LongType()).add("name", T.StringType()).add("n", T.IntegerType())


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, body in files.items():
            (tmp_path / f"{name}.csv").write_text(body, encoding="utf-8")
        return str(tmp_path)

    return write


def test_declared_csv_maps_by_position_and_pads_short_rows(spark, rows, folder):
    path = folder(a="X,Y,Z\n1,one,10\n2,two\n", b="X,Y,Z\n", c="", d='X,Y,Z\n3,"a, b",30\n')
    df = readers.read_declared_csv(spark, path, SHAPE)
    assert rows(df, "id", "name", "n") == [(1, "one", 10), (2, "two", None), (3, "a, b", 30)]
    assert {r.filename.rsplit("/", 1)[1] for r in df.collect()} == {"a.csv", "d.csv"}


def test_tolerant_csv_keeps_rows_and_quarantines_lines(spark, rows, folder):
    path = folder(a="id,name,n\n1,one,10\n2,two,many\nx,three,3\n")
    good, bad = readers.split_tolerant(readers.read_tolerant_csv(spark, path, SHAPE))
    assert rows(good, "name", "id", "n") == [("one", 1, 10), ("three", None, 3), ("two", 2, None)]
    assert rows(bad, "line") == [("2,two,many",), ("x,three,3",)]


def test_flag_is_right_in_a_narrow_selection(spark, folder):
    path = folder(a="id,name,n\n1,one,10\n2,two,many\nx,three,3\n")
    parsed = readers.read_tolerant_csv(spark, path, SHAPE)
    flags = {r["name"]: r["bad"] for r in parsed.selectExpr("name", f"{readers.CORRUPT} IS NOT NULL AS bad").collect()}
    assert flags == {"one": False, "two": True, "three": True}


def test_bad_bytes_are_tolerated(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"id,name,n\n1,caf\xe9,2\n")
    row = readers.read_tolerant_csv(spark, str(tmp_path), SHAPE).first()
    assert (row.id, row.n) == (1, 2) and row.name.startswith("caf")


def test_strict_and_lenient_casts(spark, folder):
    text = readers.read_text_csv(spark, folder(a="id,n\n1,7\n2,x\n"), ["id", "n"])
    assert [r.n for r in readers.cast_columns(text, {"n": "int"}, strict=False).orderBy("id").collect()] == [7, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.cast_columns(text, {"n": "int"}).collect()


def test_path_key_scan_opens_only_matching_files(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("la", F.concat(F.lit("E0"), (F.col("id") % 5).cast("string"))).write.partitionBy("la").parquet(path)
    df = readers.read_by_path_key(spark.read.parquet, path, r"/la=([^/]+)/", ["E01", "E03"], "key")
    assert {r.key for r in df.collect()} == {"E01", "E03"} and df.count() == 40
    # The predicate sits in the scan node, on the file path alone.
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [regexp_extract(file_path" in scan


def test_schema_from_metadata_and_json(spark, tmp_path):
    meta = spark.createDataFrame(
        [("c.csv", "B", "integer", 2), ("c.csv", "A", "date", 1), ("c.csv", "C", "code", 3), ("r.csv", "Z", "float", 1)],
        "filename string, `column` string, datatype string, position int",
    )
    expected = T.StructType.fromDDL("A date, B bigint, C string")
    assert readers.schema_from_metadata(meta, "c.csv", position_col="position") == expected
    doc = {"tables": [{"url": "c.csv", "tableSchema": {"columns": [
        {"name": "A", "datatype": "date"}, {"name": "B", "datatype": "integer"}, {"name": "C", "datatype": "code"}]}}]}
    (tmp_path / "schema.json").write_text(json.dumps(doc, indent=1))
    assert readers.schema_from_json(spark, str(tmp_path / "schema.json"), "c.csv") == expected


def test_declared_schemas():
    assert (len(schemas.DOMESTIC), len(schemas.NON_DOMESTIC), len(schemas.POSTCODES)) == (92, 40, 53)
    assert schemas.DOMESTIC["CO2_EMISSIONS_CURRENT"].dataType == T.DecimalType(10, 2)
    assert schemas.NON_DOMESTIC["UPRN"].dataType == T.LongType()
    names = schemas.vehicle_licences().names
    assert len(names) == 62 and names[5] == "2023 Q4" and names[-1] == "2009 Q4"


def test_header_promotion(spark, rows):
    raw = spark.createDataFrame(
        [(None, "Title", None), ("code", "jul_23", "oct_23"), ("E1", "5", "x"), (None, None, None), ("Grand total", "5", "1")],
        "a string, b string, c string",
    )
    table = readers.promote_header(raw, "a", "code", total_pattern="Grand")
    assert table.columns == ["code", "jul_23", "oct_23"] and rows(table) == [("E1", "5", None)]
    with pytest.raises(ValueError):
        readers.promote_header(raw, "a", "nothing like it")


def test_feature_rows(spark, rows, tmp_path):
    body = {"features": [{"attributes": {"ObjectId": 1, "code": "a"}, "geometry": {"x": 1.0, "y": 2.0}},
                         {"attributes": {"ObjectId": 2, "code": "b"}, "geometry": None}]}
    (tmp_path / "f.json").write_text(json.dumps(body))
    df = readers.features_to_rows(spark.read.json(str(tmp_path / "f.json")))
    assert rows(df, "code", "x", "y") == [("a", 1.0, 2.0), ("b", None, None)] and "ObjectId" not in df.columns


def test_yearly_series_names():
    assert list(readers.year_names("Renewables 2014 to 2016", "LA - Generation, {year}")) == [
        "LA - Generation, 2014", "LA - Generation, 2015", "LA - Generation, 2016"]


def test_local_table_has_a_known_size(spark, rows):
    df = local_table(spark, [("a", 1), (None, None)], "k string, n int")
    assert rows(df) == [("a", 1), (None, None)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert local_table(spark, [], "k string").count() == 0


def test_append_refuses_a_foreign_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2)], SHAPE)
    writers.append_table(df.select("n", "name", "id"), str(tmp_path / "t"), SHAPE)
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "name", "n"]
    with pytest.raises(Exception):
        writers.append_table(df.drop("id").withColumn("n", F.lit("x")), str(tmp_path / "t"), SHAPE)


def test_publish_is_all_or_nothing(spark, tmp_path):
    root, one, two = str(tmp_path / "db"), spark.range(3), spark.range(5)
    with pytest.raises(Exception):
        writers.published_table(spark, root, "t")
    writers.publish_tables(spark, root, {"t": one, "u": one})

    def refuse(stored):
        quality.require_none(stored["t"], "refused")

    with pytest.raises(quality.GateError):
        writers.publish_tables(spark, root, {"t": two, "u": two}, refuse)
    assert writers.published_table(spark, root, "t").count() == 3
    writers.publish_tables(spark, root, {"t": two})
    assert writers.published_table(spark, root, "t").count() == 5
    assert writers.published_table(spark, root, "u").count() == 3


def test_csv_export_writes_nulls_as_empty_cells(spark, tmp_path):
    writers.write_csv(spark.createDataFrame([(1, None, 2)], SHAPE).coalesce(1), str(tmp_path / "o"))
    body = next((tmp_path / "o").glob("*.csv")).read_text()
    assert body.splitlines() == ["id,name,n", "1,,2"]


def test_geojson_lines(spark):
    df = spark.createDataFrame([(1, 2.5, "a")], "x int, y double, code string")
    feature = json.loads(writers.geojson_features(df, F.col("x").cast("double"), "y", ["code"]).first().value)
    assert feature == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.5]}, "properties": {"code": "a"}}


def test_column_notes_survive_parquet(spark, tmp_path):
    noted = quality.with_column_notes(spark.range(2), {"id": {"comment": "key", "unit": "none"}})
    noted.write.parquet(str(tmp_path / "n"))
    assert quality.column_notes(spark.read.parquet(str(tmp_path / "n"))).first().comment == "key"


def test_scratch_folder_comes_from_the_session(spark):
    given = spark.conf.get("spark.checkpoint.dir", None)
    assert given is None or scratch_root(spark) == given.rstrip("/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert f"{scratch_root(spark)}/cadastra-x-" in stage(spark.range(3), "x").inputFiles()[0]


class OtherSession:
    """A session of which only the settings are asked for."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_folder_without_a_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(OtherSession(spark_master="yarn"))
    local = scratch_root(OtherSession(spark_master="local[4]"))
    assert local == scratch_root(OtherSession(spark_master="local[*]"))
    assert scratch_root(OtherSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///cp/")) == "hdfs:///cp"


def test_catalog_table_is_replaced(spark, tmp_path):
    for rows_wanted in (3, 5):
        stored = writers.replace_catalog_table(spark.range(rows_wanted), "cadastra_test_table", str(tmp_path / "t"))
        assert stored.count() == rows_wanted
    spark.sql("DROP TABLE cadastra_test_table")


def test_rename_update_batch(spark):
    out = writers.conform_update(spark.createDataFrame([(1,)], "`lmk-key` int"), "2024/01/01 00:00:00")
    assert out.columns == ["LMK_KEY", "filename"] and out.first().filename == "update - 2024/01/01 00:00:00"


def test_carried_geometry_and_code_list(spark):
    df = spark.createDataFrame([(1, '{"type":"Point","coordinates":[1,2]}'), (2, None)], "id int, shape string")
    values = sorted(r["value"] for r in writers.geojson_carried(df, "shape", ["id"]).collect())
    assert values == [
        '{"type":"Feature","geometry":null,"properties":{"id":2}}',
        '{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"id":1}}',
    ]
    codes = spark.createDataFrame([("E2",), ("E1",), ("E2",)], "code string")
    assert writers.json_list(codes, "code").first()["value"] == '["E1","E2"]'
