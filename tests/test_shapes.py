"""Polygons, grid shifts, open features and digests on small made inputs."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geo, grid_shift, polygons
from cadastra.operators import digests, sets
from cadastra.sources import open_features

SQUARE = "((0 0, 0 2, 2 2, 2 0, 0 0), (0.5 0.5, 0.5 1, 1 1, 0.5 0.5))"
WKT = {
    "one": f"POLYGON {SQUARE}", "two": f"MULTIPOLYGON ({SQUARE}, ((3 3, 3 4, 4 4, 3 3)))", "z": " polygon z((1 1 9,1 2 9,  2 2 9,1 1 9)) ",
    "empty": "POLYGON EMPTY", "null": None, "point": "POINT (1 2)", "open": "POLYGON ((0 0, 0 2, 2 2, 2 0))", "short": "POLYGON ((0 0, 1 1, 0 0))",
    "letters": "POLYGON ((0 0, 0 b, 2 2, 0 0))", "text": "polygons are nice", "bare": "POLYGON", "nothing": "",
}


def shapes(spark, texts=WKT):
    frame = spark.createDataFrame(list(texts.items()), "name string, wkt string")
    return frame.select("name", F.lit("own").alias("x"), polygons.polygon_parts("wkt").alias("shape"))


def test_polygons_from_and_to_text(spark):
    got = {r["name"]: r for r in shapes(spark).select("name", "shape", polygons.polygon_text("shape").alias("t")).collect()}
    assert [[(p["x"], p["y"]) for p in ring] for ring in got["one"]["shape"][0]] == [[(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)], [(0.5, 0.5), (0.5, 1), (1, 1), (0.5, 0.5)]]
    assert [len(part) for part in got["two"]["shape"]] == [2, 1] and len(got["z"]["shape"][0][0]) == 4 and got["empty"]["shape"] == []
    assert {n for n, r in got.items() if r["shape"] is None} == {"null", "point", "open", "short", "letters", "text", "bare", "nothing"}
    assert {n for n, r in got.items() if r["t"] is None} == {n for n, r in got.items() if r["shape"] is None}
    again = spark.createDataFrame([(n, r["t"]) for n, r in got.items() if r["t"]], "name string, wkt string")
    back = {r["name"]: r["shape"] for r in again.select("name", polygons.polygon_parts("wkt").alias("shape")).collect()}
    assert back == {n: r["shape"] for n, r in got.items() if r["t"]} and got["empty"]["t"] == "POLYGON EMPTY"
    ring = ", ".join(f"{i} {i * i}" for i in range(20_000)) + ", 0 0"
    assert len(shapes(spark, {"long": f"POLYGON (({ring}))"}).first()["shape"][0][0]) == 20_001


def test_vertices_move_like_points_and_holes_stay(spark):
    degrees = {n: w and re.sub(r"(\d+(?:\.\d+)?) (\d+(?:\.\d+)?)(?= 9|,|\))", lambda m: f"{-2 + float(m[1]) / 10} {51 + float(m[2]) / 10}", w) for n, w in WKT.items()}
    frame = shapes(spark, degrees)
    project = lambda df, x, y: geo.wgs84_to_grid(df, y, x)
    moved = polygons.reprojected(frame, "name", "shape", project, "easting", "northing")
    got = {r["name"]: r for r in moved.collect()}
    before = {r["name"]: r for r in frame.collect()}
    points = [(n, a, b, c, p["x"], p["y"]) for n, r in before.items() for a, part in enumerate(r["shape"] or []) for b, ring in enumerate(part) for c, p in enumerate(ring)]
    want = {tuple(r)[:4]: (r["easting"], r["northing"]) for r in geo.wgs84_to_grid(spark.createDataFrame(points, "n string, a int, b int, c int, x double, y double"), "y", "x").collect()}
    seen = {(n, a, b, c): (p["x"], p["y"]) for n, r in got.items() for a, part in enumerate(r["shape"] or []) for b, ring in enumerate(part) for c, p in enumerate(ring)}
    assert set(seen) == set(want) and all(abs(u - v) < 1e-6 for k in seen for u, v in zip(seen[k], want[k]))
    assert set(got) == set(WKT) and got["empty"]["shape"] == [] and got["null"]["shape"] is None and got["one"]["x"] == "own"
    back = {r["name"]: r["shape"] for r in polygons.reprojected(moved, "name", "shape", geo.grid_to_wgs84, "long", "lat").collect()}
    # The point functions themselves come back within 3 mm.
    assert all(abs(p["x"] - q["x"]) < 5e-8 and abs(p["y"] - q["y"]) < 5e-8 for n in ("one", "two") for s, t in zip(back[n], before[n]["shape"]) for a, b in zip(s, t) for p, q in zip(a, b))


def test_grid_shift(spark):
    """A shift that is not linear: at nodes it is the grid's, between them bilinear, and the way back undoes it."""
    node = lambda i, j: (1000.0 * i, 1000.0 * j, 90 + 0.3 * (i - 398) * (j - 298) + 0.1 * i, -70 + 0.2 * i - 0.05 * (j - 298) ** 2)
    nodes = [node(i, j) for i in range(398, 404) for j in range(298, 304) if (i, j) != (403, 303)]
    grid = spark.createDataFrame(nodes, "east double, north double, shift_east double, shift_north double")
    places = [(0, 400000.0, 300000.0), (1, 400250.0, 300750.0), (2, 401900.0, 302000.5), (3, 999999.0, 1.0), (4, 402500.0, 302500.0), (5, None, 300000.0)]
    frame = spark.createDataFrame(places, "k int, e double, n double")
    degrees = geo.grid_to_wgs84(frame, "e", "n", "lat", "lon")
    plain = {r["k"]: (r["easting"], r["northing"]) for r in grid_shift.wgs84_to_grid(degrees, "lat", "lon").collect()}
    moved = grid_shift.wgs84_to_grid(degrees, "lat", "lon", grid)
    got = {r["k"]: (r["easting"], r["northing"]) for r in moved.collect()}
    table = {(e, n): (a, b) for e, n, a, b in nodes}

    def expected(east, north):
        i, j = east // 1000 * 1000, north // 1000 * 1000
        u, v = (east - i) / 1000, (north - j) / 1000
        weights = {(i, j): (1 - u) * (1 - v), (i + 1000, j): u * (1 - v), (i, j + 1000): (1 - u) * v, (i + 1000, j + 1000): u * v}
        if set(weights) - set(table):
            return None, None
        return east + sum(w * table[c][0] for c, w in weights.items()), north + sum(w * table[c][1] for c, w in weights.items())

    for k, _, _ in places[:5]:
        want = expected(*plain[k])
        assert got[k] == want if want[0] is None else all(abs(a - b) < 1e-6 for a, b in zip(got[k], want))
    assert got[3] == got[4] == got[5] == (None, None)
    back = {r["k"]: (r["lat2"], r["lon2"]) for r in grid_shift.grid_to_wgs84(moved, "easting", "northing", grid, lat="lat2", lon="lon2").collect()}
    start = {r["k"]: (r["lat"], r["lon"]) for r in degrees.collect()}
    assert all(abs(a - b) < 5e-8 for k in (0, 1, 2) for a, b in zip(back[k], start[k])) and back[3] == (None, None)


def test_open_features(spark, tmp_path):
    pages = {
        "layer=roads/a.json": {"features": [{"attributes": {"id": 1, 'odd "name"': "x", "when": None}, "geometry": {"x": 1.5}}, {"attributes": {"id": 2}}]},
        "layer=roads/b.json": {"features": [{"attributes": {"id": "three", "extra": [1, 2]}}]},
        "layer=parks/a.json": {"features": [{"attributes": {"area": 2.5}}]}, "layer=parks/b.json": {"features": []}, "layer=parks/c.json": {"error": 1},
    }
    for name, page in pages.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps(page, indent=1))
    (tmp_path / "layer=parks/d.json").write_text("<html>not found</html>")
    features = open_features.read_open_features(spark, f"{tmp_path}/*")
    wanted = {"id": "int", 'odd "name"': "string", "area": "double", "geometry.x": "double"}
    got = sorted((tuple(r) for r in open_features.typed_attributes(features, wanted).collect()), key=str)
    assert got == sorted([("roads", 1, "x", None, 1.5), ("roads", 2, None, None, None), ("roads", None, None, None, None), ("parks", None, None, 2.5, None), ("parks", None, None, None, None)], key=str)
    types = {r["layer"]: (r["attributes_type"], r["n_features"]) for r in open_features.found_types(features).collect()}
    assert types["parks"][1] == 1 and "area: D" in types["parks"][0] and "extra: ARRAY<BIGINT>" in types["roads"][0] and "id: VARIANT" in types["roads"][0]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        open_features.typed_attributes(features, {"id": "int"}, strict=True).collect()
    assert features.where("attributes IS NULL").select("page").collect() == [("d.json",)]


def test_a_changed_row_is_found_with_one_bucket_read(spark, rows, tmp_path):
    schema = "k int, a string, b double"
    data = [(k, None if k % 7 == 0 else f"t{k}", k / 3) for k in range(500)] + [(3, "t3", 1.0)] * 4
    one = spark.createDataFrame(data, schema)
    two = spark.createDataFrame([(k, a, b + 1 if k == 77 else b) for k, a, b in reversed(data)], schema)
    paths = [str(tmp_path / n) for n in ("one", "two", "same")]
    for frame, path in zip((one, two, one.repartition(7)), paths):
        digests.store_digested(frame, path, "k", 32)
    assert digests.differing_buckets(spark, paths[0], paths[2]) == []
    assert digests.stored_differences(spark, paths[0], paths[2], one.schema).count() == 0
    changed = digests.differing_buckets(spark, paths[0], paths[1])
    found = digests.stored_differences(spark, paths[0], paths[1], one.schema)
    assert len(changed) == 1 and rows(found) == rows(sets.row_differences(one, two)) and found.count() == 2
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line]
    assert len(scans) >= 2 and all(re.search(rf"PartitionFilters: \[[^]]*{digests.BUCKET}#\d+ = {changed[0]}\)", line) for line in scans)
    # Null against a value, one copy more, and a bucket that only one of them has.
    odd = spark.createDataFrame([(0, "", 0.0) if k == 0 else (k, a, b) for k, a, b in data if k < 400] + [(9, "t9", 3.0)], schema)
    digests.store_digested(odd, str(tmp_path / "odd"), "k", 32)
    assert rows(digests.stored_differences(spark, paths[0], str(tmp_path / "odd"), one.schema)) == rows(sets.row_differences(one, odd))
