"""Point geometry as text and closed-form reprojection.

Only points are interpreted. Polygons travel through joins as opaque columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions.cols import ColumnLike, as_col

_NUMBER = r"(-?[0-9.]+(?:[eE][+-]?[0-9]+)?)"
_POINT = r"^POINT ?\(" + _NUMBER + " " + _NUMBER + r"\)$"


def point_text(x: ColumnLike, y: ColumnLike) -> Column:
    """``POINT (x y)``; null when a coordinate is null."""
    return F.concat(
        F.lit("POINT ("), as_col(x).cast("string"), F.lit(" "), as_col(y).cast("string"), F.lit(")")
    )


def point_coords(wkt: ColumnLike) -> Column:
    """Struct(x, y) of a point text; nulls for any other geometry."""
    wkt = as_col(wkt)
    return F.struct(
        F.regexp_extract(wkt, _POINT, 1).try_cast("double").alias("x"),
        F.regexp_extract(wkt, _POINT, 2).try_cast("double").alias("y"),
    )


# Published geodetic constants (fixed values).
AIRY_A, AIRY_B = 6377563.396, 6356256.909
WGS84_A, WGS84_B = 6378137.0, 6356752.3142
GRID_F0, GRID_LAT0, GRID_LON0 = 0.9996012717, math.radians(49.0), math.radians(-2.0)
GRID_E0, GRID_N0 = 400000.0, -100000.0
# WGS84 -> OSGB36: translations in metres, rotations in arc seconds, scale in parts per million.
SHIFT_TX, SHIFT_TY, SHIFT_TZ = -446.448, 125.157, -542.060
SHIFT_RX, SHIFT_RY, SHIFT_RZ = -0.1502, -0.2470, -0.8421
SHIFT_S = 20.4894
_ITERATIONS = 6


def _to_cartesian(df: DataFrame, lat: str, lon: str, a: float, b: float, out: str) -> DataFrame:
    e2 = 1 - (b * b) / (a * a)
    df = df.withColumn(f"{out}_nu", F.lit(a) / F.sqrt(1 - e2 * F.pow(F.sin(lat), 2)))
    return df.withColumns(
        {
            f"{out}_x": F.col(f"{out}_nu") * F.cos(lat) * F.cos(lon),
            f"{out}_y": F.col(f"{out}_nu") * F.cos(lat) * F.sin(lon),
            f"{out}_z": F.col(f"{out}_nu") * (1 - e2) * F.sin(lat),
        }
    )


def _shift(df: DataFrame, src: str, out: str, sign: int) -> DataFrame:
    rx, ry, rz = (math.radians(r / 3600) * sign for r in (SHIFT_RX, SHIFT_RY, SHIFT_RZ))
    scale = 1 + sign * SHIFT_S * 1e-6
    x, y, z = (F.col(f"{src}_{axis}") for axis in "xyz")
    return df.withColumns(
        {
            f"{out}_x": sign * SHIFT_TX + x * scale - y * rz + z * ry,
            f"{out}_y": sign * SHIFT_TY + x * rz + y * scale - z * rx,
            f"{out}_z": sign * SHIFT_TZ - x * ry + y * rx + z * scale,
        }
    )


def _from_cartesian(df: DataFrame, src: str, a: float, b: float, out: str) -> DataFrame:
    e2 = 1 - (b * b) / (a * a)
    x, y, z = (F.col(f"{src}_{axis}") for axis in "xyz")
    df = df.withColumns({f"{out}_lon": F.atan2(y, x), f"{out}_p": F.sqrt(x * x + y * y)})
    df = df.withColumn(f"{out}_lat", F.atan2(z, F.col(f"{out}_p") * (1 - e2)))
    for _ in range(_ITERATIONS):
        sin_lat = F.sin(f"{out}_lat")
        nu = F.lit(a) / F.sqrt(1 - e2 * sin_lat * sin_lat)
        df = df.withColumn(f"{out}_lat", F.atan2(z + e2 * nu * sin_lat, F.col(f"{out}_p")))
    return df


def _meridian_arc(lat: Column) -> Column:
    n = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
    diff, total = lat - GRID_LAT0, lat + GRID_LAT0
    return (AIRY_B * GRID_F0) * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * diff
        - (3 * n + 3 * n**2 + 2.625 * n**3) * F.sin(diff) * F.cos(total)
        + (1.875 * n**2 + 1.875 * n**3) * F.sin(2 * diff) * F.cos(2 * total)
        - (35 / 24 * n**3) * F.sin(3 * diff) * F.cos(3 * total)
    )


def _drop_work(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def _curvature(df: DataFrame, lat: str, w: str) -> DataFrame:
    e2 = 1 - (AIRY_B * AIRY_B) / (AIRY_A * AIRY_A)
    term = 1 - e2 * F.pow(F.sin(lat), 2)
    return df.withColumns(
        {f"{w}nu": AIRY_A * GRID_F0 / F.sqrt(term), f"{w}rho": AIRY_A * GRID_F0 * (1 - e2) / F.pow(term, 1.5)}
    ).withColumn(f"{w}eta2", F.col(f"{w}nu") / F.col(f"{w}rho") - 1)


def project_airy(df: DataFrame, lat: str, lon: str, east: str, north: str) -> DataFrame:
    """Transverse Mercator on the national grid; ``lat``/``lon`` are radians on the Airy ellipsoid."""
    w = "__tm_"
    df = _curvature(df.withColumns({f"{w}dl": F.col(lon) - GRID_LON0}), lat, w)
    nu, rho, eta2, dl = (F.col(w + c) for c in ("nu", "rho", "eta2", "dl"))
    sin, cos, tan2 = F.sin(lat), F.cos(lat), F.pow(F.tan(lat), 2)
    north_value = (
        _meridian_arc(F.col(lat)) + GRID_N0
        + F.pow(dl, 2) * nu / 2 * sin * cos
        + F.pow(dl, 4) * nu / 24 * sin * F.pow(cos, 3) * (5 - tan2 + 9 * eta2)
        + F.pow(dl, 6) * nu / 720 * sin * F.pow(cos, 5) * (61 - 58 * tan2 + tan2 * tan2)
    )
    east_value = (
        GRID_E0
        + dl * nu * cos
        + F.pow(dl, 3) * nu / 6 * F.pow(cos, 3) * (nu / rho - tan2)
        + F.pow(dl, 5) * nu / 120 * F.pow(cos, 5)
        * (5 - 18 * tan2 + tan2 * tan2 + 14 * eta2 - 58 * tan2 * eta2)
    )
    return _drop_work(df.withColumns({east: east_value, north: north_value}), w)


def unproject_airy(df: DataFrame, east: str, north: str, lat: str, lon: str) -> DataFrame:
    """Inverse of :func:`project_airy`; results are radians on the Airy ellipsoid."""
    w = "__tm_"
    df = df.withColumn(f"{w}lat", (F.col(north) - GRID_N0) / (AIRY_A * GRID_F0) + GRID_LAT0)
    for _ in range(_ITERATIONS):
        rest = F.col(north) - GRID_N0 - _meridian_arc(F.col(f"{w}lat"))
        df = df.withColumn(f"{w}lat", F.col(f"{w}lat") + rest / (AIRY_A * GRID_F0))
    df = _curvature(df, f"{w}lat", w).withColumn(f"{w}de", F.col(east) - GRID_E0)
    nu, rho, eta2, de, phi = (F.col(w + c) for c in ("nu", "rho", "eta2", "de", "lat"))
    tan, sec = F.tan(phi), 1 / F.cos(phi)
    tan2 = F.pow(tan, 2)
    tan4, tan6 = tan2 * tan2, tan2 * tan2 * tan2
    lat_value = (
        phi
        - F.pow(de, 2) * tan / (2 * rho * nu)
        + F.pow(de, 4) * tan / (24 * rho * F.pow(nu, 3)) * (5 + 3 * tan2 + eta2 - 9 * tan2 * eta2)
        - F.pow(de, 6) * tan / (720 * rho * F.pow(nu, 5)) * (61 + 90 * tan2 + 45 * tan4)
    )
    lon_value = (
        GRID_LON0
        + de * sec / nu
        - F.pow(de, 3) * sec / (6 * F.pow(nu, 3)) * (nu / rho + 2 * tan2)
        + F.pow(de, 5) * sec / (120 * F.pow(nu, 5)) * (5 + 28 * tan2 + 24 * tan4)
        - F.pow(de, 7) * sec / (5040 * F.pow(nu, 7)) * (61 + 662 * tan2 + 1320 * tan4 + 720 * tan6)
    )
    return _drop_work(df.withColumns({lat: lat_value, lon: lon_value}), w)


def wgs84_to_grid(df: DataFrame, lat: str, lon: str, east: str = "easting", north: str = "northing") -> DataFrame:
    """Degrees on WGS84 to British National Grid metres.

    Seven-parameter shift and transverse Mercator: good to about 5 m, no grid-shift file.
    """
    w = "__geo_"
    df = df.withColumns({f"{w}lat": F.radians(lat), f"{w}lon": F.radians(lon)})
    df = _to_cartesian(df, f"{w}lat", f"{w}lon", WGS84_A, WGS84_B, f"{w}a")
    df = _from_cartesian(_shift(df, f"{w}a", f"{w}b", 1), f"{w}b", AIRY_A, AIRY_B, f"{w}c")
    return _drop_work(project_airy(df, f"{w}c_lat", f"{w}c_lon", east, north), w)


def grid_to_wgs84(df: DataFrame, east: str, north: str, lat: str = "lat", lon: str = "long") -> DataFrame:
    """British National Grid metres to degrees on WGS84; same accuracy as :func:`wgs84_to_grid`."""
    w = "__geo_"
    df = unproject_airy(df, east, north, f"{w}lat", f"{w}lon")
    df = _to_cartesian(df, f"{w}lat", f"{w}lon", AIRY_A, AIRY_B, f"{w}a")
    df = _from_cartesian(_shift(df, f"{w}a", f"{w}b", -1), f"{w}b", WGS84_A, WGS84_B, f"{w}c")
    return _drop_work(df.withColumns({lat: F.degrees(f"{w}c_lat"), lon: F.degrees(f"{w}c_lon")}), w)
