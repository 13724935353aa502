"""Polygons as nested arrays: text to vertices, vertices reprojected, vertices to text.

A geometry is an array of parts, a part an array of rings (the first is the outline, the others are holes), a
ring an array of vertices ``{x, y}``. Null geometry stays null. Broken geometry becomes null as a whole: another
kind than polygon or multipolygon, a coordinate that is no number, a ring of fewer than four vertices or one that
does not end where it began. An empty polygon has no parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions.cols import ColumnLike, as_col, as_list

SHAPE = "array<array<array<struct<x:double,y:double>>>>"
_BRACKETS = r"[\s()]+"


def polygon_parts(wkt: ColumnLike) -> Column:
    """Nested arrays of a ``POLYGON`` or ``MULTIPOLYGON`` text; a third coordinate is left out."""
    text = F.trim(as_col(wkt))
    multi, single = text.rlike(r"(?i)^multipolygon\b"), text.rlike(r"(?i)^polygon\b")
    empty = text.rlike(r"(?i)\bempty$")
    body = F.regexp_replace(text, r"(?i)^(multi)?polygon(\s+z)?\s*", "")
    listed = F.when(multi, F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")).otherwise(F.array(body))

    def vertex(pair: Column) -> Column:
        numbers = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(numbers, F.lit(0)).try_cast("double").alias("x"), F.get(numbers, F.lit(1)).try_cast("double").alias("y"))

    def ring(points: Column) -> Column:
        return F.transform(F.split(F.regexp_replace(points, r"^" + _BRACKETS + "|" + _BRACKETS + "$", ""), ","), vertex)

    parts = F.transform(listed, lambda part: F.transform(F.split(part, r"\)\s*,\s*\("), ring))

    def closed(points: Column) -> Column:
        known = F.forall(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
        first, last = points[0], F.element_at(points, -1)
        return known & (F.size(points) >= 4) & (first["x"] == last["x"]) & (first["y"] == last["y"])

    whole = F.forall(parts, lambda part: F.forall(part, closed))
    none = F.array().cast(SHAPE)
    return F.when(text.isNull() | ~(multi | single), F.lit(None).cast(SHAPE)).when(empty, none).when(whole, parts)


def polygon_text(parts: ColumnLike) -> Column:
    """``MULTIPOLYGON`` text of nested arrays, ``POLYGON`` where there is one part; null for null."""
    parts = as_col(parts)
    comma = lambda items: F.array_join(items, ", ")
    bracket = lambda inner: F.concat(F.lit("("), inner, F.lit(")"))
    ring = lambda points: bracket(comma(F.transform(points, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))))
    part = lambda rings: bracket(comma(F.transform(rings, ring)))
    several = F.concat(F.lit("MULTIPOLYGON "), bracket(comma(F.transform(parts, part))))
    one = F.concat(F.lit("POLYGON "), part(parts[0]))
    return F.when(F.size(parts) == 0, F.lit("POLYGON EMPTY")).when(F.size(parts) == 1, one).when(F.size(parts) > 1, several)


def vertices(df: DataFrame, shape: str) -> DataFrame:
    """One row per vertex: the other columns, ``part, ring, position`` from 0, and ``x, y``. Columns of these names raise."""
    others = [c for c in df.columns if c != shape]
    if clash := {"part", "ring", "position", "x", "y"} & set(others):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    rows = df.select(*others, F.posexplode(shape).alias("part", "__rings"))
    rows = rows.select(*others, "part", F.posexplode("__rings").alias("ring", "__points"))
    return rows.select(*others, "part", "ring", F.posexplode("__points").alias("position", "__p")).select(*others, "part", "ring", "position", "__p.*")


def reprojected(df: DataFrame, key, shape: str, project: Callable[[DataFrame, str, str], DataFrame], x: str, y: str) -> DataFrame:
    """The frame with every vertex of ``shape`` taken through ``project``; parts, rings and their order are kept.

    ``project(df, "x", "y")`` adds the new coordinates as columns ``x`` and ``y`` are named, like the point
    functions of :mod:`geo`. ``key`` must identify rows; a row's vertices meet in one task, and only they are
    shuffled. Null and empty geometry stays.
    """
    keys = as_list(key)
    points = project(vertices(df.select(*keys, F.col(shape).alias("__shape")), "__shape"), "x", "y")
    rings = points.groupBy(*keys, "part", "ring").agg(F.array_sort(F.collect_list(F.struct("position", F.col(x).alias("__x"), F.col(y).alias("__y")))).alias("__ring"))
    as_vertices = F.transform("__ring", lambda p: F.struct(p["__x"].alias("x"), p["__y"].alias("y")))
    parts = rings.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("ring", as_vertices.alias("points")))).alias("__part"))
    as_rings = F.transform("__part", lambda r: r["points"])
    shapes = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", as_rings.alias("rings")))).alias("__shape"))
    shapes = shapes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.transform("__shape", lambda p: p["rings"]).alias("__moved"))
    same = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = df.join(shapes, same, "left")
    return joined.select(*[F.coalesce("__moved", F.col(c)).alias(c) if c == shape else F.col(c) for c in df.columns])
