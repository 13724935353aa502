"""Correction of projected points by a grid of shifts, for centimetres instead of metres.

The grid is an input: shifts in metres at the nodes of a regular grid, ``east, north`` (multiples of ``step``),
``shift_east, shift_north``. A point lies in one cell; its shift is interpolated bilinearly from the cell's four
nodes. The cells, with their four shifts each, are made from the grid once, so points meet them in one equi-join,
which Spark broadcasts if the grid is small enough.

Without a grid the closed form of :mod:`geo` stands as it is. Points outside the grid, or in a cell of which a node
is missing, get null coordinates: mixing corrected and uncorrected points would hide errors of metres.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions import geo
from cadastra.sources.staging import stage

_CORNERS = ((0, 0), (1, 0), (0, 1), (1, 1))


def cells(grid: DataFrame, step: float) -> DataFrame:
    """``__i, __j`` and the shifts ``__e00 .. __n11`` of the four nodes of every whole cell; one aggregate over the nodes."""
    nodes = grid.select(
        F.round(F.col("east") / step).cast("long").alias("i"), F.round(F.col("north") / step).cast("long").alias("j"), "shift_east", "shift_north"
    )
    # A node is a corner of four cells.
    corners = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _CORNERS])
    spread = nodes.select("*", F.explode(corners).alias("c"))
    spread = spread.select((F.col("i") - F.col("c.a")).alias("__i"), (F.col("j") - F.col("c.b")).alias("__j"), "c", "shift_east", "shift_north")
    values = []
    for a, b in _CORNERS:
        here = (F.col("c.a") == a) & (F.col("c.b") == b)
        values += [F.max(F.when(here, F.col(f"shift_{side}"))).alias(f"__{side[0]}{a}{b}") for side in ("east", "north")]
    return spread.groupBy("__i", "__j").agg(*values).dropna()


def _interpolated(side: str, east: Column, north: Column, step: float) -> Column:
    """Bilinear shift at a place, from the corners of the row's cell."""
    value = {(a, b): F.col(f"__{side}{a}{b}") for a, b in _CORNERS}
    u, v = east / step - F.col("__i"), north / step - F.col("__j")
    return (1 - u) * (1 - v) * value[0, 0] + u * (1 - v) * value[1, 0] + (1 - u) * v * value[0, 1] + u * v * value[1, 1]


def _with_cell(df: DataFrame, cell_table: DataFrame, step: float, east: Column, north: Column) -> DataFrame:
    """The frame with the cell of a place; nulls where the grid has no whole cell."""
    placed = df.withColumns({"__column": F.floor(east / step), "__row": F.floor(north / step)})
    joined = placed.join(cell_table, (F.col("__column") == F.col("__i")) & (F.col("__row") == F.col("__j")), "left")
    return joined.drop("__column", "__row")


def wgs84_to_grid(df: DataFrame, lat: str, lon: str, grid: DataFrame | None = None, step: float = 1000.0, east: str = "easting", north: str = "northing") -> DataFrame:
    """Degrees to grid metres, corrected by ``grid`` if there is one.

    With a grid the projected points are staged first: the optimizer's reasoning about a join grows
    exponentially with the chain of expressions below it.
    """
    plain = geo.wgs84_to_grid(df, lat, lon, east, north)
    if grid is None:
        return plain
    placed = _with_cell(stage(plain, "projected"), cells(grid, step), step, F.col(east), F.col(north))
    moved = {side: F.col(side) + _interpolated(side_name, F.col(east), F.col(north), step) for side, side_name in ((east, "e"), (north, "n"))}
    return placed.withColumns(moved).select(*plain.columns)


def grid_to_wgs84(
    df: DataFrame, east: str, north: str, grid: DataFrame | None = None, step: float = 1000.0, lat: str = "lat", lon: str = "long", rounds: int = 4,
) -> DataFrame:
    """Grid metres to degrees. The place before correction is approached in ``rounds``, each of which leaves of an
    error what the shifts change over its length, about a thousandth; first in the cell that the mean shift of the
    grid leads to, then in the cell found so. A place that is nearer to a missing cell than the shifts vary over the grid
    may come back null."""
    if grid is None:
        return geo.grid_to_wgs84(df, east, north, lat, lon)
    table = cells(grid, step)
    mean = {side: table.agg(F.avg(f"__{side}00")).scalar() for side in "en"}
    placed = df.withColumn("__start", F.struct((F.col(east) - mean["e"]).alias("e"), (F.col(north) - mean["n"]).alias("n")))

    def uncorrected(start: Column) -> Column:
        def nearer(place: Column, _: Column) -> Column:
            return F.struct(*[(c - _interpolated(side, place["e"], place["n"], step)).alias(side) for c, side in ((F.col(east), "e"), (F.col(north), "n"))])

        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, nearer)

    first = _with_cell(placed, table, step, F.col("__start.e"), F.col("__start.n"))
    first = first.withColumn("__place", uncorrected(F.col("__start"))).select(*df.columns, "__place")
    again = _with_cell(first, table, step, F.col("__place.e"), F.col("__place.n")).withColumn("__place", uncorrected(F.col("__place")))
    found = again.select(*df.columns, F.col("__place.e").alias("__east"), F.col("__place.n").alias("__north"))
    return geo.grid_to_wgs84(found, "__east", "__north", lat, lon).drop("__east", "__north")
