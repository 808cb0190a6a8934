"""The zone that holds a place: point in polygon over a grid of cells.

A zone is a set of rings, outer ones and holes alike: a place is inside if a ray from it to the east
crosses the zone's edges an odd number of times. The grid spares most of that work. A cell without edges lies
wholly inside or outside, so its key answers. A cell with edges keeps them, and whether
its north-eastern corner is inside; a place in it is linked to that corner by a path that stays in the
cell, first east, then north, and the edges which the path crosses decide. Places meet cells by an
equi-join on the cell, and all of it is built-in expressions.

A place on an edge belongs to the zone that lies to the east of it, or to the north of a horizontal edge; where zones
overlap, the lowest key wins. Places without coordinates or outside of all zones have no zone.
Rings may cross the 180th meridian (neighbouring vertices are taken to be less than 180 degrees apart); a zone around a pole
must be drawn along that meridian to the pole. A ring needs no repeated last vertex.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import KEYS

#: Degrees of a cell; it must divide 360.
CELL = 1.0
#: Part of a cell by which edges near its border count for the neighbour, too. Edges a cell does not need change nothing.
MARGIN = 1e-9


def edges(vertices: DataFrame) -> DataFrame:
    """(zone, x1, y1, x2, y2) from vertices (zone, ring, seq, lon, lat), each ring unrolled over the 180th meridian."""
    around = Window.partitionBy("zone", "ring").orderBy("seq")
    jump = F.col("lon") - F.lag("lon").over(around)
    turn = F.when(jump > 180, -360.0).when(jump < -180, 360.0).otherwise(0.0)
    unrolled = vertices.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn("_turn", turn).withColumn(
        "x1", F.col("lon") + F.sum("_turn").over(around))
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return unrolled.select(
        "zone", "x1", F.col("lat").cast("double").alias("y1"),
        F.coalesce(F.lead("x1").over(around), F.first("x1").over(whole)).alias("x2"),
        F.coalesce(F.lead("lat").over(around), F.first("lat").over(whole)).cast("double").alias("y2"))


def _x_at(y: Column, e: Column | None = None) -> Column:
    """Where an edge is at a latitude, exact at its ends; null for horizontal edges."""
    x1, y1, x2, y2 = ((e[c] if e is not None else F.col(c)) for c in ("x1", "y1", "x2", "y2"))
    return F.when((y == y2) & (y1 != y2), x2).otherwise(x1 + F.try_divide((y - y1) * (x2 - x1), y2 - y1))


def _corners(sides: DataFrame, cell: float) -> DataFrame:
    """(zone, i, k) of the grid's corners inside a zone, as the cells (i - 1, k - 1) to their south-west."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    crossed = sides.withColumn("k", F.explode(F.when(F.ceil(low / cell) < F.ceil(high / cell), F.sequence(F.ceil(low / cell), F.ceil(high / cell) - 1))))
    line = F.col("k") * cell
    crossings = crossed.where((F.col("y1") > line) != (F.col("y2") > line)).select("zone", "k", _x_at(line).alias("x"))
    along = Window.partitionBy("zone", "k").orderBy("x")
    spans = crossings.select("zone", "k", "x", F.lead("x").over(along).alias("to"), F.row_number().over(along).alias("n")).where("n % 2 = 1")
    corner = spans.select("zone", "k", "x", "to", F.explode(F.sequence(F.ceil(F.col("x") / cell) - 1, F.ceil(F.col("to") / cell) + 1)).alias("i"))
    return corner.where((F.col("i") * cell >= F.col("x")) & (F.col("i") * cell < F.col("to"))).select(
        "zone", (F.col("i") - 1).alias("i"), (F.col("k") - 1).alias("j"))


def zone_cells(vertices: DataFrame, cell: float = CELL) -> DataFrame:
    """(i, j, shift, zone, inside, edges): the cells that a zone has a part of.

    ``inside`` tells of the north-eastern corner; ``shift`` is what to add to a longitude for zones that
    were unrolled over the 180th meridian. A cell holds the edges of one zone that touch it.
    """
    around = round(360 / cell)
    if abs(around * cell - 360) > 1e-9:
        raise ValueError("a cell must divide 360 degrees")
    sides = edges(vertices)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = sides.withColumn("j", F.explode(F.sequence(F.floor(low / cell - MARGIN), F.floor(high / cell + MARGIN))))
    # the part of the edge in this row of cells
    a = F.coalesce(_x_at(F.greatest(low, F.col("j") * cell)), "x1")
    b = F.coalesce(_x_at(F.least(high, (F.col("j") + 1) * cell)), "x2")
    touched = rows.select("zone", "j", F.struct("x1", "y1", "x2", "y2").alias("edge"),
                          F.explode(F.sequence(F.floor(F.least(a, b) / cell - MARGIN), F.floor(F.greatest(a, b) / cell + MARGIN))).alias("i"))
    none = F.lit(None).cast(touched.schema["edge"].dataType)
    both = touched.select("zone", "i", "j", "edge", F.lit(0).alias("corner")).unionByName(
        _corners(sides, cell).select("zone", "i", "j", none.alias("edge"), F.lit(1).alias("corner")))
    cells = both.groupBy("zone", "i", "j").agg(F.collect_list("edge").alias("edges"), F.max("corner").alias("inside"))
    turns = F.floor((F.col("i") + around / 2) / around)
    return cells.select((F.col("i") - turns * around).alias("i"), "j", (turns * 360.0).alias("shift"), "zone", "inside", "edges")


def _path_crossings(x: Column, y: Column, east: Column, north: Column) -> Column:
    """Edges between a place and the corner of its cell: those on the way east, and then north."""
    def crossed(e: Column) -> Column:
        x_here = _x_at(y, e)
        on_way_east = ((e["y1"] > y) != (e["y2"] > y)) & (x_here > x) & (x_here <= east)
        slope = F.try_divide(e["y2"] - e["y1"], e["x2"] - e["x1"])
        y_there = F.when(east == e["x2"], e["y2"]).otherwise(e["y1"] + F.try_divide((east - e["x1"]) * (e["y2"] - e["y1"]), e["x2"] - e["x1"]))
        def above(height: Column) -> Column:  # a rising edge through the very point passes above it  # noqa: E306
            return (y_there > height) | ((y_there == height) & (slope > 0))
        on_way_north = ((e["x1"] > east) != (e["x2"] > east)) & above(y) & ~above(north)
        return F.coalesce(on_way_east, F.lit(False)).cast("int") + F.coalesce(on_way_north, F.lit(False)).cast("int")

    return F.aggregate("edges", F.lit(0), lambda n, e: n + crossed(e))


def with_zone(places: DataFrame, cells: DataFrame, cell: float = CELL, keys: Sequence[str] = KEYS, lat: str = "lat", lon: str = "lon", out: str = "zone") -> DataFrame:
    """(keys, lat, lon, zone) of every place; equal places are looked up once."""
    x = F.pmod(F.col(lon).cast("double") + 180, F.lit(360.0)) - 180
    spots = places.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), x.alias("_x"), F.col(lat).cast("double").alias("_y")).where(
        "_x is not null and _y is not null").distinct()
    met = spots.withColumns({"i": F.floor(F.col("_x") / cell), "j": F.floor(F.col("_y") / cell)}).join(cells, ["i", "j"])
    here = F.col("_x") + F.col("shift")
    # the eastern side in the zone's own longitudes; a whole number of cells, as the corners are
    east = (F.col("i") + 1 + F.round(F.col("shift") / cell)) * cell
    crossings = _path_crossings(here, F.col("_y"), east, (F.col("j") + 1) * cell)
    inside = met.where((F.col("inside") + crossings) % 2 == 1)
    found = inside.groupBy("_lat", "_lon").agg(F.min("zone").alias("_zone"))
    return places.join(found, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left").select(*keys, lat, lon, F.col("_zone").alias(out))
