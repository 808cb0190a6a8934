"""Elevation of a place: bilinear interpolation in a raster that is stored as tiles.

A raster is a table of nodes (i, j, elevation): node (i, j) lies at ``origin + step * (j, i)`` in degrees
of latitude and longitude. :func:`tiled` keeps ``TILE`` by ``TILE`` nodes in a row, so a scan reads few
rows and few bytes for a place. A place lies among four nodes, which can belong to four tiles; it
meets them by an equi-join on the tile, once for equal places.

A place whose node is missing, or outside the raster, has no elevation, unless that node has no weight.
Nodes given twice are averaged. Places without coordinates have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schemas import KEYS

TILE = 64


def tiled(raster: DataFrame, tile: int = TILE) -> DataFrame:
    """(tile_i, tile_j, nodes): the nodes of each tile by their number in it."""
    once = raster.groupBy("i", "j").agg(F.avg("elevation").alias("elevation")).where("elevation is not null")
    number = F.pmod(F.col("j"), F.lit(tile)) * tile + F.pmod(F.col("i"), F.lit(tile))
    return once.groupBy(F.floor(F.col("i") / tile).alias("tile_i"), F.floor(F.col("j") / tile).alias("tile_j")).agg(
        F.map_from_entries(F.collect_list(F.struct(number.cast("int"), "elevation"))).alias("nodes"))


def with_elevation(places: DataFrame, tiles: DataFrame, origin: tuple[float, float], step: float, tile: int = TILE,
                   keys: Sequence[str] = KEYS, out: str = "elevation") -> DataFrame:
    """(keys, lat, lon, elevation); ``origin`` is the (lat, lon) of node (0, 0)."""
    spots = places.select("lat", "lon").where("lat is not null and lon is not null").distinct()
    y, x = (F.col("lat") - origin[0]) / step, (F.col("lon") - origin[1]) / step
    near = spots.select("lat", "lon", F.floor(x).alias("_i"), F.floor(y).alias("_j"), (x - F.floor(x)).alias("_u"), (y - F.floor(y)).alias("_v"))
    corners = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    asked = near.withColumn("_c", corners).withColumns({"_i": F.col("_i") + F.col("_c.a"), "_j": F.col("_j") + F.col("_c.b")}).withColumn(
        "_w", F.when(F.col("_c.a") == 1, F.col("_u")).otherwise(1 - F.col("_u")) * F.when(F.col("_c.b") == 1, F.col("_v")).otherwise(1 - F.col("_v"))).where("_w > 0")
    number = (F.pmod(F.col("_j"), F.lit(tile)) * tile + F.pmod(F.col("_i"), F.lit(tile))).cast("int")
    met = asked.withColumns({"tile_i": F.floor(F.col("_i") / tile), "tile_j": F.floor(F.col("_j") / tile)}).join(tiles, ["tile_i", "tile_j"], "left")
    height = met.withColumn("_h", F.try_element_at("nodes", number)).groupBy("lat", "lon").agg(
        F.when(F.count("_h") == F.count(F.lit(1)), F.sum(F.col("_h") * F.col("_w"))).alias(out))
    return places.select(*keys, "lat", "lon").join(height, ["lat", "lon"], "left").select(*keys, "lat", "lon", out)
