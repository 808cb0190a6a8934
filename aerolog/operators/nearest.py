"""Nearest reference station, exactly, without pairing everything with everything.

Reference stations are sorted into nested latitude-longitude cells.  Every station descends the
cells from coarse to fine: from the cells it still holds it keeps those whose nearest possible
point is not farther than the farthest possible point of the best one, and moves to their
children.  The top level is the fixed two dozen cells of the globe.  How many cells survive
depends on geometry, not on the size of either list; references of equal coordinates count as one,
and a finest cell (about two kilometres) holds few distinct places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.place import great_circle_km
from ..session import materialized

#: Cell sizes in degrees, each a multiple of the next (fixed values).
LEVELS = (60.0, 12.0, 2.0, 0.2, 0.02)
#: Slack in km for rounding errors of the bounds.
SLACK = 1e-6

_ROW = 1_000_000


def _cell(i: Column, j: Column) -> Column:
    return i * _ROW + j


def _globe(size: float) -> Column:
    """All cells of a level, with one more row for the pole itself."""
    rows, columns = int(180 // size) + 1, int(-(-360 // size))
    return F.array(*[F.lit(i * _ROW + j).cast("bigint") for i in range(rows) for j in range(columns)])


def _with_cells(refs: DataFrame, levels: Sequence[float]) -> DataFrame:
    finest = levels[-1]
    rows = refs.withColumns({
        "_i": F.floor((F.col("_rlat") + 90) / finest),
        "_j": F.floor(F.pmod(F.col("_rlon") + 180, F.lit(360.0)) / finest),
    })
    for n, size in enumerate(levels):
        step = round(size / finest)
        rows = rows.withColumns({
            f"_i{n}": F.floor(F.col("_i") / step), f"_j{n}": F.floor(F.col("_j") / step)})
        rows = rows.withColumn(f"_c{n}", _cell(F.col(f"_i{n}"), F.col(f"_j{n}")))
    return rows


def _cells_of_level(refs: DataFrame, n: int, size: float) -> DataFrame:
    """Occupied cells of a level: id, parent (itself at the top), centre and distance to the far corner."""
    parent = F.col(f"_c{max(n - 1, 0)}")
    south = F.col(f"_i{n}") * size - 90
    west = F.col(f"_j{n}") * size - 180
    clat, clon = south + size / 2, west + size / 2
    return (
        refs.select(parent.alias("_cell"), F.col(f"_c{n}").alias("_child"), f"_i{n}", f"_j{n}")
        .distinct()
        .select("_cell", "_child", clat.alias("_clat"), clon.alias("_clon"),
                F.greatest(great_circle_km(clat, clon, south, west),
                           great_circle_km(clat, clon, south + size, west)).alias("_reach"))
    )


def nearest_reference(stations: DataFrame, refs: DataFrame, station_key: str | Sequence[str] = "station_id",
                      ref_key: str = "wmo", levels: Sequence[float] = LEVELS) -> DataFrame:
    """``(station_key, ref_key, km)``: the nearest reference, on ties the lowest key.

    ``station_key`` names one column or several that tell a station together (source and id, say).
    Both inputs carry ``lat`` and ``lon`` in degrees.  Joins are plain equi-joins on cells: Spark
    broadcasts a level when its measured size allows it and shuffles it otherwise.
    """
    own = [station_key] if isinstance(station_key, str) else list(station_key)
    located = stations.where("lat is not null and lon is not null")
    held = located.select(*own, F.col("lat").alias("_slat"),
                          F.col("lon").alias("_slon")).repartition(*own)
    # written once, as every level reads it
    placed = materialized(_with_cells(
        refs.where("lat is not null and lon is not null")
        .groupBy(F.col("lat").alias("_rlat"), F.col("lon").alias("_rlon"))
        .agg(F.min(ref_key).alias(ref_key)), levels))
    held = held.withColumn("_cell", F.explode(_globe(levels[0])))
    per_station = Window.partitionBy(*own)
    for n, size in enumerate(levels):
        held = (
            held.join(_cells_of_level(placed, n, size), "_cell")
            .withColumn("_d", great_circle_km(F.col("_slat"), F.col("_slon"),
                                              F.col("_clat"), F.col("_clon")))
            .withColumn("_best", F.min(F.col("_d") + F.col("_reach")).over(per_station))
            .where(F.col("_d") - F.col("_reach") <= F.col("_best") + SLACK)
            .select(*own, "_slat", "_slon", F.col("_child").alias("_cell"))
        )
    last = len(levels) - 1
    pairs = held.join(placed.select(F.col(f"_c{last}").alias("_cell"), ref_key, "_rlat", "_rlon"), "_cell")
    km = great_circle_km(F.col("_slat"), F.col("_slon"), F.col("_rlat"), F.col("_rlon"))
    return (
        pairs.select(*own, ref_key, km.alias("_km"))
        .groupBy(*own)
        .agg(F.min_by(F.struct(F.col(ref_key).alias("ref"), F.col("_km").alias("km")),
                      F.struct(F.round("_km", 9), F.col(ref_key))).alias("_best"))
        .select(*own, F.col("_best.ref").alias(ref_key), "_best.km")
    )
