"""Zones of places against plain ray crossing."""

from __future__ import annotations

import random

import pytest

from aerolog.operators import zones

VERTEX = "zone string, ring int, seq int, lon double, lat double"


def vertices(spark, rings):
    """``rings``: (zone, ring, [(lon, lat), ...])."""
    return spark.createDataFrame([(z, r, k, float(x), float(y)) for z, r, points in rings for k, (x, y) in enumerate(points)], VERTEX)


def unrolled(points):
    out, turn = [], 0
    for k, (x, y) in enumerate(points):
        if k and x - points[k - 1][0] > 180:
            turn -= 360
        elif k and x - points[k - 1][0] < -180:
            turn += 360
        out.append((x + turn, y))
    return out


def plain(rings, lon, lat):
    """The lowest zone whose edges a ray to the east crosses an odd number of times."""
    if lon is None or lat is None:
        return None
    inside = set()
    for zone in {z for z, _, _ in rings}:
        for turn in (-360, 0, 360):
            x, n = (lon + 180) % 360 - 180 + turn, 0
            for _, _, points in (r for r in rings if r[0] == zone):
                points = unrolled(points)
                for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
                    n += (y1 > lat) != (y2 > lat) and x < (x2 if lat == y2 else x1 + (lat - y1) * (x2 - x1) / (y2 - y1))
            if n % 2:
                inside.add(zone)
    return min(inside, default=None)


def check(spark, rings, places, cell):
    df = spark.createDataFrame([(k, *(None if c is None else float(c) for c in (lat, lon))) for k, (lon, lat) in enumerate(places)], "station_id long, lat double, lon double")
    got = {r["station_id"]: r["zone"] for r in zones.with_zone(df, zones.zone_cells(vertices(spark, rings), cell), cell, ["station_id"]).collect()}
    want = {k: plain(rings, *p) for k, p in enumerate(places)}
    assert got == want
    return want


SQUARES = [("b", 0, [(0, 0), (4, 0), (4, 4), (0, 4)]), ("a", 0, [(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]),
           ("b", 1, [(1, 1), (3, 1), (3, 3), (1, 3)]), ("c", 0, [(2, 6), (6, 6), (4, 9)]), ("d", 0, [(3, 6), (7, 6), (5, 9)])]


@pytest.mark.parametrize("cell", [0.5, 1.0, 2.0, 45.0])
def test_holes_shared_borders_and_overlaps(spark, cell):
    grid = [(x / 2, y / 2) for x in range(-1, 18) for y in range(-1, 20)]
    want = check(spark, SQUARES, [*grid, (None, 1.0), (1.0, None), (2.0, 2.0), (4.5, 7.0), (1e-12, 2.5)], cell)
    assert want[grid.index((4.0, 2.0))] == "a"  # the border of b and a: east of it
    assert want[grid.index((2.0, 2.0))] is None  # the hole
    assert set(want.values()) == {"a", "b", "c", "d", None}


@pytest.mark.parametrize("seed", range(3))
def test_random_stars(spark, seed):
    draw = random.Random(seed)
    rings = []
    for z in range(6):
        x0, y0, corners = draw.uniform(-9, 9), draw.uniform(-9, 9), []
        for k in range(draw.choice([3, 9, 40])):
            corners.append((round(x0 + draw.uniform(-6, 6), draw.choice([0, 1, 6])), round(y0 + draw.uniform(-6, 6), draw.choice([0, 1, 6]))))
        rings.append((f"z{z}", 0, corners))  # edges may cross each other
    places = [(round(draw.uniform(-16, 16), d), round(draw.uniform(-16, 16), d)) for d in (0, 1, 5) for _ in range(400)]
    places += [p for _, _, points in rings for p in points]
    check(spark, rings, places, draw.choice([0.5, 1.0, 3.0]))


def test_antimeridian(spark):
    rings = [("fiji", 0, [(177, -20), (-178, -20), (-178, -15), (177, -15)]), ("west", 0, [(-178, -20), (-170, -20), (-170, -15), (-178, -15)]),
             ("round", 0, [(-179, 5), (179, 5), (178, 8), (-178, 8)])]
    places = [(x, y) for x in (176, 177.5, 179.5, 180, -180, -179.5, -178, -177, -169, 182, 540, -541) for y in (-17.5, 6.0, 7.9, 0)]
    want = check(spark, rings, places, 1.0)
    assert {"fiji", "west", "round", None} == set(want.values())


def test_no_zones_and_no_places(spark):
    none = spark.createDataFrame([], VERTEX)
    places = spark.createDataFrame([(1, 2.0, 3.0)], "station_id long, lat double, lon double")
    assert [r["zone"] for r in zones.with_zone(places, zones.zone_cells(none), keys=["station_id"]).collect()] == [None]
    assert zones.with_zone(places.where("false"), zones.zone_cells(vertices(spark, SQUARES)), keys=["station_id"]).count() == 0
    with pytest.raises(ValueError):
        zones.zone_cells(none, 0.7)


def test_places_meet_cells_by_key(spark):
    places = spark.createDataFrame([(1, 2.0, 3.0)], "station_id long, lat double, lon double")
    plan = zones.with_zone(places, zones.zone_cells(vertices(spark, SQUARES)), keys=["station_id"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
