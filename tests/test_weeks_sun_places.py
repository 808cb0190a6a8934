import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from aerolog.operators import compare, nearest, radiation, urban, weeks

KEY = ["station_id"]


def week_by_loops(values, season_days, stretches, target):
    best, end = math.inf, None
    for stretch in stretches:
        for i in range(6, len(stretch)):
            week = [values.get(d) for d in stretch[i - 6:i + 1]]
            if None in week:
                continue
            distance = round(abs(np.mean(week) - target), 9)
            if distance < best:
                best, end = distance, stretch[i]
    return end


def test_weeks_against_loops(spark):
    rng = np.random.default_rng(7)
    every = [d.date() for d in pd.date_range("2023-01-01", "2023-12-31")]
    values = {d: round(float(rng.normal(12, 8)), 2) for d in every if rng.random() > 0.02}
    rows = spark.createDataFrame([("a", d, t) for d, t in values.items()], "station_id string, day date, t_db double")
    got = {r.season: r for r in weeks.season_weeks(rows, keys=KEY).collect()}
    seasons = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}
    for name, months in seasons.items():
        inside = [d for d in every if d.month in months]
        stretches = [[d for d in inside if d.month < 12], [d for d in inside if d.month == 12]]
        known = [values[d] for d in inside if d in values]
        assert got[name].typical_end == week_by_loops(values, inside, stretches, np.mean(known))
        assert got[name].typical_start == got[name].typical_end - dt.timedelta(days=6)
        if name in ("summer", "winter"):
            target = max(known) if name == "summer" else min(known)
            assert got[name].extreme_end == week_by_loops(values, inside, stretches, target)
        else:
            assert got[name].extreme_end is None
    line = weeks.weeks_line(weeks.season_weeks(rows, keys=KEY), KEY).first().line
    e = got["summer"].extreme_end
    s = got["summer"].extreme_start
    assert line.startswith("TYPICAL/EXTREME PERIODS,6,Summer - Week Nearest Max Temperature For Period,Extreme,"
                           f"{s.month}/{s.day},{e.month}/{e.day},Summer")
    assert line.count(",") == 1 + 6 * 4


def test_season_scalars(spark):
    rows = spark.createDataFrame([("a", dt.date(2023, 1, 1), -3.0), ("a", dt.date(2023, 12, 1), 5.0)],
                                 "station_id string, day date, t_db double")
    assert tuple(weeks.season_scalars(rows, keys=KEY).first()) == ("a", 2023, "winter", 5.0, -3.0, 1.0)


def hours(spark, n=24 * 10):
    i = F.col("id").cast("int")
    return spark.range(n).select(
        F.lit("a").alias("station_id"),
        (F.lit("2023-06-01").cast("timestamp_ntz") + F.make_dt_interval(hours=i)).alias("ts"),
        F.greatest(F.lit(0.0), 700 * F.sin(math.pi * (i % 24 - 6) / 12) * (0.6 + 0.4 * F.sin(i * 1.0))).alias("ghi"),
        F.lit(45.07).alias("lat"), F.lit(7.69).alias("lon"), F.lit("Europe/Rome").alias("tz"),
        (15 + i % 24 / 2).alias("t_db"), F.lit(60.0).alias("rh"))


def test_split_conserves_radiation(spark):
    rows = radiation.split(hours(spark), KEY).orderBy("ts").collect()
    assert rows[0].dif is None and rows[-1].dni is None
    sun = {r.ts: r.sun.altitude for r in radiation.with_sun(hours(spark)).collect()}
    inside = [r for r in rows[1:-1] if r.ghi > 0 and 0 < r.dni < 1366]
    assert len(inside) > 50
    for r in inside:
        assert r.dif + r.dni * math.sin(sun[r.ts]) == pytest.approx(r.ghi, abs=1e-6)
    assert all(0 <= r.kt <= 0.8 for r in rows)
    assert all((r.dif, r.dni) == (0, 0) for r in rows[1:-1] if r.ghi == 0)


def test_day_clearness_matches_the_aggregate(spark):
    from_split = {(r.d, round(r.kt_d, 12)) for r in radiation.split(hours(spark), KEY, clock="as_stored", label="start").select(
        F.col("ts").cast("date").alias("d"), "kt_d").distinct().collect()}
    aggregate = {(r.day, round(r.kt_d, 12)) for r in radiation.daily_clearness(
        radiation.with_sun(hours(spark), clock="as_stored", label="start"), KEY).collect()}
    assert from_split == aggregate


def test_clocks(spark):
    stored = radiation.with_sun(hours(spark, 24), clock="as_stored").orderBy("ts").collect()
    local = radiation.with_sun(hours(spark, 24), clock="local").orderBy("ts").collect()
    assert [r.sun.solar_time for r in local][1:21] == pytest.approx([r.sun.solar_time + 2 for r in stored][1:21])
    with pytest.raises(ValueError):
        radiation.with_sun(hours(spark, 24), clock="solar")


@pytest.mark.parametrize("tz, lon", [("Asia/Kolkata", 82.5), ("Europe/London", 0.0), ("America/Denver", -105.0)])
@pytest.mark.parametrize("label", ["end", "start"])
def test_the_sun_peaks_at_solar_noon(spark, tz, lon, label):
    rows = hours(spark, 48).withColumns({"tz": F.lit(tz), "lon": F.lit(lon), "lat": F.lit(30.0)})
    top = max(radiation.with_sun(rows, label=label).collect(), key=lambda r: r.sun.altitude)
    middle = top.ts.hour + (-0.5 if label == "end" else 0.5)
    away = (middle - (12 - lon / 15) + 12) % 24 - 12
    assert abs(away) <= 0.55  # the equation of time is two minutes in June


def test_stations_are_told_by_source_and_id(spark):
    s = spark.createDataFrame([("net", "x", 45.0, 7.0), ("grid", "x", 0.5, 7.0)], "source string, station_id string, lat double, lon double")
    r = spark.createDataFrame([("north", 45.1, 7.0), ("south", 0.4, 7.0)], "wmo string, lat double, lon double")
    got = {row.source: row.wmo for row in nearest.nearest_reference(s, r, ["source", "station_id"]).collect()}
    assert got == {"net": "north", "grid": "south"}


def test_infrared_keeps_a_measured_dew_point(spark):
    base = radiation.split(hours(spark, 24), KEY)
    computed = radiation.with_infrared(base).orderBy("ts").first()
    measured = radiation.with_infrared(base.withColumn("t_dp", F.lit(3.0))).orderBy("ts").first()
    assert measured.t_dp == 3.0 and computed.t_dp != 3.0 and measured.hiri != computed.hiri


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1)))


def check_nearest(spark, stations, refs):
    s = spark.createDataFrame([(i, *p) for i, p in enumerate(stations)], "station_id int, lat double, lon double")
    r = spark.createDataFrame([(i, *p) for i, p in enumerate(refs)], "ref int, lat double, lon double")
    got = {row.station_id: row for row in nearest.nearest_reference(s, r, "station_id", "ref").collect()}
    assert len(got) == len(stations)
    for i, p in enumerate(stations):
        best = min((round(km(p, q), 9), k) for k, q in enumerate(refs))
        assert got[i].km == pytest.approx(best[0], abs=1e-6)
        assert got[i].ref == best[1] or abs(km(p, refs[got[i].ref]) - best[0]) < 1e-8


def test_nearest_far_and_near(spark):
    rng = random.Random(11)
    sites = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    town = [(45 + rng.uniform(0, 0.2), 7 + rng.uniform(0, 0.2)) for _ in range(300)]   # one dense cell
    check_nearest(spark, sites[:100] + town[:50], sites[100:] + town[50:])
    check_nearest(spark, [(0.0, 0.0), (-89.9, 12.0)], town)        # everything far away


def test_nearest_at_the_edges(spark):
    refs = [(10.0, -179.95), (10.0, 179.0), (90.0, 0.0), (-90.0, 50.0), (0.0, 180.0)]
    check_nearest(spark, [(10.0, 179.99), (10.0, -180.0), (89.0, 170.0), (-89.9, -130.0), (0.0, -179.9)], refs)


def test_nearest_ties_take_the_lowest_key(spark):
    check_nearest(spark, [(0.0, 0.0), (1.0, 1.0)], [(1.0, 0.0), (-1.0, 0.0), (1.0, 0.0)])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-900, 900), st.integers(-1800, 1800)), min_size=2, max_size=25))
def test_nearest_property(spark, places):
    places = [(a / 10, b / 10) for a, b in places]
    check_nearest(spark, places[::2], places[1::2])


def test_urban_gap(spark):
    stations = spark.createDataFrame([("in", 45.0, 7.0), ("edge", 45.0, 7.1), ("out", 46.0, 7.0)],
                                     "station_id string, lat double, lon double")
    zones = urban.zones(stations, (45.0, 7.0), 10.0, KEY)
    assert {r.station_id: r.zone for r in zones.collect()} == {"in": "urban", "edge": "urban", "out": "suburban"}
    rows = spark.createDataFrame([("in", dt.datetime(2024, 1, 1, 5), 10.0), ("in", dt.datetime(2024, 1, 2, 5), 12.0),
                                  ("edge", dt.datetime(2024, 1, 1, 5), 20.0), ("out", dt.datetime(2024, 1, 1, 5), 4.0),
                                  ("out", dt.datetime(2024, 1, 1, 6), 4.0)],
                                 "station_id string, ts timestamp_ntz, t_db double")
    gap = {r.hour: r.gap for r in urban.zone_gap(rows, zones, F.hour("ts"), "hour", keys=KEY).collect()}
    assert gap == {5: 10.0, 6: None}


def test_pearson_and_bias(spark):
    pairs = spark.createDataFrame([("p", 1.0, 2.0), ("p", 2.0, None), ("p", None, 5.0), ("p", 4.0, 9.0)],
                                  "k string, x double, y double")
    out = compare.pearson_and_bias(pairs, "x", "y", ["k"]).first()
    assert out.r == pytest.approx(0.983835, abs=1e-6)
    assert out.bias == pytest.approx(-3.0)


def test_side_by_side(spark):
    rows = spark.createDataFrame([(1, "iso", 2.0), (1, "mean", 4.0), (2, "iso", 1.0)], "d int, method string, t double")
    out = compare.side_by_side(rows, ["d"], F.col("method"), ["iso", "mean"], F.col("t"))
    assert sorted(map(tuple, out.collect())) == [(1, 2.0, 4.0), (2, 1.0, None)]
