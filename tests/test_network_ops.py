"""Circles, elevation, design conditions, as-of alignment, rollups and hourly streams against plain versions."""

from __future__ import annotations

import datetime as dt
import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from aerolog.operators import compare, design, elevation, resample, urban, zones
from aerolog.plans import indicators, weather_file
from aerolog.sources import point_store, rollup_store, station_json
from aerolog.streaming.landing import hourly_stream

ID = ["station_id"]


def km(a, b):
    (la, lo), (lb, lp) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6373.0 * math.asin(min(1, math.sqrt(h)))


def test_circles_meet_all_stations_inside(spark):
    draw = random.Random(1)
    places = [(k, draw.uniform(-90, 90), draw.uniform(-180, 180)) for k in range(600)] + [(900, 90.0, 0.0), (901, -90.0, 5.0), (902, 10.0, 180.0), (903, 10.0, -180.0), (904, None, 1.0), (905, 1.0, None)]
    circles = [(k, draw.uniform(-90, 90), draw.uniform(-180, 180), 10 ** draw.uniform(0, 4.4)) for k in range(60)]
    circles += [(70, 89.9, 10.0, 300.0), (71, 10.0, 179.99, 500.0), (72, 10.0, -180.0, 0.0), (73, 0.0, 0.0, 30_000.0), (74, 90.0, 0.0, 1.0), (75, None, 0.0, 5.0), (76, 5.0, 5.0, None)]
    out = urban.in_circles(spark.createDataFrame(places, "station_id long, lat double, lon double"),
                           spark.createDataFrame(circles, "circle long, lat double, lon double, radius_km double"), ID)
    got = [(r["circle"], r["station_id"]) for r in out.collect()]
    want = {(c, s) for c, la, lo, r in circles if None not in (la, lo, r) for s, a, b in places if None not in (a, b) and km((la, lo), (a, b)) <= r - 1e-6}
    near = {(c, s) for c, la, lo, r in circles if None not in (la, lo, r) for s, a, b in places if None not in (a, b) and km((la, lo), (a, b)) <= r + 1e-6}
    assert len(got) == len(set(got)) and want <= set(got) <= near and len(want) > 3000
    assert {s for c, s in got if c == 73} == {s for s, a, b in places if None not in (a, b)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_gaps_of_circles_are_those_of_one(spark):
    draw = random.Random(2)
    places = spark.createDataFrame([(f"s{k}", 45 + draw.random(), 7 + draw.random()) for k in range(40)], "station_id string, lat double, lon double")
    hourly = spark.createDataFrame([(f"s{draw.randrange(42)}", dt.datetime(2023, 1, 1, draw.randrange(24)), draw.choice([None, draw.uniform(0, 9)])) for _ in range(900)],
                                   "station_id string, ts timestamp_ntz, t_db double")
    circles = spark.createDataFrame([(1, 45.5, 7.5, 20.0), (2, 45.4, 7.4, 35.0), (3, 0.0, 0.0, 9.0), (4, 45.0, 7.0, 9000.0)], "circle int, lat double, lon double, radius_km double")
    got = {(r["circle"], r["hour"]): r for r in urban.circle_gaps(hourly, places, circles, F.hour("ts"), "hour", keys=ID).collect()}
    for number, lat, lon, radius in ((1, 45.5, 7.5, 20.0), (2, 45.4, 7.4, 35.0), (4, 45.0, 7.0, 9000.0)):
        one = urban.zone_gap(hourly, urban.zones(places, (lat, lon), radius, ID), F.hour("ts"), "hour", keys=ID)
        for r in one.collect():
            if r["urban"] is not None:
                assert got[number, r["hour"]]["urban"] == pytest.approx(r["urban"]) and got[number, r["hour"]]["gap"] == (None if r["gap"] is None else pytest.approx(r["gap"]))
    assert 3 not in {c for c, _ in got}


def test_elevation_over_tiles_and_missing_nodes(spark):
    nodes = {(i, j): 100 + 7 * i + 3 * j + i * j for i in range(-5, 9) for j in range(-5, 9) if (i, j) != (2, 2)}
    raster = spark.createDataFrame([(i, j, float(h)) for (i, j), h in nodes.items()] + [(0, 0, 100.0), (20, 20, None)], "i int, j int, elevation double")
    draw = random.Random(3)
    spots = [(draw.uniform(-6, 9), draw.uniform(-6, 9)) for _ in range(300)] + [(float(i), float(j)) for i in range(-6, 10) for j in (-5, 3, 4, 8)] + [(2.0, 2.0), (2.5, 3.0), (1.5, 2.0), (8.0, 8.0)]
    places = spark.createDataFrame([(k, 10 + y / 2, 20 + x / 2) for k, (x, y) in enumerate(spots)] + [(9999, None, 1.0)], "station_id long, lat double, lon double")

    def plain(x, y):
        i, j, total = math.floor(x), math.floor(y), 0.0
        for a in (0, 1):
            for b in (0, 1):
                w = (x - i if a else 1 - x + i) * (y - j if b else 1 - y + j)
                if w > 0:
                    if (i + a, j + b) not in nodes:
                        return None
                    total += w * nodes[i + a, j + b]
        return total

    for tile in (4, 64):
        out = elevation.with_elevation(places, elevation.tiled(raster, tile), (10.0, 20.0), 0.5, tile, ID)
        got = {r["station_id"]: r["elevation"] for r in out.collect()}
        assert got.pop(9999) is None
        for k, (x, y) in enumerate(spots):
            x, y = ((20 + x / 2) - 20) / 0.5, ((10 + y / 2) - 10) / 0.5
            want = plain(x, y)
            assert got[k] == (None if want is None else pytest.approx(want)), (x, y)
    stations = places.limit(3).withColumn("elevation", F.when(F.col("station_id") == 0, 77))
    assert 77 in {r["elevation"] for r in weather_file.with_raster_elevation(stations, elevation.tiled(raster), (10.0, 20.0), 0.5, ID).collect()}


def hours(spark, stations=3, years=(2001, 2002), seed=4):
    draw, rows = random.Random(seed), []
    for s in range(stations):
        t = dt.datetime(years[0], 1, 1)
        while t.year <= years[1]:
            rows.append((f"s{s}", t, draw.choice([None, float("nan")]) if draw.random() < 0.02 else round(10 - 12 * math.cos(t.timetuple().tm_yday / 58) + draw.gauss(0, 3), draw.choice([0, 1, 5])),
                         round(draw.uniform(20, 100), 1), draw.choice([None, round(draw.uniform(0, 9), 1)])))
            t += dt.timedelta(hours=draw.choice([1, 5, 30]))
    rows.append(("empty", dt.datetime(2001, 1, 1), None, None, None))
    return rows, spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, t_db double, rh double, v_air double")


@pytest.mark.parametrize("cold", [True, False])
def test_design_values_are_exact_quantiles(spark, cold):
    rows, df = hours(spark)
    shares = (0.0, 0.004, 0.01, 0.5, 0.999)
    found = design.exceeded(df, "t_db", shares, ID, cold)
    got = {(r["station_id"], r["share"]): r["value"] for r in found.collect()}
    series = {s: [(t, v) for n, _, t, _, v in rows if n == s and t is not None and t == t] for s in {r[0] for r in rows}}
    want = {(s, p): sorted((t for t, _ in own), reverse=not cold)[math.floor(len(own) * p)] for s, own in series.items() if own for p in shares}
    assert got == want
    for r in design.coincident(df, "t_db", found, ["v_air"], ID).collect():
        near = [v for t, v in series[r["station_id"]] if abs(t - r["value"]) <= 0.5 and v is not None]
        assert r["v_air"] == (pytest.approx(sum(near) / len(near)) if near else None)
    assert design.exceeded(df.where("false"), "t_db", shares, ID).count() == 0


def test_no_task_gathers_a_series(spark):
    """One station holds nearly all hours: what leaves a task is its bins, not its hours."""
    df = spark.range(200_000).select(F.lit("a").alias("station_id"), (F.col("id") % 997 / 10).alias("t_db"))
    out = design.exceeded(df, "t_db", (0.004,), ID)
    assert [(r["value"]) for r in out.collect()] == [sorted((k % 997 / 10 for k in range(200_000)), reverse=True)[800]]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "percentile" not in plan and "partial_count" in plan


def test_months_extremes_and_the_header_line(spark):
    rows, df = hours(spark)
    df = df.where("not isnan(t_db)")
    month = {r["station_id"]: r for r in design.months(df, keys=ID).collect()}
    ends = {r["station_id"]: r for r in design.extremes(df, keys=ID).collect()}
    own = [(ts, t) for s, ts, t, _, _ in rows if s == "s1" and t is not None and t == t]
    mean = {m: [t for ts, t in own if ts.month == m] for m in range(1, 13)}
    mean = {m: sum(v) / len(v) for m, v in mean.items()}
    assert month["s1"]["coldest_month"] == min(mean, key=mean.get) and month["s1"]["hottest_month"] == max(mean, key=mean.get)
    lows = [min(t for ts, t in own if ts.year == y) for y in (2001, 2002)]
    deviation = abs(lows[0] - lows[1]) / math.sqrt(2)
    factor = -math.sqrt(6) / math.pi * (0.5772 + math.log(math.log(20 / 19)))
    assert ends["s1"]["min_mean"] == pytest.approx(sum(lows) / 2) and ends["s1"]["min_20"] == pytest.approx(sum(lows) / 2 - factor * deviation)
    stations = spark.createDataFrame([("s0", None), ("s1", "DESIGN CONDITIONS,1,own"), ("empty", None), ("none", None)], "station_id string, design_conditions string")
    lines = {r["station_id"]: r["design_conditions"] for r in weather_file.with_design_conditions(stations, df, ID).collect()}
    assert lines["s1"].endswith(",own") and lines["none"] is None
    assert lines["s0"].startswith("DESIGN CONDITIONS,1,Computed from hourly values,,Heating,") and ",Cooling," in lines["s0"]
    parts = lines["s0"].split(",")
    assert (parts.index("Cooling"), parts.index("Extremes"), len(parts)) == (20, 53, 70) and "nan" not in lines["s0"].lower()
    warm = sorted((t for s, _, t, _, _ in rows if s == "s0" and t is not None and t == t), reverse=True)
    assert parts[23] == f"{warm[math.floor(len(warm) * 0.004)]:.1f}" and parts[6] == f"{warm[-1 - math.floor(len(warm) * 0.004)]:.1f}"
    assert parts[19] == "" and parts[36] == ""  # no directions


def test_as_of_looks_back_by_key(spark):
    draw = random.Random(6)
    moment = lambda: None if draw.random() < 0.03 else dt.datetime(2023, 1, 1) + dt.timedelta(minutes=draw.randrange(0, 8 * 1440, 30))
    left = [(k, draw.choice(["a", "b", None]), moment(), 1.0) for k in range(400)]
    right = [(draw.choice(["a", "b", None]), moment(), float(k)) for k in range(60)] + [("a", dt.datetime(2023, 1, 2), 5.0), ("a", dt.datetime(2023, 1, 2), 7.0)]
    l = spark.createDataFrame(left + left[:3], "n long, station_id string, ts timestamp_ntz, x double")  # noqa: E741
    r = spark.createDataFrame(right, "station_id string, ts timestamp_ntz, y double")
    for limit in (0.0, 6.0, 24.0, 60.0):
        out = compare.as_of(l, r, ID, ["y"], limit)
        assert out.columns == ["n", "station_id", "ts", "x", "ts_right", "y"] and out.count() == 403
        for row in out.collect():
            earlier = [(t, y) for s, t, y in right if s == row["station_id"] and None not in (t, row["ts"]) and t <= row["ts"] and (row["ts"] - t).total_seconds() <= limit * 3600]
            assert (row["ts_right"], row["y"]) == (max(earlier) if earlier else (None, None))
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_files_meet_their_own_stations(spark):
    points = spark.createDataFrame([("n", s, None, None, dt.datetime(2023, 1, 1, h, 30), "t_db", float(h + k)) for k, s in enumerate("abc") for h in range(20)],
                                   "source string, station_id string, lat double, lon double, ts timestamp_ntz, field string, value double")
    files = spark.createDataFrame([(f, dt.datetime(2023, 1, 1, h + 1), float(h + n)) for n, f in enumerate(["x", "y"]) for h in range(20)], "file string, ts timestamp_ntz, dry_bulb_temperature double")
    pairs = spark.createDataFrame([("x", "n", "a"), ("x", "n", "c"), ("y", "n", "a"), ("y", "n", "a"), ("y", "n", "gone")], "file string, source string, station_id string")
    span = (F.lit("2022-01-01").cast("timestamp_ntz"), F.lit("2024-01-01").cast("timestamp_ntz"))
    out = {(r["file"], r["station_id"]): r["bias"] for r in indicators.weather_file_against_station(files, points, *span, files=["file"], pairs=pairs).collect()}
    assert out == {("x", "a"): pytest.approx(0), ("x", "c"): pytest.approx(-2), ("y", "a"): pytest.approx(1)}


def test_fields_are_found_by_name(spark):
    at = dt.datetime(2023, 1, 1, 5)
    rows = [("a", at + dt.timedelta(minutes=m), f, v) for m, f, v in [(1, "bright_N", 1.0), (9, "bright_N", 2.0), (2, "Very_BRIGHT", 5.0), (3, "t_db", 7.0), (61, "bright_E", 3.0), (4, "rain_type", 51.0), (5, "dark", 1.0)]]
    out = resample.hourly_multi_agg(spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, field string, value double"), mean=["t_db"], mode_nonzero=["rain_type"], keys=ID, found="Bright")
    assert {r["ts"].hour: (r["t_db"], r["rain_type"], r["others"]) for r in out.collect()} == {
        5: (7.0, 51.0, {"bright_N": 1.5, "Very_BRIGHT": 5.0}), 6: (None, 0.0, {"bright_E": 3.0})}


POINT = "source string, station_id string, lat double, lon double, ts timestamp_ntz, field string, value double"


def batch(draw, n):
    return [("net", f"s{draw.randrange(30)}", 1.0, 2.0, dt.datetime(2023, draw.choice([1, 2]), draw.randrange(1, 28), draw.randrange(24), draw.randrange(60)), draw.choice(["t_db", "rh"]),
             round(draw.uniform(-5, 30), 3)) for _ in range(n)]


def rollup_rows(spark, path):
    return {(r["source"], r["station_id"], r["field"], r["hour"]): (r["total"], r["n"]) for r in rollup_store.read_rollup(spark, path).collect()}


def test_rollup_follows_upserts_exactly(spark, tmp_path):
    draw = random.Random(7)
    store, rollup, afresh = (str(tmp_path / x) for x in ("store", "rollup", "afresh"))
    first = batch(draw, 900)
    changed = [(*r[:6], r[6] + 1) for r in first[::3]] + batch(draw, 100)
    older = [(*r[:6], -99.0) for r in first[::5]] + batch(draw, 50)
    again = changed[:40] + changed[:40] + [(*r[:6], None) for r in first[1:4]]
    for rows, day in ((first, 2), (changed, 3), (older, 1), (again, 4), ([], 5)):
        rollup_store.write_points(spark.createDataFrame(rows, POINT), store, rollup, F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz"))
        rollup_store.rebuild(spark, store, afresh)
        assert rollup_rows(spark, rollup) == rollup_rows(spark, afresh)
    assert len(rollup_rows(spark, rollup)) > 900


def files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_a_late_document_rewrites_one_bucket_of_one_month(spark, tmp_path):
    store = str(tmp_path / "store")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    point_store.write_points(spark.createDataFrame(batch(random.Random(8), 2000), POINT), store, stamp)
    before = files(store)
    late = spark.createDataFrame([("net", "s7", 1.0, 2.0, dt.datetime(2023, 2, 3, 4, 5), "t_db", 1.5)], POINT)
    point_store.write_points(late, store, stamp)
    after = files(store)
    changed = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert len(changed) == 1 and "month=2/bucket=" in changed.pop() and len({os.path.dirname(f) for f in before}) > 15
    one = point_store.read_points(spark, store, dt.datetime(2023, 2, 1), dt.datetime(2023, 3, 1), "net", ["s7"])
    assert one.where("value = 1.5").count() == 1 and one.select("station_id").distinct().count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def document(station, when, t):
    return json.dumps({"observations": [{"stationID": station, "obsTimeUtc": when, "lat": 45.0, "lon": 7.0, "humidityAvg": 50.0, "metric": {"tempAvg": t}}]})


def test_hourly_stream_equals_the_batch(spark, tmp_path):
    landing, store, progress = tmp_path / "landing", str(tmp_path / "hours"), str(tmp_path / "progress")
    landing.mkdir()
    draw = random.Random(9)
    lines = [document(draw.choice("ab"), f"2023-03-{draw.randrange(1, 29):02d}T{draw.randrange(24):02d}:{m:02d}:00Z", float(m)) for m in range(60) for _ in range(4)]
    parts = [lines[:100], lines[100:180], lines[50:120], lines[180:], lines[:100]]  # repeated and late ones among them
    for k, own in enumerate(parts):
        (landing / f"{k}.json").write_text("\n".join(own) + "\nnot json\n")
        hourly_stream(spark, str(landing), store, progress).awaitTermination()
    points = station_json.station_points(station_json.parse_documents(spark.createDataFrame([(x,) for x in lines], "value string"), "value"))
    once = points.dropDuplicates(["station_id", "field", "ts"])
    same = points.groupBy("station_id", "field", "ts").agg(F.countDistinct("value").alias("n"))
    plain = {(r["station_id"], r["field"], r["ts"]) for r in same.where("n > 1").collect()}
    want = {(r["station_id"], r["field"], r["hour"]): r["value"] for r in resample.hourly_mean(once, ID).collect()}
    got = {(r["station_id"], r["field"], r["ts"]): r["value"] for r in point_store.read_points(spark, store).collect()}
    assert not plain and set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)


def test_zones_fill_missing_time_zones(spark):
    ring = [("Europe/Rome", 0, k, x, y) for k, (x, y) in enumerate([(6.0, 44.0), (9.0, 44.0), (9.0, 47.0), (6.0, 47.0)])]
    cells = zones.zone_cells(spark.createDataFrame(ring, "zone string, ring int, seq int, lon double, lat double"))
    stations = spark.createDataFrame([("a", 45.0, 7.0, None), ("b", 45.0, 7.0, "Own/Zone"), ("c", 0.0, 0.0, None)], "station_id string, lat double, lon double, tz string")
    assert {r["station_id"]: r["tz"] for r in weather_file.with_time_zone(stations, cells, ID).collect()} == {"a": "Europe/Rome", "b": "Own/Zone", "c": None}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_series_by_station_stay_where_they_are(spark):
    """A table in buckets of stations: neither the ranking nor the gathering of a typical year moves it."""
    from aerolog.operators import typical_year
    from aerolog.session import bucketed

    days = spark.range(3 * 730).select((F.col("id") % 3).cast("string").alias("station_id"), (F.lit("2001-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days=(F.col("id") / 3).cast("int"))).alias("ts"), (F.col("id") % 17).cast("double").alias("t_db"))
    series = bucketed(days.select("*", *(F.col("t_db").alias(c) for c in ("ghi", "rh", "v_air"))), ID)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(resample.daily_mean(series, ["t_db"], ID)) == 0
        chosen = spark.createDataFrame([(str(s), m, 2001 + (s + m) % 2) for s in range(3) for m in range(1, 13)], "station_id string, month int, chosen_year int")
        rows = typical_year.typical_rows(series, chosen, ["t_db"], ID)
        assert exchanges(rows) == 1  # the choice alone
        assert rows.count() == 3 * 365
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_exchange_serves_the_weather_file(spark):
    """Gap filling, interpolation and sun all go by station."""
    rows = spark.range(48).select(F.lit("a").alias("station_id"), (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
                                  *(F.lit(1.0).alias(c) for c in ("v_air", "wind_dir", "t_db", "t_dp", "rh", "p_atm", "rain", "rain_type", "ghi")))
    places = spark.createDataFrame([("a", 45.0, 7.0, "Europe/Rome")], "station_id string, lat double, lon double, tz string")
    assert exchanges(weather_file.derive(rows, places, ID)) <= 3
