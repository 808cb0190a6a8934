import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolog.operators import points, resample

KEY = ["station_id"]


def at(text):
    return dt.datetime.fromisoformat(text)


def make_points(spark, rows):
    return spark.createDataFrame([(s, at(t), f, v) for s, t, f, v in rows],
                                 "station_id string, ts timestamp_ntz, field string, value double")


def test_right_label_and_absent_hours(spark):
    p = make_points(spark, [("a", "2024-01-01 10:05", "t_db", 1.0), ("a", "2024-01-01 10:55", "t_db", 3.0),
                            ("a", "2024-01-01 13:00", "t_db", 5.0)])
    rows = {r.hour: r.value for r in resample.hourly_mean(p, KEY).collect()}
    assert rows == {at("2024-01-01 11:00"): 2.0, at("2024-01-01 14:00"): 5.0}
    start = {r.hour for r in resample.hourly_mean(p, KEY, label="start").collect()}
    assert start == {at("2024-01-01 10:00"), at("2024-01-01 13:00")}
    with pytest.raises(ValueError):
        resample.hourly_mean(p, KEY, label="middle")


def test_last_hour_of_a_year_belongs_to_the_next(spark):
    p = make_points(spark, [("a", "2023-12-31 23:30", "t_db", 1.0), ("a", "2024-12-31 22:59", "t_db", 2.0),
                            ("a", "2024-12-31 23:00", "t_db", 3.0)])
    kept = points.in_range(p, *points.years_window(2024, 2024))
    assert [(r.ts, r.t_db) for r in resample.hourly_wide(kept, ["t_db"], KEY).orderBy("ts").collect()] == [
        (at("2024-01-01 00:00"), 1.0), (at("2024-12-31 23:00"), 2.0)]


def test_wide_equals_mean_then_pivot(spark):
    rng = random.Random(1)
    p = make_points(spark, [
        (rng.choice("ab"), f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}",
         rng.choice(["t_db", "rh"]), rng.random()) for _ in range(400)])
    wide = resample.hourly_wide(p, ["t_db", "rh"], KEY)
    pivoted = points.to_wide(resample.hourly_mean(p, KEY, out="ts"), ["t_db", "rh"], [*KEY, "ts"])
    a = wide.orderBy("station_id", "ts").toPandas()
    b = pivoted.orderBy("station_id", "ts").toPandas()[list(a.columns)]
    pd.testing.assert_frame_equal(a, b)


def test_unpivot_and_back(spark):
    nan = float("nan")
    wide = spark.createDataFrame([("a", 1, 1.0, None), ("a", 2, nan, 4.0), ("b", 1, None, nan)],
                                 "station_id string, n int, t_db double, rh double")
    long = points.to_points(wide, ["t_db", "rh"], ["station_id", "n"])
    assert sorted(tuple(r) for r in long.collect()) == [("a", 1, "t_db", 1.0), ("a", 2, "rh", 4.0)]
    back = points.to_wide(long, ["t_db", "rh"], ["station_id", "n"])
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1, 1.0, None), ("a", 2, None, 4.0)]


def test_range_is_half_open(spark):
    p = make_points(spark, [("a", f"2024-01-01 0{h}:00", "t_db", float(h)) for h in range(5)])
    chosen = points.select_points(p, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"),
                                  F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"), ["a"], ["t_db"])
    assert sorted(r.value for r in chosen.collect()) == [1.0, 2.0]


def test_latest_point_and_latest_place(spark):
    p = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 1.0), ("a", 2, 9.0), ("b", 1, 1.0), ("b", 1, 2.0)],
                              "station_id string, seq int, value double")
    assert {r.station_id: r.value for r in points.latest_points(p, F.col("seq"), KEY).collect()} == {"a": 1.0, "b": 2.0}
    moved = spark.createDataFrame([("a", 1, 45.0, 9.0), ("a", 2, 44.0, 7.0)], "station_id string, ts int, lat double, lon double")
    assert tuple(points.station_places(moved, KEY).first()) == ("a", 44.0, 7.0)


def test_multi_aggregate(spark):
    rows = []
    for field, values in {"t_db": [1, 2, 6], "rain": [0.5, 0.25], "wind_dir": [90, 45, 90, 45, 0],
                          "rain_type": [0, 0, 0, 51, 53, 53]}.items():
        rows += [("a", "2024-01-01 05:10", field, float(v)) for v in values]
    rows += [("b", "2024-01-01 05:10", "wind_dir", 10.0), ("b", "2024-01-01 05:10", "rain_type", 0.0)]
    out = resample.hourly_multi_agg(make_points(spark, rows), ["t_db"], ["rain"], ["wind_dir"], ["rain_type"], KEY)
    assert {r.station_id: tuple(r)[2:] for r in out.collect()} == {
        "a": (3.0, 0.75, 45.0, 53.0), "b": (None, 0.0, 10.0, 0.0)}


@pytest.mark.parametrize("values, std, zero", [
    ([0, 0, 1, 2, 1, 0, 0], 0, 1), ([0, 0, 0, 0], 0, 0), ([3, 2, 3, 2], 2, 2), ([5, None, None], 5, 5)])
def test_modes(spark, values, std, zero):
    df = spark.createDataFrame([("a", None if v is None else float(v)) for v in values], "station_id string, v double")
    assert tuple(resample.mode_by_group(df, "v", KEY).first()) == ("a", std, zero)


def test_days_months_years(spark):
    s = spark.createDataFrame([("a", at("2020-01-01 00:00"), 1.0), ("a", at("2020-01-01 05:00"), 3.0),
                               ("a", at("2020-01-02 00:00"), 8.0), ("a", at("2022-03-01 00:00"), 5.0)],
                              "station_id string, ts timestamp_ntz, t_db double")
    days = resample.daily_mean(s, ["t_db"], KEY)
    assert sorted(r.t_db for r in days.collect()) == [2.0, 5.0, 8.0]
    assert {(r.year, r.month): r.t_db for r in resample.monthly_mean(s, ["t_db"], KEY).collect()} == {
        (2020, 1): 4.0, (2022, 3): 5.0}
    years = resample.yearly_mean(s, ["t_db"], KEY, years=(2020, 2023))
    assert {r.year: r.t_db for r in years.collect()} == {2020: 4.0, 2021: None, 2022: 5.0, 2023: None}


def test_map_and_days(spark):
    p = make_points(spark, [("a", "2024-01-01 10:05", "t_db", 1.04), ("a", "2024-01-01 23:59", "t_db", 1.08),
                            ("a", "2024-01-02 00:00", "t_db", 7.0), ("a", "2024-01-02 00:00", "rh", 99.0)])
    assert {str(r.day): r["mean"] for r in resample.station_day_map(p, keys=KEY).collect()} == {
        "2024-01-01": 1.1, "2024-01-02": 7.0}
    assert resample.days_present(p).count() == 2
