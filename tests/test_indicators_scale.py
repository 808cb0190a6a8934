"""Whole flows from points, and what happens when one station holds most of them."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from aerolog.operators import gapfill, points as pt, resample, typical_year
from aerolog.plans import indicators
from driver import views

KEY = ["station_id"]


def station_points(spark, years=(2022, 2023)):
    """Two stations, two points an hour; station b is 2 K colder and lies outside the town."""
    n = F.col("id").cast("int")
    hours = (dt.date(years[1] + 1, 1, 1) - dt.date(years[0], 1, 1)).days * 24
    return spark.range(hours).select(
        F.explode(F.array(F.lit("a"), F.lit("b"))).alias("station_id"),
        (F.lit(f"{years[0]}-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n, mins=F.lit(-15))).alias("ts"),
        (12 - 10 * F.cos(2 * 3.14159 * n / 8766) + 3 * F.sin(2 * 3.14159 * (n % 24) / 24)).alias("v"),
    ).select(F.lit("net").alias("source"), "station_id", "ts", F.lit("t_db").alias("field"),
             F.when(F.col("station_id") == "b", F.col("v") - 2).otherwise(F.col("v")).alias("value"))


def test_trends(spark):
    p = station_points(spark)
    heating = {(r.station_id, r.year): r.degree_days for r in indicators.degree_day_trend(p, 2022, 2024, True).collect()}
    cooling = {(r.station_id, r.year): r.degree_days for r in indicators.degree_day_trend(p, 2022, 2024, False).collect()}
    assert heating["b", 2022] > heating["a", 2022] > 0 and heating["a", 2024] == 0
    assert set(cooling) == {(s, y) for s in "ab" for y in (2022, 2023, 2024)}
    trend = {(r.station_id, r.year): r.t_db for r in indicators.temperature_trend(p, 2022, 2024).collect()}
    assert trend["a", 2023] - trend["b", 2023] == pytest.approx(2) and trend["a", 2024] is None


@pytest.mark.parametrize("by, parts", [("hour", 24), ("month", 12)])
def test_urban_gap(spark, by, parts):
    places = spark.createDataFrame([("net", "a", 45.0, 7.0), ("net", "b", 46.0, 7.0)],
                                   "source string, station_id string, lat double, lon double")
    gap = indicators.urban_gap(station_points(spark), places, (45.0, 7.0), 20.0, 2022, 2023, by).collect()
    assert len(gap) == parts and all(r.gap == pytest.approx(2) for r in gap)


def test_file_against_stations(spark):
    p = station_points(spark)
    hourly = indicators.hourly_years(p, 2022, 2023).where("station_id = 'a'")
    file = hourly.select("ts", (F.col("t_db") + 1).alias("dry_bulb_temperature"))
    out = {r.station_id: r for r in indicators.weather_file_against_station(
        file, p, *pt.years_window(2022, 2023)).collect()}
    assert out["a"].bias == pytest.approx(1) and out["a"].r == pytest.approx(1)
    assert out["b"].bias == pytest.approx(3)


def test_several_files_stay_apart(spark):
    p = station_points(spark)
    hourly = indicators.hourly_years(p, 2022, 2023).where("station_id = 'a'")
    files = hourly.select("ts", F.explode(F.array(F.lit(1), F.lit(5))).alias("file"), "t_db").select(
        "file", "ts", (F.col("t_db") + F.col("file")).alias("dry_bulb_temperature"))
    years = pt.years_window(2022, 2023)
    out = {(r.station_id, r.file): r for r in indicators.weather_file_against_station(files, p, *years, files=["file"]).collect()}
    assert [out["a", k].bias for k in (1, 5)] == pytest.approx([1, 5]) and out["a", 5].r == pytest.approx(1)
    with pytest.raises(Exception, match="an hour twice"):
        indicators.weather_file_against_station(files, p, *years).collect()


def test_degree_hours_by_method(spark):
    rows = spark.createDataFrame([("net", "a", "iso", 20.0), ("net", "a", "mean", 25.0)],
                                 "source string, station_id string, method string, t_db double")
    got = {(r.method, r.threshold): r.degree_hours for r in indicators.degree_hours_by_method(rows, False).collect()}
    assert got["iso", 18] == 2 and got["mean", 24] == 1 and len(got) == 10


def test_daily_curves(spark):
    values = [(1, 0, 1.0), (1, 12, 3.0), (2, 0, None), (3, 0, 6.0), (4, 5, None)]
    rows = spark.createDataFrame([("ISO", "2003-2012", dt.datetime(1970, 1, d, h), v) for d, h, v in values],
                                 "method string, period string, tmy_ts timestamp_ntz, t_db double")
    out = indicators.daily_curves(rows, keys=["method", "period"]).orderBy("day").collect()
    assert [(str(r.day), r.t_db) for r in out] == [
        ("1970-01-01", 2.0), ("1970-01-02", 4.0), ("1970-01-03", 6.0), ("1970-01-04", 6.0)]


def hot_points(spark, copies):
    """Station 0 sends ``copies`` times as many points as the 50 others together."""
    n = F.col("id").cast("int")
    return spark.range(50 * 200 * (copies + 1)).select(
        F.when(F.col("id") >= 50 * 200, 0).otherwise(1 + F.col("id") % 50).alias("station_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=n % 14400)).alias("ts"),
        F.lit("t_db").alias("field"), (F.col("id") % 37).cast("double").alias("value"))


def test_a_hot_station_folds_before_the_shuffle(spark):
    """Rows leaving the map side are bounded by hours per task, not by points."""
    p = hot_points(spark, 20)
    hourly = resample.hourly_wide(p, ("t_db",), KEY)
    hourly.collect()
    assert hourly.where("station_id = 0").count() <= 241
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
    modes = resample.mode_by_group(p, "value", KEY)
    assert "partial_max_by" in modes._jdf.queryExecution().executedPlan().toString()
    assert modes.count() == 51


def test_a_hot_station_changes_no_other_result(spark):
    calm, hot = hot_points(spark, 0), hot_points(spark, 20)
    start, stop = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00", "2024-01-11 23:00:00"))

    def run(p):
        hourly = resample.hourly_wide(p, ("t_db",), KEY)
        return gapfill.fill_same_hour(hourly, ["t_db"], start, stop, KEY).where("station_id <> 0")
    a, b = run(calm), run(hot)
    assert a.count() == 50 * 264
    assert a.exceptAll(b).count() == 0


def test_statistics_shuffle_daily_rows_once(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    daily = spark.range(10).select((F.col("id") % 2).alias("station_id"), day.alias("day"),
                                   *[F.rand(1).alias(c) for c in typical_year.RANKED])
    plan = typical_year.finkelstein_schafer(daily, keys=KEY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def most_rows_of_a_task(df):
    """Rows of the fullest task, and of all."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(counts), sum(counts)


def test_statistics_of_small_bytes_stay_in_many_tasks(spark):
    # eight sorts a task take twenty times the bytes that moved, so tasks aren't merged by these
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 60)
    daily = spark.range(64 * 60).select(F.floor(F.col("id") / 60).alias("station_id"), day.alias("day"),
                                        *[F.rand(1).alias(c) for c in typical_year.RANKED])
    most, total = most_rows_of_a_task(typical_year.finkelstein_schafer(daily, keys=KEY))
    assert total == 64 * 2 and most < total * 0.6


def test_supplier_days_are_dealt_before_they_are_summed(spark, tmp_path):
    day = F.lit("1995-01-02").cast("timestamp_ntz")
    n = F.col("id")
    (spark.range(3000).select((n % 100).alias("l_suppkey"), (day + F.make_dt_interval(days=(n % 900 / 100).cast("int"))).alias("l_shipdate"),
                              *[(n % k).cast("double").alias(c) for k, c in ((7, "l_quantity"), (11, "l_extendedprice"), (5, "l_discount"), (3, "l_tax"))])
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    days = views.by_supplier(spark, str(tmp_path))
    most, total = most_rows_of_a_task(days)
    assert total == 900 and most < total * 0.6
    rows = days._jdf.queryExecution().executedPlan().toString()
    moved = rows[rows.index("Exchange "):]
    assert "partial_avg" not in moved  # nothing is summed before rows move, as suppliers seldom have two of a day
    # equal rows to plain sums
    plain = spark.read.parquet(f"{tmp_path}/lineitem.parquet").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day")).agg(F.avg("l_tax").alias("x"))
    got = {(r.station_id, r.day): r.v_air for r in days.collect()}
    assert got == {(r.l_suppkey, r.day): pytest.approx(r.x * 31 * math.pi) for r in plain.collect()}
