import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from aerolog.functions.soil import DIFFUSIVITY
from aerolog.operators import degree, ground

KEY = ["station_id"]


def daily(spark, rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), t) for s, d, t in rows], "station_id string, day date, t_db double")


def test_degree_days(spark):
    rows = daily(spark, [("a", "2023-01-01", 10.0), ("a", "2023-01-02", 15.0), ("a", "2023-01-03", 16.0),
                         ("a", "2023-07-01", 23.0), ("a", "2023-07-02", 24.0), ("a", "2023-07-03", 26.0),
                         ("a", "2024-02-29", -50.0)])
    heating = degree.degree_days(rows, degree.heating_degrees(F.col("t_db")), KEY, years=(2022, 2024))
    assert {r.year: r.degree_days for r in heating.collect()} == {2022: 0.0, 2023: 11.0, 2024: 0.0}
    cooling = degree.degree_days(rows, degree.cooling_degrees(F.col("t_db")), KEY)
    assert {r.year: r.degree_days for r in cooling.collect()} == {2023: 8.0}


def hours(spark, values):
    start = dt.datetime(1970, 7, 1)
    return spark.createDataFrame([("a", start + dt.timedelta(hours=i), float(t), 40.0) for i, t in enumerate(values)],
                                 "station_id string, ts timestamp_ntz, t_db double, rh double")


def test_degree_hours(spark):
    rows = hours(spark, [20, 25, 30])
    cooling = {r.threshold: r.degree_hours for r in degree.cooling_degree_hours(rows, keys=KEY).collect()}
    assert cooling == {18: 21, 21: 13, 24: 7, 26: 4, 28: 2}
    heating = {r.threshold: r.degree_hours for r in degree.heating_degree_hours(rows, keys=KEY).collect()}
    assert heating == {18: 0, 20: 0, 22: 2}


def test_residuals(spark):
    rows = hours(spark, [22, 27, 33, 35])
    out = ground.residual_evaporative(rows, KEY).orderBy("threshold").collect()
    assert [r.baseline for r in out] == sorted((r.baseline for r in out), reverse=True)
    assert all(r.residual <= r.baseline for r in out)
    parameters = spark.createDataFrame([("a", 12.0, 15.0, 46)], "station_id string, amplitude double, mean_t double, phase_day int")
    got = {r.threshold: r.residual for r in ground.residual_exchanger(rows, parameters, KEY).collect()}
    a, depth = DIFFUSIVITY["wet_clay"] * 3600, 2.5

    def treated(t, n):
        soil = 15 - 12 * math.exp(-depth * math.sqrt(math.pi / (8760 * a))) * math.cos(
            2 * math.pi / 8760 * (n - 46 * 24 - depth / 2 * math.sqrt(8760 / (math.pi * a))))
        return t - 0.8 * (t - soil)
    start = (dt.date(1970, 7, 1) - dt.date(1970, 1, 1)).days * 24
    for th in (18, 21, 24, 26):
        want = sum(max(treated(t, start + i) - th, 0) for i, t in enumerate([22, 27, 33, 35]))
        assert got[th] == pytest.approx(want, abs=1e-9)


def year(spark):
    """A common year of hours: radiation least on day 355 (Dec 22), temperature highest on day 200."""
    n = F.col("id").cast("int")
    return spark.range(8760).select(
        F.lit("a").alias("station_id"),
        (F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n)).alias("ts"),
        (15 - 10 * F.cos(2 * math.pi * (n / 24 - 17.5) / 365)).alias("t_db"),
        (F.abs(F.floor(n / 24) - 355) * 1.0 + F.when(n % 24 == 0, 5.0).otherwise(10.0)).alias("ghi"))


def test_soil_parameters(spark):
    s = year(spark)
    p = ground.soil_parameters(s, KEY, warmest=True).first()
    pdf = s.toPandas()
    month = pdf.ts.dt.month
    assert p.amplitude == pytest.approx(0.5 * (pdf.t_db[month == 7].mean() - pdf.t_db[month == 1].mean()) + 1.1)
    assert p.mean_t == pytest.approx(pdf.t_db.mean() + 1.7)
    assert p.phase_day == 355 + 46 - 365
    assert p.warmest == 200 * 24
    assert ground.soil_parameters(s, KEY, phase="hourly_min").first().phase_day == 36
    with pytest.raises(ValueError):
        ground.soil_parameters(s, KEY, phase="other")


def test_phase_inside_the_year(spark):
    rows = spark.range(365).select(ground.phase_day(F.col("id")).alias("p")).collect()
    assert [r.p for r in rows] == [d + 46 if d + 46 <= 364 else d + 46 - 365 for d in range(365)]


def test_profile_shape(spark):
    parameters = ground.soil_parameters(year(spark), KEY, warmest=True)
    profile = ground.soil_profile(parameters, KEY)
    assert profile.count() == 4 * 12 * 11
    spread = {r.depth: r.s for r in profile.where("soil = 'wet_clay'").groupBy("depth").agg(
        (F.max("t_soil") - F.min("t_soil")).alias("s")).collect()}
    assert [spread[d] for d in sorted(spread)] == sorted(spread.values(), reverse=True)  # damped with depth
    assert ground.soil_profile(parameters, KEY, depths=ground.CURVE_DEPTHS).count() == 4800
    hadvig = ground.soil_profile(parameters, KEY, "hadvig", (0.0001,)).where("soil = 'sand'")
    assert hadvig.orderBy(F.col("t_soil").desc()).first().month == 7
    with pytest.raises(ValueError):
        ground.soil_profile(parameters, KEY, "unknown")


def test_soil_daily(spark):
    s = year(spark).withColumn("day", F.col("ts").cast("date")).groupBy("station_id", "day").agg(F.avg("t_db").alias("t_db"))
    out = ground.soil_daily(s, ground.soil_parameters(year(spark), KEY), KEY)
    assert out.count() == 365 * 6


def test_ground_line(spark):
    rows = spark.createDataFrame([("a", dt.datetime(1970, m, 1), float(m), m + 0.126, 3.0, None) for m in range(1, 13)],
                                 "station_id string, ts timestamp_ntz, soil_t_0_7 double, soil_t_7_28 double, soil_t_28_100 double, soil_t_100_255 double")
    line = ground.ground_line(rows, KEY).first().line
    first = ",".join(f"{m}.0" for m in range(1, 13))
    second = ",".join(f"{m}.13" for m in range(1, 13))
    assert line.startswith(f"GROUND TEMPERATURES,4,0.04,,,,{first},0.18,,,,{second},0.64,,,,3.0")
    assert line.endswith("1.77,,,," + ",".join(["nan"] * 12))
