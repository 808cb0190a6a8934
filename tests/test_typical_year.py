import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolog.operators import typical_year as ty
from aerolog.plans import typical_year as plan

KEY = ["station_id"]


def days(spark, rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d), *map(float, v)) for s, d, *v in rows],
                                 "station_id string, day date, t_db double, ghi double, rh double, v_air double")


def test_statistic_by_hand(spark):
    rows = days(spark, [("a", "1999-01-01", 1, 1, 1, 5), ("a", "1999-01-02", 3, 3, 3, 5),
                        ("a", "2000-01-01", 2, 2, 2, 7), ("a", "2000-01-02", 4, 4, 4, 7)])
    plain = {r.year: r.fs_t_db for r in ty.finkelstein_schafer(rows, keys=KEY).collect()}
    assert plain == {1999: pytest.approx(0.5), 2000: pytest.approx(0.0)}
    norm = {r.year: r.fs_t_db for r in ty.finkelstein_schafer(rows, keys=KEY, denominator="n+1").collect()}
    assert norm == {1999: pytest.approx(0.2), 2000: pytest.approx(0.2)}
    assert ty.finkelstein_schafer(rows, keys=KEY, whole_months=True).count() == 0
    with pytest.raises(ValueError):
        ty.finkelstein_schafer(rows, keys=KEY, denominator="n-1")


def network(spark, stations=("a", "b"), years=range(2001, 2006)):
    rng = np.random.default_rng(4)
    rows = []
    for s in stations:
        for day in pd.date_range(f"{years[0]}-01-01", f"{years[-1]}-12-31"):
            rows.append((s, str(day.date()), *rng.normal(10, 5, 4).round(1)))
    return days(spark, rows)


def brute_force(pdf, variables=("t_db", "ghi", "rh")):
    """Chosen year per month, by plain loops over one station."""
    pdf = pdf.assign(year=pd.to_datetime(pdf.day).dt.year, month=pd.to_datetime(pdf.day).dt.month)
    chosen = {}
    for month, group in pdf.groupby("month"):
        totals = {}
        for v in variables:
            ordered = group.sort_values([v, "day"])
            overall = dict(zip(ordered.day, np.arange(1, len(ordered) + 1) / len(ordered)))
            for year, part in group.groupby("year"):
                inner = part.sort_values([v, "day"])
                totals.setdefault(year, 0.0)
                totals[year] += sum(abs((i + 1) / len(inner) - overall[d]) for i, d in enumerate(inner.day))
        best = sorted(totals, key=lambda y: (round(totals[y], 9), y))[:3]
        wind = group.groupby("year").v_air.mean()
        mean = np.mean([wind[y] for y in best])
        chosen[month] = min(best, key=lambda y: (round(abs(wind[y] - mean), 9), best.index(y)))
    return chosen


def test_choice_against_loops(spark):
    rows = network(spark)
    chosen = ty.typical_months(ty.finkelstein_schafer(rows, keys=KEY), KEY).collect()
    pdf = rows.toPandas()
    for s in "ab":
        got = {r.month: r.chosen_year for r in chosen if r.station_id == s}
        assert got == brute_force(pdf[pdf.station_id == s])
    as_written = ty.typical_months(ty.finkelstein_schafer(rows, keys=KEY), KEY, variant="as_written").collect()
    for s in "ab":
        got = {r.month: r.chosen_year for r in as_written if r.station_id == s}
        assert got == brute_force(pdf[pdf.station_id == s], ("t_db", "t_db", "t_db"))


def test_a_station_alone_equals_the_same_among_many(spark):
    rows = network(spark)
    among = ty.typical_months(ty.finkelstein_schafer(rows, keys=KEY), KEY).where("station_id = 'b'")
    alone = ty.typical_months(ty.finkelstein_schafer(rows.where("station_id = 'b'"), keys=KEY), KEY)
    assert sorted(map(tuple, among.collect())) == sorted(map(tuple, alone.collect()))


def hour_points(spark, first, last):
    n = F.col("id").cast("int")
    hours = (dt.date(last + 1, 1, 1) - dt.date(first, 1, 1)).days * 24
    ts = F.lit(f"{first}-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n, mins=F.lit(-30))
    fields = {"t_db": n % 31, "ghi": n % 17, "rh": n % 13, "v_air": n % 7, "wind_dir": (n % 3) * 45}
    return spark.range(hours).select(ts.alias("ts"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("field"), v.cast("double").alias("value")) for k, v in fields.items()]))).select(
        F.lit("net").alias("source"), F.lit("a").alias("station_id"), "ts", "field", "value").where(
        (F.hash("ts", "field") % 5 != 0))


def test_whole_flow_gives_a_whole_year(spark):
    points = hour_points(spark, 2003, 2005)   # 2004 is a leap year
    columns = ("t_db", "ghi", "rh", "v_air")
    iso = plan.iso_years(points, 2003, 2005, columns)
    assert iso.count() == 8760
    assert iso.select("tmy_ts").distinct().count() == 8760
    assert iso.where("year(tmy_ts) <> 1970 or t_db is null").count() == 0
    mean = plan.mean_years(points, 2003, 2005, columns)
    assert mean.count() == 8760 and mean.where("t_db is null or wind_dir is null").count() == 0


def test_a_source_with_diffuse_radiation_alone(spark):
    named = hour_points(spark, 2003, 2006)
    other = named.withColumn("field", F.when(F.col("field") == "ghi", "dif").otherwise(F.col("field")))
    iso = plan.iso_years(other, 2003, 2006, ("t_db", "dif", "rh", "v_air"), scored=("t_db", "dif", "rh"))
    same = plan.iso_years(named, 2003, 2006, ("t_db", "ghi", "rh", "v_air")).withColumnRenamed("ghi", "dif")
    assert iso.count() == 8760 and iso.exceptAll(same.select(*iso.columns)).count() == 0


def test_mean_year(spark):
    rows = spark.createDataFrame([("a", dt.datetime(y, 3, 1, 5), float(y - 2000), w) for y, w in
                                  [(2001, 90.0), (2002, 45.0), (2003, 90.0), (2004, 45.0)]] +
                                 [("a", dt.datetime(2004, 2, 29, 5), 99.0, 0.0)],
                                 "station_id string, ts timestamp_ntz, t_db double, wind_dir double")
    out = ty.mean_typical_year(rows, ["t_db"], ["wind_dir"], KEY).collect()
    assert [(str(r.tmy_ts), r.t_db, r.wind_dir) for r in out] == [("1970-03-01 05:00:00", 2.5, 45.0)]


def test_absent_variable_and_absent_wind_do_not_choose(spark):
    rows = [("s", "a", f"{y}-01-{d:02d}", float((d * 7 + y) % 11), None, float(d % 5), None if y == 2001 else float(y - 2000))
            for y in (2001, 2002, 2003, 2004) for d in range(1, 29)]
    daily = spark.createDataFrame(rows, "source string, station_id string, day string, t_db double, ghi double, rh double, v_air double").withColumn("day", F.col("day").cast("date"))
    stats = ty.finkelstein_schafer(daily, variables=("t_db", "ghi", "rh"))
    assert {r["fs_ghi"] for r in stats.collect()} == {None}
    chosen = ty.typical_months(stats, scored=("t_db", "ghi", "rh"), best=4).first()
    assert chosen["chosen_year"] == 2003 and chosen["fs_tot"] is not None  # the mean wind of 2002 to 2004 is that of 2003
