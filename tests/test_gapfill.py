import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolog.functions.calendar import day_index, hour_index
from aerolog.operators import gapfill

KEY = ["station_id"]
START, STOP = "2024-01-01 00:00:00", "2024-01-06 23:00:00"


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def frame(spark, rows, columns="t_db double"):
    return spark.createDataFrame(rows, f"station_id string, ts timestamp_ntz, {columns}")


def h(day, hour):
    return dt.datetime(2024, 1, day, hour)


def test_gaps_take_values_of_the_same_hour_only(spark):
    rows = [("a", h(1, 5), 7.0), ("a", h(2, 5), None), ("a", h(3, 5), 9.0), ("a", h(2, 6), 4.0)]
    out = gapfill.fill_same_hour(frame(spark, rows), ["t_db"], ntz(START), ntz("2024-01-03 23:00:00"), KEY)
    got = {r.ts: r.t_db for r in out.collect()}
    assert len(got) == 72
    assert [got[h(d, 5)] for d in (1, 2, 3)] == [7, 7, 9]
    assert [got[h(d, 6)] for d in (1, 2, 3)] == [4, 4, 4]
    assert all(v is None for t, v in got.items() if t.hour not in (5, 6))


def random_series(seed, share):
    rng = random.Random(seed)
    rows = []
    for s in "abc":
        for i in range(6 * 24):
            if rng.random() < share:
                rows.append((s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i),
                             None if rng.random() < 0.3 else rng.random(),
                             None if rng.random() < 0.3 else rng.random()))
    return rows


@pytest.mark.parametrize("share", [0.05, 0.3, 0.9])
def test_against_a_dense_table(spark, share):
    rows = random_series(3, share)
    out = gapfill.fill_same_hour(frame(spark, rows, "t_db double, rh double"), ["t_db", "rh"], ntz(START), ntz(STOP), KEY)
    got = out.toPandas().sort_values(["station_id", "ts"]).reset_index(drop=True)
    index = pd.date_range(START, STOP, freq="h")
    wanted = []
    for s in sorted({r[0] for r in rows}):
        mine = pd.DataFrame([r[1:] for r in rows if r[0] == s], columns=["ts", "t_db", "rh"]).set_index("ts")
        dense = pd.DataFrame(index=index).join(mine.astype(float))
        dense = dense.groupby(dense.index.hour).ffill()
        dense = dense.groupby(dense.index.hour).bfill()
        wanted.append(dense.rename_axis("ts").reset_index().assign(station_id=s))
    expected = pd.concat(wanted).reset_index(drop=True)[["station_id", "ts", "t_db", "rh"]]
    expected["ts"] = expected["ts"].astype(got["ts"].dtype)
    expected["station_id"] = expected["station_id"].astype(got["station_id"].dtype)
    pd.testing.assert_frame_equal(got, expected)


def test_filling_twice_changes_nothing_and_keeps_values(spark):
    rows = random_series(5, 0.4)
    source = frame(spark, rows, "t_db double, rh double")
    once = gapfill.fill_same_hour(source, ["t_db", "rh"], ntz(START), ntz(STOP), KEY)
    twice = gapfill.fill_same_hour(once, ["t_db", "rh"], ntz(START), ntz(STOP), KEY)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    kept = {(r.station_id, r.ts): r.t_db for r in once.collect()}
    assert all(kept[s, t] == v for s, t, v, _ in rows if v is not None)


def test_stations_without_data(spark):
    stations = spark.createDataFrame([("x",)], "station_id string")
    out = gapfill.fill_same_hour(frame(spark, []), ["t_db"], ntz(START), ntz(STOP), KEY, stations=stations)
    assert out.count() == 144 and out.where("t_db is not null").count() == 0


def test_window_mean_uses_measured_values_only(spark):
    values = {1: 10.0, 2: None, 3: None, 4: 30.0, 8: 90.0}
    rows = [("a", h(d, 12), v) for d, v in values.items()] + [("a", h(2, 13), 500.0)]
    got = {r.ts: r.t_db for r in gapfill.fill_window_mean(frame(spark, rows), "t_db", KEY).collect()}
    assert got[h(2, 12)] == 20.0   # days 1 and 4
    assert got[h(3, 12)] == 20.0   # the filled day 2 does not count
    assert got[h(1, 12)] == 10.0


def test_interpolation(spark):
    rows = [("a", h(1, i), v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])]
    out = gapfill.interpolate(frame(spark, rows), ["t_db"], hour_index(F.col("ts")), KEY)
    assert [r.t_db for r in out.orderBy("ts").collect()] == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_interpolation_against_pandas(spark):
    rng = np.random.default_rng(2)
    rows, wanted = [], {}
    for s in "ab":
        values = [None if rng.random() < 0.5 else float(rng.random()) for _ in range(200)]
        days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(200)]
        rows += [(s, d, v) for d, v in zip(days, values)]
        wanted[s] = pd.Series(values, dtype=float).interpolate("linear").tolist()
    out = gapfill.interpolate(frame(spark, rows), ["t_db"], day_index(F.col("ts")), KEY).orderBy("station_id", "ts").collect()
    for s in "ab":
        got = [np.nan if r.t_db is None else r.t_db for r in out if r.station_id == s]
        np.testing.assert_allclose(got, wanted[s])
