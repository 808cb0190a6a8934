import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aerolog.operators import epw
from aerolog.operators.points import in_range
from aerolog.operators.typical_year import SOIL_FIELDS
from aerolog.plans import ingest, weather_file
from aerolog.schemas import EPW_COLUMNS
from aerolog.schemas import GRIDDED_HOURLY
from aerolog.sources import epw_files, gridded_csv, lists, point_store, station_json, typical_csv
from aerolog.streaming.landing import ingest_stream

KEY = ["station_id"]
OBSERVATION = {
    "stationID": "a", "obsTimeUtc": "2023-01-01T00:59:56Z", "lat": 45.07, "lon": 7.69, "humidityAvg": 80.0,
    "winddirAvg": 200.0, "solarRadiationHigh": None,
    "metric": {"tempAvg": 3.2, "dewptAvg": 0.1, "windspeedAvg": 7.2, "pressureMin": 1010.0, "pressureMax": 1012.0,
               "precipTotal": 0.0, "precipRate": 0.0}}


def document(**changes):
    return json.dumps({"observations": [{**OBSERVATION, **changes}]})


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_station_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(json.loads(document()), indent=1))
    (tmp_path / "bad.json").write_text("<html>too many requests</html>")
    documents = station_json.read_documents(spark, str(tmp_path))
    assert tuple(station_json.count_rejected(documents).first()) == (1, 2)
    got = {r.field: r.value for r in station_json.station_points(documents).collect()}
    assert got == {"t_db": 3.2, "t_dp": 0.1, "rh": 80.0, "wind_dir": 200.0, "v_air": pytest.approx(2.0),
                   "p_atm_min": 1010.0, "p_atm_max": 1012.0, "rain": 0.0, "prec_rate": 0.0}
    row = station_json.station_points(documents).first()
    assert (row.source, row.station_id, row.ts) == ("network", "A", dt.datetime(2023, 1, 1, 0, 59, 56))


def test_upsert_and_pruned_read(spark, tmp_path):
    store, first, second = str(tmp_path / "store"), tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    (first / "a.json").write_text(document())
    (first / "b.json").write_text(document(obsTimeUtc="2022-05-01T10:00:00Z"))
    ingest.ingest_network(spark, str(first), store, stamp("2024-01-01"))
    changed = {**OBSERVATION["metric"], "tempAvg": 9.9}
    (second / "a.json").write_text(document(metric=changed))
    ingest.ingest_network(spark, str(second), store, stamp("2024-01-02"))
    ingest.ingest_network(spark, str(first), store, stamp("2023-12-01"))    # an older copy loses
    points = point_store.read_points(spark, store)
    assert points.count() == 18
    assert {r.ts.year: r.value for r in points.where("field = 't_db'").collect()} == {2022: 3.2, 2023: 9.9}
    recent = point_store.read_points(spark, store, dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1), "network")
    assert recent.count() == 9
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "source" in filters and "year" in filters and "month" in filters
    assert [p.name for p in sorted((tmp_path / "store").glob("source=network/year=*/month=*"))] == ["month=5", "month=1"]
    pruned = in_range(point_store.read_points(spark, store), stamp("2022-01-01"), stamp("2022-12-31"))
    assert pruned.count() == 9 and "year" in pruned._jdf.queryExecution().executedPlan().toString().split(
        "PartitionFilters: [")[1].split("]")[0]
    assert ingest.station_list(points).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    landing.mkdir()
    (landing / "1.json").write_text(document() + "\n" + "not json\n" + document(stationID="b"))
    ingest_stream(spark, str(landing), store, str(tmp_path / "progress")).awaitTermination()
    (landing / "2.json").write_text(document(humidityAvg=50.0))
    ingest_stream(spark, str(landing), store, str(tmp_path / "progress")).awaitTermination()
    points = point_store.read_points(spark, store)
    assert points.count() == 18
    assert {r.station_id: r.value for r in points.where("field = 'rh'").collect()} == {"A": 50.0, "B": 80.0}


def test_gridded_hourly(spark, tmp_path):
    folder = tmp_path / "lat=45.07" / "lon=7.69"
    folder.mkdir(parents=True)
    header = "time," + ",".join(name for _, name in GRIDDED_HOURLY)
    (folder / "x.csv").write_text(
        "latitude,longitude,elevation\n45.1,7.7,240.0\n\n" + header + "\n"
        "1965-01-01T00:00,1.5,80,0.5,0.0,3,1013.2,2.0,180,4,5,6,7,12.5\n"
        "1965-01-01T01:00,,81,NaN,0.0,3,1013.2,2.0,180,4,5,6,7,\n")
    hourly = gridded_csv.read_hourly(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r.ts, r.lat, r.lon, r.t_db, r.t_dp, r.dif) for r in hourly] == [
        (dt.datetime(1965, 1, 1, 0), 45.07, 7.69, 1.5, 0.5, 12.5), (dt.datetime(1965, 1, 1, 1), 45.07, 7.69, None, None, None)]
    named = tmp_path / "station_id=north1" / "lat=45.07" / "lon=7.69"
    named.mkdir(parents=True)
    (named / "x.csv").write_text((folder / "x.csv").read_text())
    store = str(tmp_path / "store")
    ingest.ingest_gridded(spark, [str(tmp_path / "lat=45.07"), str(tmp_path / "station_id=north1")], store, stamp("2024-01-01"))
    points = point_store.read_points(spark, store)
    assert points.count() == 2 * (13 + 10)
    assert {r.station_id for r in points.collect()} == {"45.07_7.69", "NORTH1"}


def test_gridded_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude\n45,7\n\ntime,windspeed_10m (m/s),cloudcover (%),temperature_2m (°C)\n"
                                    "2020-01-01T00:00,3,50,1.5\n")
    (tmp_path / "b.csv").write_text("time,temperature_2m (°C)\n2020-01-01T00:00,2.5\n2020-01-01T01:00\n")
    got = gridded_csv.read_hourly(spark, str(tmp_path)).orderBy("path", "ts").collect()
    assert [(r.t_db, r.v_air, r.weathercode, r.rh) for r in got] == [(1.5, 3.0, None, None), (2.5, None, None, None), (None,) * 4]


def test_gridded_header():
    header = "time,temperature_2m (°C),cloudcover (%),diffuse_radiation (W/m²)\n"
    assert gridded_csv.fields_of(header) == ("t_db", "_2", "dif")
    with pytest.raises(ValueError):
        gridded_csv.fields_of("latitude,longitude")


def test_gridded_daily(spark, tmp_path):
    (tmp_path / "x.csv").write_text("latitude,longitude\n45,7\n\ntime,temperature_2m_mean (°C)\n1950-01-01,1.5\n1950-01-02,2.5\n")
    rows = gridded_csv.read_daily(spark, str(tmp_path)).orderBy("day").collect()
    assert [(str(r.day), r.t_db, r.lat) for r in rows] == [("1950-01-01", 1.5, None), ("1950-01-02", 2.5, None)]


def test_lists(spark, tmp_path):
    (tmp_path / "ids.csv").write_text("north1, NORTH2 ,,x\n")
    assert [r.id for r in lists.read_ids(spark, str(tmp_path / "ids.csv")).collect()] == ["NORTH1", "NORTH2", "X"]
    (tmp_path / "refs.csv").write_text("continent;country;region;city;lat;lon;wmo\nEurope;ITA;;Turin;45.22;7.65;016059\n")
    row = lists.read_reference_stations(spark, str(tmp_path / "refs.csv")).first()
    assert (row.city, row.lat, row.wmo) == ("Turin", 45.22, "016059")


def test_typical_year_files(spark, tmp_path):
    columns = ("t_db", "rh")
    rows = spark.createDataFrame([("ISO", s, dt.datetime(1970, 1, 1, h), h + 0.5, None if h == 1 else 50.0)
                                  for s in "ab" for h in range(3)],
                                 "method string, station_id string, tmy_ts timestamp_ntz, t_db double, rh double")
    typical_csv.write_typical_year(rows, str(tmp_path / "out"), columns)
    files = list((tmp_path / "out").glob("method=ISO/station_id=a/*.csv"))
    assert len(files) == 1
    assert files[0].read_text().splitlines()[:2] == ["timestamp,T_db[C],RH[%]", "1970-01-01 00:00:00,0.5,50.0"]
    back = typical_csv.read_typical_year(spark, str(tmp_path / "out"), columns).select(rows.columns)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0


def test_named_typical_year_files(spark, tmp_path):
    text = "timestamp,T_db[C]\n1970-01-01 00:00:00,1.5\n"
    (tmp_path / "X1_ISO_TMY_network_2003_2012.csv").write_text(text)
    (tmp_path / "45.0_7.0_mean_TMY_1951_1960.csv").write_text(text)
    rows = typical_csv.read_named_files(spark, str(tmp_path), ("t_db",))
    assert sorted(tuple(r) for r in rows.select("station_id", "method", "source", "period", "t_db").collect()) == [
        ("45.0_7.0", "mean", "", "1951-1960", 1.5), ("X1", "ISO", "network", "2003-2012", 1.5)]


def rows_for_epw(spark, first_hour=2):
    base = [("a", dt.datetime(2023, 1, 1, h), 1.5, 0.5, 80.9, 1013.5, 300.25, 0.0, 10.0, 45.0, 2.0, 9, 0.0)
            for h in range(first_hour, 24)]
    return spark.createDataFrame(base, "station_id string, ts timestamp_ntz, t_db double, t_dp double, rh double, p_atm double, "
                                       "hiri double, dni double, dif double, wind_dir double, v_air double, "
                                       "present_weather_observation int, rain double")


def test_epw_rows_and_padding(spark):
    rows = epw.epw_rows(rows_for_epw(spark), KEY)
    assert tuple(rows.columns[1:]) == EPW_COLUMNS
    first = rows.orderBy("hour").first()
    assert (first.hour, first.minute, first.relative_humidity, first.atmospheric_station_pressure) == (3, 1, 80, 101350)
    padded = epw.pad_first_day(rows, KEY)
    assert sorted(r.hour for r in padded.collect()) == list(range(1, 25))
    assert padded.where("hour < 3 and dry_bulb_temperature is null").count() == 2
    assert epw.pad_first_day(epw.epw_rows(rows_for_epw(spark, 0), KEY), KEY).count() == 24


def test_old_files_begin_with_their_header(spark, tmp_path):
    rows = rows_for_epw(spark).withColumn("ts", F.col("ts") - F.expr("INTERVAL 58 YEARS"))
    header = spark.createDataFrame([("a", 1, "LOCATION"), ("a", 2, "DESIGN")], "station_id string, line_no bigint, line string")
    path = str(tmp_path / "old")
    epw_files.write_epw(header, epw.epw_lines(epw.epw_rows(rows, KEY), KEY), path, KEY)
    (part,) = (tmp_path / "old" / "station_id=a").glob("part-*")
    lines = part.read_text().splitlines()
    assert lines[:2] == ["LOCATION", "DESIGN"] and [x.split(",")[3] for x in lines[2:]] == [str(h) for h in range(3, 25)]
    assert lines[2].startswith("1965,1,1,")


def test_epw_files(spark, tmp_path):
    header = spark.createDataFrame([("a", n, f"HEADER {n}") for n in range(1, 9)], "station_id string, line_no bigint, line string")
    path = str(tmp_path / "epw")
    epw_files.write_epw(header, epw.epw_lines(epw.pad_first_day(epw.epw_rows(rows_for_epw(spark), KEY), KEY), KEY), path, KEY)
    files = list((tmp_path / "epw" / "station_id=a").glob("*.txt"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert len(lines) == 8 + 24 and lines[7] == "HEADER 8"
    assert lines[8] == "2023,1,1,1,1" + "," * 30
    assert lines[10] == "2023,1,1,3,1,,1.5,0.5,80,101350,,,300.25,,0.0,10.0,,,,,45.0,2.0,,,,,9,,,,,,,0.0,"
    (tmp_path / "epw" / "station_id=a" / "broken.txt").write_text("2023,1,1,5\nLOCATION,x\n2023,13,1,1,1" + "," * 30 + "\n")
    back = epw_files.read_epw(spark, path, partitions="station_id STRING").where("ts is not null").orderBy("ts").collect()
    assert len(back) == 24
    assert (back[2].ts, back[2].dry_bulb_temperature, back[0].dry_bulb_temperature) == (dt.datetime(2023, 1, 1, 2), 1.5, None)


def test_station_year_to_weather_file(spark, tmp_path):
    """Points with gaps in, a complete EPW file out."""
    fields = ("t_db", "t_dp", "rh", "v_air", "wind_dir", "rain", "prec_rate", "ghi", "p_atm", "p_atm_min", "p_atm_max")
    n = F.col("id").cast("int")
    values = {"t_db": 10 + n % 24 / 2, "rh": 50 + n % 7, "v_air": n % 5, "wind_dir": n % 360, "rain": n % 2, "prec_rate": n % 3,
              "ghi": F.greatest(F.lit(0), 500 - 90 * F.abs(n % 24 - 12)), "p_atm_min": F.lit(1000), "p_atm_max": F.lit(1010)}
    points = spark.range(8760).where("id % 7 <> 0").select(
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=n, mins=F.lit(-20))).alias("ts"),
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), v.cast("double").alias("value")) for f, v in values.items()]))
    ).select(F.lit("net").alias("source"), F.lit("a").alias("station_id"), "ts", "field", "value")
    stations = spark.createDataFrame([("net", "a", 45.0, 7.6, "Europe/Rome", "Turin", "TO", "ITA", "net", 240)],
                                     "source string, station_id string, lat double, lon double, tz string, city string, state string, "
                                     "country string, origin string, elevation int")
    references = spark.createDataFrame([("016059", 45.2, 7.6, 1, "DESIGN CONDITIONS,0"), ("000001", 0.0, 0.0, 0, "other")],
                                       "wmo string, lat double, lon double, tz_hours int, design_conditions string")
    soil = spark.range(12).select(F.lit("net").alias("source"), F.lit("a").alias("station_id"),
                                  F.make_timestamp_ntz(F.lit(2023), (F.col("id") + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("ts"),
                                  *[F.lit(9.0).alias(c) for c in SOIL_FIELDS])
    path = str(tmp_path / "epw")
    weather_file.write_station_year(points, stations, references, soil, 2023, path, fields, comment1="test")
    lines = next((tmp_path / "epw" / "source=net" / "station_id=a").glob("*.txt")).read_text().splitlines()
    assert len(lines) == 8 + 8760
    assert lines[0] == "LOCATION,Turin,TO,ITA,net,016059,45.0,7.6,1,240"
    assert lines[1] == "DESIGN CONDITIONS,0"
    assert lines[2].startswith("TYPICAL/EXTREME PERIODS,6,") and lines[3].startswith("GROUND TEMPERATURES,4,0.04,,,,9.0")
    assert lines[4:8] == ["HOLIDAYS/DAYLIGHT SAVINGS,No,0,0,0", "COMMENTS 1,test", "COMMENTS 2,",
                          "DATA PERIODS,1,1,Data,Monday,1/1/2023,12/31/2023"]
    assert lines[8].startswith("2023,1,1,1,1,,") and lines[-1].startswith("2023,12,31,24,1,,")
    assert all(line.count(",") == 34 for line in lines[8:])
    back = epw_files.read_epw(spark, path, ("dry_bulb_temperature", "diffuse_horizontal_radiation"), "source STRING, station_id STRING")
    assert back.where("dry_bulb_temperature is null").count() == 0
    assert back.where("diffuse_horizontal_radiation is null").count() == 2      # first and last hour
