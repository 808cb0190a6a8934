"""The registered queries: each runs library operators over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from aerolog.functions import air, codes, sun
from aerolog.functions.calendar import day_index, hour_index, utc_offset_hours
from aerolog.operators import (compare, degree, design, elevation, epw, gapfill, ground, nearest, points,
                               radiation, resample, typical_year, urban, weeks, zones)
from aerolog.plans import typical_year as year_plan, weather_file
from aerolog.schemas import EPW_COLUMNS, GRIDDED_HOURLY, REFERENCE_STATIONS
from aerolog.session import materialized, scratch_folder
from aerolog.sources import epw_files, gridded_csv, lists, point_store, rollup_store, station_json, typical_csv

from . import views as V

KEY = V.KEY
DAILY = ("t_db", "ghi", "rh", "v_air")
FIVE = ("t_db", "rh", "v_air", "p_atm", "ghi")
JANUARY = ("2024-01-01 00:00:00", "2024-01-31 23:00:00")
YEARS = (1995, 2001)
CENTER, RADIUS = (50.0, 10.0), 900.0


def tidy(df: DataFrame) -> DataFrame:
    """Doubles with four decimals, integers as BIGINT: the form the SQL twins return.

    The inner rounding takes off the noise of summation order before half-way cases are decided.
    """
    def one(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return (F.round(F.round(f.name, 10), 4) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)
    return df.select(*[one(f) for f in df.schema.fields])


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# points ---------------------------------------------------------------------------------------

def q_range_filter(spark, sf):
    chosen = points.select_points(V.event_points(spark, sf), ntz("2024-01-05 00:00:00"),
                                  ntz("2024-01-20 12:00:00"), fields=["t_db", "rh"])
    return chosen.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def q_json_flatten(spark, sf):
    e = V.table(spark, sf, "events")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    k = F.get_json_object("props", "$.k").cast("double")
    document = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("stationID"),
        stamp.alias("obsTimeUtc"), k.alias("humidityAvg"),
        F.struct(F.col("value").alias("tempAvg"), (F.col("value") * 2).alias("windspeedAvg")).alias("metric"),
    )).alias("observations")))
    rows = station_json.observations(station_json.parse_documents(e.select(document.alias("text")), "text"))
    return rows.groupBy("station_id", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rh").alias("rh"), F.sum("t_db").alias("t_db"),
        F.sum("v_air").alias("v_air"), F.count("ghi").alias("n_ghi"))


def q_unpivot(spark, sf):
    rows = V.by_flag(spark, sf).withColumn(
        "v_air", F.when(F.col("rh") > 72, F.lit(float("nan"))).otherwise(F.col("v_air")))
    return points.to_points(rows, DAILY, ("station_id", "day"))


def q_unit_convert(spark, sf):
    rows = V.by_supplier(spark, sf)
    p = F.when(F.col("rh") > 60, 1000 + F.col("v_air"))
    return rows.select("station_id", "day", air.kmh_to_ms(F.col("v_air")).alias("v_ms"),
                       air.hpa_to_pa(air.station_pressure(p, 990 + F.col("t_db"), 995 + F.col("rh"))).alias("p_pa"))


def q_coords(spark, sf):
    e = V.event_points(spark, sf)
    text = F.concat(F.lit("("), (40 + F.col("event_id") % 97 / 8).cast("string"), F.lit(", "),
                    (-7 + F.col("event_id") % 89 / 4).cast("string"), F.lit(")"))
    placed = points.decode_coords(e.withColumn("coords", text))
    return points.station_places(placed, KEY)


def q_id_list(spark, sf):
    lines = V.table(spark, sf, "customer").select(F.concat_ws(
        ",", F.concat(F.lit(" "), F.lower("c_name")), F.concat("c_mktsegment", F.lit(" ")), F.lit(" "),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("value"))
    return lists.split_ids(lines).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


def q_upsert_latest(spark, sf):
    rows = V.event_points(spark, sf).withColumn("hour_ts", F.window("ts", "1 hour")["start"])
    return points.latest_points(rows, F.col("event_id"), ("station_id", "field", "hour_ts"))


def q_point_store(spark, sf):
    """Write all points, write corrected temperatures again, read a range back."""
    store = f"{scratch_folder(spark)}/points"
    rows = V.event_points(spark, sf).join(V.event_places(spark, sf).drop("tz"), KEY, "left").select(
        F.lit("network").alias("source"), F.concat(F.lit("u"), F.col("station_id").cast("string")).alias("station_id"),
        "lat", "lon", "ts", "field", "value")
    point_store.write_points(rows, store, ntz("2024-02-01 00:00:00"))
    corrected = rows.where("field = 't_db'").withColumn("value", F.col("value") + 0.5)
    point_store.write_points(corrected, store, ntz("2024-02-02 00:00:00"))
    kept = point_store.read_points(spark, store, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 29), "network")
    return kept.groupBy("station_id", "field").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("lat").alias("lat"))


def q_rollup_after_upsert(spark, sf):
    """Hourly means kept up to date under three upserts: all points, corrected temperatures, and late and older points."""
    folder = scratch_folder(spark)
    store, rollup = f"{folder}/points", f"{folder}/rollup"
    rows = V.event_points(spark, sf).select(
        F.lit("network").alias("source"), F.concat(F.lit("u"), F.col("station_id").cast("string")).alias("station_id"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), "ts", "field", "value", "event_id")
    first = rows.where("event_id % 5 <> 0").drop("event_id")
    rollup_store.write_points(first, store, rollup, ntz("2024-02-02 00:00:00"))
    corrected = first.where("field = 't_db'").withColumn("value", F.col("value") + 0.5)
    rollup_store.write_points(corrected, store, rollup, ntz("2024-02-03 00:00:00"))
    late = rows.where("event_id % 5 = 0 or event_id % 7 = 0").drop("event_id")  # an older stamp: what is stored stays, what is new comes in
    rollup_store.write_points(late, store, rollup, ntz("2024-02-01 00:00:00"))
    return rollup_store.read_rollup(spark, rollup).select("station_id", "field", "hour", "n", "mean")


# resampling -----------------------------------------------------------------------------------

def q_hourly_mean(spark, sf):
    return resample.hourly_mean(V.event_points(spark, sf), KEY, out="hour_end").withColumnRenamed("value", "mean")


def q_hourly_pivot(spark, sf):
    return resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY, out="hour_end")


def q_hourly_multi_agg(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station_id"), V.line_instant().alias("ts"),
        (F.col("l_quantity") * F.pi()).alias("t_db"), (F.col("l_tax") * 100).alias("rain"),
        codes.wind_sector(F.col("l_extendedprice") % 360).cast("double").alias("wind_dir"),
        F.floor(F.col("l_discount") * 30).cast("double").alias("rain_type"))
    long = points.to_points(rows, ("t_db", "rain", "wind_dir", "rain_type"), ("station_id", "ts"))
    return resample.hourly_multi_agg(long, ["t_db"], ["rain"], ["wind_dir"], ["rain_type"], KEY, out="hour_ts")


def q_daily_mean(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), ("t_db", "rh"), KEY, label="start")
    return resample.daily_mean(hourly, ["t_db", "rh"], KEY)


def q_monthly_mean(spark, sf):
    return resample.monthly_mean(V.by_supplier(spark, sf), ["t_db", "ghi"], KEY, "day")


def q_temp_trend(spark, sf):
    return resample.yearly_mean(V.by_supplier(spark, sf), ["t_db"], KEY, "day", (1994, 2001))


def q_mode(spark, sf):
    rows = V.table(spark, sf, "events").select(
        F.col("user_id").alias("station_id"), F.floor(F.col("value") / 10).cast("double").alias("v"))
    return resample.mode_by_group(rows, "v", KEY)


# gaps -----------------------------------------------------------------------------------------

def _january(spark, sf, columns):
    hourly = materialized(resample.hourly_wide(V.event_points(spark, sf), columns, KEY))
    return gapfill.fill_same_hour(hourly, columns, ntz(JANUARY[0]), ntz(JANUARY[1]), KEY)


def q_gapfill_same_hour(spark, sf):
    return _january(spark, sf, ["t_db"])


def q_gapfill_window_mean(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY).select(*KEY, "ts", "ghi")
    return gapfill.fill_window_mean(hourly, "ghi", KEY)


def q_interpolate(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY).select(*KEY, "ts", "rh")
    return gapfill.interpolate(hourly, ["rh"], hour_index(F.col("ts")), KEY)


def q_interpolate_daily(spark, sf):
    rows = V.by_supplier(spark, sf).select(
        *KEY, "day", F.when(F.col("rh") < 80, F.col("t_db")).alias("t_db"))
    return gapfill.interpolate(rows, ["t_db"], day_index(F.col("day")), KEY)


# degree days and hours ------------------------------------------------------------------------

def q_hdd(spark, sf):
    return degree.degree_days(V.by_supplier(spark, sf), degree.heating_degrees(F.col("t_db")), KEY, years=YEARS)


def q_cdd(spark, sf):
    return degree.degree_days(V.by_supplier(spark, sf), degree.cooling_degrees(F.col("t_db")), KEY, years=YEARS)


def _supplier_hours(spark, sf, fields):
    """Hourly means of many stations, by year."""
    rows = points.to_points(V.line_observations(spark, sf, "l_suppkey"), fields, ("station_id", "ts"))
    return resample.hourly_wide(rows, fields, KEY).withColumn("year", F.year("ts"))


BY_YEAR = [*KEY, "year"]


def q_hdh(spark, sf):
    return degree.heating_degree_hours(_supplier_hours(spark, sf, ("t_db",)), keys=BY_YEAR)


def q_cdh(spark, sf):
    return degree.cooling_degree_hours(_supplier_hours(spark, sf, ("t_db",)), keys=BY_YEAR)


def q_cdh_eahx(spark, sf):
    """Hours against the soil of their own year."""
    rows = materialized(_supplier_hours(spark, sf, ("t_db", "ghi")))
    return ground.residual_exchanger(rows, ground.soil_parameters(rows, BY_YEAR), BY_YEAR)


def q_cdh_pdec(spark, sf):
    return ground.residual_evaporative(_supplier_hours(spark, sf, ("t_db", "rh")), BY_YEAR)


# typical years --------------------------------------------------------------------------------

def _statistics(daily: DataFrame):
    return typical_year.finkelstein_schafer(daily, keys=KEY, whole_months=True)


def _iso_rows(daily: DataFrame):
    return typical_year.typical_rows(
        daily, typical_year.typical_months(_statistics(daily), KEY), DAILY, KEY, "day")


def _mean_rows(daily: DataFrame):
    rows = daily.withColumn("wind_dir", codes.wind_sector(F.col("ghi") % 360))
    return typical_year.mean_typical_year(rows, DAILY, ("wind_dir",), KEY, "day")


def q_tmy_iso_fs(spark, sf):
    return _statistics(V.by_flag(spark, sf)).select("station_id", "year", "month", "fs_t_db", "fs_ghi", "fs_rh", "fs_v_air")


def q_tmy_iso(spark, sf):
    return typical_year.typical_months(_statistics(V.by_flag(spark, sf)), KEY)


def q_tmy_iso_network(spark, sf):
    """The same choice for every supplier: many stations with a few days per month."""
    return typical_year.typical_months(
        typical_year.finkelstein_schafer(V.by_supplier(spark, sf), keys=KEY), KEY)


def q_tmy_iso_absent(spark, sf):
    """Every third station without radiation, humidity and wind with gaps of their own."""
    n, day = F.col("station_id"), F.col("day")
    rows = V.by_supplier(spark, sf).withColumns({
        "ghi": F.when(n % 3 != 0, F.col("ghi")),
        "rh": F.when((n % 2 == 1) | (F.dayofmonth(day) % 5 != 0), F.col("rh")),
        "v_air": F.when((n % 4 != 0) | (F.year(day) % 2 == 0), F.col("v_air"))})
    return typical_year.typical_months(typical_year.finkelstein_schafer(rows, keys=KEY), KEY)


def q_tmy_iso_rows(spark, sf):
    return _iso_rows(materialized(V.by_flag(spark, sf)))


def q_tmy_iso_gridded(spark, sf):
    """A source without global radiation: diffuse radiation is scored instead."""
    daily = materialized(V.by_flag(spark, sf).withColumn("dif", F.col("ghi") / 3 + (F.col("rh") - 40) / F.pi()).drop("ghi"))
    scored = ("t_db", "dif", "rh")
    months = typical_year.typical_months(typical_year.finkelstein_schafer(daily, scored, keys=KEY, whole_months=True), KEY, scored)
    return typical_year.typical_rows(daily, months, ("t_db", "dif", "rh", "v_air"), KEY, "day")


def q_tmy_mean(spark, sf):
    return _mean_rows(V.by_flag(spark, sf))


def q_hourly_found(spark, sf):
    """Hourly means of all fields named bright, whatever they are, beside the temperature."""
    both = _line_points(spark, sf).where("field = 't_db'").unionByName(V.line_brightness(spark, sf))
    wide = resample.hourly_multi_agg(both, mean=["t_db"], keys=KEY, found="bright")
    return wide.select("station_id", "ts", "t_db", F.explode("others").alias("field", "value"))


def _line_points(spark, sf):
    return points.to_points(V.line_observations(spark, sf), V.HOUR_FIELDS, ("station_id", "ts"))


def q_tmy_iso_hourly(spark, sf):
    """Raw points to typical year: resample, pivot, fill, rank, choose, gather."""
    return year_plan.iso_years(_line_points(spark, sf), *YEARS, DAILY, KEY)


def _mean_year(spark, sf):
    """Raw points of all years to one averaged year, in the columns an EPW needs."""
    filled = year_plan.filled_hours(_line_points(spark, sf), *YEARS, (*V.HOUR_FIELDS, "p_atm"), KEY)
    mean = ("t_db", "rh", "v_air", "rain", "prec_rate", "ghi", "p_atm")
    return typical_year.mean_typical_year(
        year_plan.with_pressure(filled), mean, ("wind_dir",), KEY).withColumnRenamed("tmy_ts", "ts")


def q_tmy_mean_hourly(spark, sf):
    return _mean_year(spark, sf).withColumnRenamed("ts", "tmy_ts")


def _iso_with_method(spark, sf):
    return q_tmy_iso_rows(spark, sf).withColumn("method", F.lit("ISO"))


def q_tmy_csv_roundtrip(spark, sf):
    folder = f"{scratch_folder(spark)}/typical"
    typical_csv.write_typical_year(_iso_with_method(spark, sf), folder, DAILY)
    return typical_csv.read_typical_year(spark, folder, DAILY).drop("method")


# weeks ----------------------------------------------------------------------------------------

def _weeks(spark, sf):
    return weeks.season_weeks(V.by_flag(spark, sf), keys=KEY)


def q_typical_week(spark, sf):
    return _weeks(spark, sf).select(
        "station_id", "year", "season", F.col("typical_start").alias("week_start"), F.col("typical_end").alias("week_end"))


def q_extreme_week(spark, sf):
    return _weeks(spark, sf).where("extreme_end is not null").select(
        "station_id", "year", "season", F.col("extreme_start").alias("week_start"), F.col("extreme_end").alias("week_end"))


def q_season_scalars(spark, sf):
    return weeks.season_scalars(V.by_supplier(spark, sf), keys=KEY)


# formulas -------------------------------------------------------------------------------------

def q_rain_code(spark, sf):
    total, rate = F.col("l_tax"), F.col("l_discount") * 30
    rows = V.table(spark, sf, "lineitem").select(
        codes.rain_type(total, rate).alias("rain_type"), codes.rain_type(total).alias("total_type"), "l_tax")
    obs = codes.present_weather(total, F.col("rain_type"))
    return rows.select("rain_type", "total_type", obs.alias("obs"),
                       codes.present_weather_code(obs, F.col("rain_type")).alias("code")
                       ).groupBy("rain_type", "total_type", "obs", "code").agg(F.count(F.lit(1)).alias("n"))


def q_wind_sector(spark, sf):
    return V.table(spark, sf, "lineitem").groupBy(
        codes.wind_sector(F.col("l_extendedprice") % 360).alias("sector")).agg(F.count(F.lit(1)).alias("n"))


def q_psychro(spark, sf):
    t, rh = F.col("t_db"), F.col("rh")
    dp = air.dew_point(t, rh)
    return V.by_supplier(spark, sf).select(
        "station_id", "day", dp.alias("t_dp"), air.vapour_pressure(dp).alias("es"),
        air.absolute_humidity(t, rh).alias("abs_hum"), air.wet_bulb(t, rh).alias("t_wb"))


def q_hiri(spark, sf):
    rows = V.by_supplier(spark, sf).withColumn("kt_d", F.col("ghi") / 700)
    return radiation.with_infrared(rows).select("station_id", "day", "hiri")


def _ghi_hours(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY).select(*KEY, "ts", "ghi")
    return hourly.join(V.event_places(spark, sf), KEY, "left")


def q_solar(spark, sf):
    rows = radiation.with_sun(_ghi_hours(spark, sf))
    return rows.select("station_id", "ts", "sun.altitude", "g0", "kt", sun.direct_normal(
        F.col("ghi"), 0.3 * F.col("ghi"), F.col("sun")).alias("dni"))


def _ghi_january(spark, sf):
    return _january(spark, sf, ["ghi"]).join(V.event_places(spark, sf), KEY, "left")


def q_clearness_daily(spark, sf):
    return radiation.daily_clearness(radiation.with_sun(_ghi_january(spark, sf)), KEY)


def q_brl_split(spark, sf):
    return radiation.split(_ghi_january(spark, sf), KEY).select("station_id", "ts", "kt_d", "dif", "dni")


def q_tz_offset(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY)
    rows = hourly.join(V.event_places(spark, sf), KEY, "left")
    return rows.groupBy("station_id", utc_offset_hours(F.col("ts"), F.col("tz")).alias("offset_h")).agg(
        F.count(F.lit(1)).alias("n"))


# ground ---------------------------------------------------------------------------------------

def q_soil_params(spark, sf):
    rows = V.by_supplier(spark, sf).withColumn("year", F.year("day"))
    return ground.soil_parameters(rows, ["station_id", "year"], "day")


def q_soil_profile(spark, sf):
    rows = V.by_supplier(spark, sf).withColumn("year", F.year("day"))
    return ground.soil_profile(ground.soil_parameters(rows, BY_YEAR, "day"), BY_YEAR)


def q_soil_hadvig(spark, sf):
    rows = materialized(_supplier_hours(spark, sf, ("t_db", "ghi")))
    return ground.soil_profile(ground.soil_parameters(rows, BY_YEAR, warmest=True), BY_YEAR, "hadvig", (0.5, 2.0))


def q_soil_daily(spark, sf):
    rows = materialized(V.by_flag(spark, sf))
    return ground.soil_daily(rows, ground.soil_parameters(rows, KEY, "day"), KEY)


def _layers(daily: DataFrame, ts: str) -> DataFrame:
    t = F.col("t_db")
    return daily.select(
        *KEY, ts, (t * 0.9 + 1.3).alias("soil_t_0_7"), (t * 0.7 + 3.1).alias("soil_t_7_28"),
        (t * 0.5 + 5.7).alias("soil_t_28_100"), (t * 0.3 + 9.1).alias("soil_t_100_255"))


def q_ground_temps(spark, sf):
    return ground.ground_line(_layers(V.by_flag(spark, sf), "day"), KEY, "day")


# places ---------------------------------------------------------------------------------------

def q_nearest_station(spark, sf):
    refs = V.supplier_places(spark, sf).withColumnRenamed("station_id", "ref")
    return nearest.nearest_reference(V.customer_places(spark, sf), refs, "station_id", "ref")


def q_nearest_two_sources(spark, sf):
    """Stations of two sources that share ids, each with its own nearest reference, from a list that was written and read."""
    folder = f"{scratch_folder(spark)}/references"
    columns = [f.name for f in REFERENCE_STATIONS.fields]
    refs = V.nation_references(spark, sf)
    (refs.select(*(F.col(c).cast("string") if c in refs.columns else F.lit("").alias(c) for c in columns))
     .write.option("sep", ";").option("header", "true").csv(folder))
    stations = V.customer_places(spark, sf).withColumn("source", F.lit("b")).unionByName(V.supplier_places(spark, sf).withColumn("source", F.lit("a")))
    return nearest.nearest_reference(stations, lists.read_reference_stations(spark, folder), ["source", "station_id"], "wmo")


def q_uhi_gap_hour(spark, sf):
    hourly = resample.hourly_wide(V.event_points(spark, sf), ("t_db",), KEY)
    inside = urban.zones(V.event_places(spark, sf), CENTER, RADIUS, KEY)
    return urban.zone_gap(hourly, inside, F.hour("ts"), "hour", keys=KEY)


def q_uhi_gap_month(spark, sf):
    inside = urban.zones(V.supplier_places(spark, sf), CENTER, RADIUS, KEY)
    return urban.zone_gap(V.by_supplier(spark, sf), inside, F.month("day"), "month", keys=KEY)


def q_zone_of_place(spark, sf):
    """The zone that holds each customer's place."""
    cells = zones.zone_cells(V.nation_zones(spark, sf))
    return zones.with_zone(V.customer_places(spark, sf), cells, keys=KEY).select("station_id", "zone")


def q_uhi_many_centres(spark, sf):
    """The monthly gap of many overlapping circles."""
    return urban.circle_gaps(V.by_supplier(spark, sf), V.supplier_places(spark, sf), V.nation_circles(spark, sf), F.month("day"), "month", keys=KEY)


def q_elevation(spark, sf):
    tiles = elevation.tiled(V.part_raster(spark, sf))
    return elevation.with_elevation(V.customer_places(spark, sf), tiles, (33.0, -15.0), 0.5, keys=KEY).select("station_id", "elevation")


def q_uhi_daily_map(spark, sf):
    return resample.station_day_map(V.event_points(spark, sf), "t_db", KEY)


def q_days_present(spark, sf):
    return resample.days_present(V.event_points(spark, sf))


# design conditions ----------------------------------------------------------------------------

def q_design_conditions(spark, sf):
    hourly = materialized(resample.hourly_wide(_line_points(spark, sf), ("t_db", "rh", "v_air"), KEY))
    return design.design_values(hourly, KEY)


def q_design_extremes(spark, sf):
    hourly = materialized(resample.hourly_wide(_line_points(spark, sf), ("t_db",), KEY))
    return design.months(hourly, keys=KEY).join(design.extremes(hourly, keys=KEY), KEY)


# EPW ------------------------------------------------------------------------------------------

def _derived(spark, sf):
    return weather_file.derive(weather_file.clean(_mean_year(spark, sf)), V.flag_places(spark, sf), KEY)


def _filled_columns(rows: DataFrame) -> DataFrame:
    """Without the columns an EPW leaves blank."""
    blank = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)} - set(KEY)
    return rows.select(*[c for c in rows.columns if c not in blank])


def q_epw_rows(spark, sf):
    return _filled_columns(epw.epw_rows(_derived(spark, sf), KEY))


def q_epw_pad(spark, sf):
    """Event hours as EPW rows: most stations begin in the middle of a day."""
    hourly = resample.hourly_wide(V.event_points(spark, sf), FIVE, KEY, label="start")
    absent = {c: F.lit(None).cast("double") for c in ("t_dp", "hiri", "dni", "dif", "wind_dir", "rain")}
    rows = epw.epw_rows(hourly.withColumns(absent).withColumn(
        "present_weather_observation", F.lit(9)), KEY)
    return epw.pad_first_day(rows, KEY).select(
        *KEY, *EPW_COLUMNS[:5], "dry_bulb_temperature", "relative_humidity",
        "atmospheric_station_pressure", "wind_speed", "present_weather_observation")


def _header_stations(spark, sf):
    return V.flag_places(spark, sf).select(
        "station_id", "lat", "lon", "tz", F.lit("").alias("state"), F.lit("ITA").alias("country"),
        F.lit("network").alias("origin"), F.lit(240).alias("elevation"))


def q_epw_header(spark, sf):
    series = materialized(_mean_year(spark, sf).select(*KEY, "ts", "t_db"))
    stations = weather_file.with_reference(_header_stations(spark, sf), V.nation_references(spark, sf))
    return weather_file.header_lines(stations, series, _layers(series, "ts"), KEY, comment1="averaged year")


def q_epw_roundtrip(spark, sf):
    """Points to EPW files of all stations, read back."""
    folder = f"{scratch_folder(spark)}/epw"
    series = materialized(_mean_year(spark, sf))
    weather_file.write_weather_files(
        series, _header_stations(spark, sf), V.nation_references(spark, sf), _layers(series, "ts"), folder, KEY)
    return epw_files.read_epw(spark, folder, ("dry_bulb_temperature", "wind_speed"), "station_id STRING")


def q_gridded_hourly(spark, sf):
    """Hourly extracts of two layouts, written and read back by their own headers."""
    folder = f"{scratch_folder(spark)}/gridded_hourly"
    hourly = resample.hourly_wide(_line_points(spark, sf), ("t_db", "rh", "v_air"), KEY)
    names = dict(GRIDDED_HOURLY)
    layouts = {True: ("v_air", "t_db"), False: ("rh", None, "t_db")}
    other = F.col("station_id") == "N"

    def line(first, cells) -> Column:
        return F.concat_ws(",", first, *(F.coalesce(c, F.lit("")) for c in cells))

    def by_layout(first, cell) -> Column:
        return F.when(other, line(first, map(cell, layouts[True]))).otherwise(line(first, map(cell, layouts[False])))

    data = hourly.select(*KEY, F.lit(1).alias("part"), "ts", by_layout(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), lambda c: F.col(c).cast("string") if c else F.lit("7")).alias("value"))
    heads = hourly.select(*KEY).distinct().select(*KEY, F.lit(0).alias("part"), F.lit(None).cast("timestamp_ntz").alias("ts"), by_layout(
        F.lit("time"), lambda c: F.lit(names[c] if c else "cloudcover (%)")).alias("value"))
    (data.unionByName(heads).repartition(*KEY).sortWithinPartitions(*KEY, "part", "ts")
     .select(*KEY, "value").write.partitionBy(*KEY).text(folder))
    return gridded_csv.read_hourly(spark, folder).select("station_id", "ts", "t_db", "rh", "v_air")


def q_gridded_csv(spark, sf):
    folder = f"{scratch_folder(spark)}/gridded"
    rows = V.by_flag(spark, sf).join(V.flag_places(spark, sf), KEY)
    place = ["lat", "lon"]
    data = rows.select(*place, F.concat_ws(
        ",", F.col("day").cast("string"), F.col("t_db").cast("string")).alias("value"))
    preamble = V.flag_places(spark, sf).select(*place, F.explode(F.array(
        F.lit("latitude,longitude,elevation"), F.lit("45.0,7.0,240.0"),
        F.lit("time,temperature_2m_mean (°C)"))).alias("value"))
    (preamble.unionByName(data).repartition("lat", "lon")
     .write.mode("overwrite").partitionBy("lat", "lon").text(folder))
    return gridded_csv.read_daily(spark, folder).select("lat", "lon", "day", "t_db")


# comparisons ----------------------------------------------------------------------------------

def q_pearson_bias(spark, sf):
    left = V.by_supplier(spark, sf).select(
        "station_id", "day", F.when(F.col("rh") < 90, F.col("t_db")).alias("x"))
    right = V.table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.avg("o_totalprice").alias("p")).select(
        "day", F.when(F.col("p") < 270000, F.col("p") / 19000).alias("y"))
    return compare.pearson_and_bias(compare.aligned(left, right, ["day"]), "x", "y", KEY)


def q_asof_align(spark, sf):
    """Every temperature with the latest humidity of its station, at most six hours old."""
    rows = V.event_points(spark, sf)
    left = rows.where("field = 't_db'").select("station_id", "event_id", "ts", F.col("value").alias("t_db"))
    right = rows.where("field = 'rh'").select("station_id", "ts", F.col("value").alias("rh"))
    return compare.as_of(left, right, KEY, ["rh"], 6.0)


def q_files_against_stations(spark, sf):
    """Daily series of five files, each against the stations it is paired with."""
    files = V.table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("file"), F.col("o_orderdate").cast("date").alias("day")).agg(
        (F.avg("o_totalprice") / 19000).alias("y"))
    number = F.substring("file", 1, 1).cast("int") - 1
    pairs = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station_id")).join(
        files.select("file", number.alias("n")).distinct().withColumn("other", F.explode(F.array(F.lit(0), F.lit(2)))).select(
            "file", F.pmod(F.col("n") + F.col("other"), F.lit(5)).alias("k")), F.col("station_id") % 5 == F.col("k")).select("file", "station_id")
    left = V.by_supplier(spark, sf).select("station_id", "day", F.col("t_db").alias("x"))
    return compare.pearson_and_bias(compare.paired(left, files, pairs, KEY, ["file"], ["day"]), "x", "y", ["file", *KEY])


def q_compare_sources(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.year("l_shipdate").alias("year"), "l_returnflag", "l_quantity")
    return compare.side_by_side(rows, ["station_id", "year"], F.col("l_returnflag"), ["A", "N", "R"], F.col("l_quantity") * F.pi())


def q_compare_methods(spark, sf):
    """Ranked and averaged typical years side by side, by day."""
    keys = ["station_id", "tmy_ts"]
    daily = materialized(V.by_flag(spark, sf))
    both = _iso_rows(daily).select(*keys, "t_db").withColumn("method", F.lit("iso")).unionByName(
        _mean_rows(daily).select(*keys, "t_db").withColumn("method", F.lit("mean")))
    return compare.side_by_side(both, keys, F.col("method"), ["iso", "mean"], F.col("t_db"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def with_tidy(f):
        return lambda spark, sf: tidy(f(spark, sf))
    return {name: with_tidy(f) for name, f in globals().items() if name.startswith("q_")}
