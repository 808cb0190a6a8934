"""Golden values, computed by hand from the formulas."""

import pytest
from pyspark.sql import functions as F

from aerolog.functions import air, calendar, codes, place, soil, sun


def lits(*values):
    return [F.lit(float(v)) for v in values]


def near(expected, tolerance=1e-6):
    return pytest.approx(expected, abs=tolerance)


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_humid_air(value):
    t, rh = lits(25, 60)
    assert value(air.dew_point(t, rh)) == near(16.829539)
    assert value(air.vapour_pressure(air.dew_point(t, rh))) == near(19.227587)
    assert value(air.infrared_intensity(*lits(15, 25, 0.5))) == near(355.106896)
    assert value(air.absolute_humidity(t, rh)) == near(13.815549)
    assert value(air.wet_bulb(*lits(20, 50))) == near(13.699342)
    assert value(air.wet_bulb(*lits(30, 40))) == near(20.449202)
    assert value(air.treated_air(F.lit(30.0), air.wet_bulb(*lits(30, 40)))) == near(22.359362)


def test_dew_point_of_dry_air_is_null(value):
    assert value(air.dew_point(*lits(25, 0))) is None


def test_units(value):
    assert value(air.kmh_to_ms(F.lit(7.2))) == near(2.0)
    assert value(air.hpa_to_pa(F.lit(1011.0))) == near(101100.0)
    null = F.lit(None).cast("double")
    assert value(air.station_pressure(null, *lits(1010, 1012))) == near(1011.0)
    assert value(air.station_pressure(*lits(1005, 1010, 1012))) == near(1005.0)
    assert value(air.nan_to_null(F.lit(float("nan")))) is None


def test_great_circle(value):
    turin_milan = lits(45.07, 7.69, 45.46, 9.19)
    assert value(place.great_circle_km(*turin_milan)) == near(125.144643)
    assert value(place.great_circle_km(*turin_milan, place.EARTH_KM_URBAN)) == near(125.183929)


def test_coordinate_text(value):
    assert tuple(value(place.parse_coords(F.lit("(45.07, -7.69)")))) == (45.07, -7.69)
    assert tuple(value(place.parse_coords(F.lit("nowhere")))) == (None, None)


def test_sun(value):
    position = sun.solar_position(ntz("2023-06-21 13:00:00"), *lits(45.07, 7.69, 2))
    solar_time, declination, altitude, g0 = value(position)
    assert solar_time == near(11.988543)
    assert declination == near(0.409139)
    assert altitude == near(1.193307)
    assert g0 == near(1228.544759)
    assert value(sun.clearness(F.lit(600.0), position)) == near(0.488383)
    kt = sun.clearness(F.lit(600.0), position)
    split = sun.split_radiation(F.lit(600.0), kt, F.lit(0.5), F.lit(0.5), position)
    dif, dni = value(split)
    assert (dif, dni) == (near(440.830610), near(171.224813))
    assert value(sun.diffuse_share(kt, F.lit(0.5), F.lit(0.5), position)) == near(0.734718)
    assert value(sun.direct_normal(F.lit(600.0), F.lit(dif), position)) == near(dni)


def test_night_and_clamps(value):
    night = sun.solar_position(ntz("2023-06-21 00:00:00"), *lits(45.07, 7.69, 2))
    assert value(night)["g0"] == 0
    assert value(sun.clearness(F.lit(10.0), night)) == 0
    assert value(sun.direct_normal(*lits(10, 5), night)) == 0
    noon = sun.solar_position(ntz("2023-06-21 13:00:00"), *lits(45.07, 7.69, 2))
    assert value(sun.clearness(F.lit(2000.0), noon)) == 0.8
    assert value(sun.clearness(F.lit(None).cast("double"), noon)) is None
    assert tuple(value(sun.split_radiation(*lits(0, 0, 0.5, 0.5), noon))) == (0, 0)
    assert value(sun.clamp(F.lit(None).cast("double"), 0, 1)) is None


def test_persistence(value):
    assert value(sun.persistence(*lits(0, 0.3, 0.5))) == 0.5      # sunrise
    assert value(sun.persistence(*lits(0.4, 0.3, 0))) == 0.4      # sunset
    assert value(sun.persistence(*lits(0.2, 0.3, 0.4))) == near(0.3)


def test_soil_daily_equals_hourly(value):
    mean, amplitude = lits(15, 12)
    daily = soil.soil_temperature(mean, amplitude, F.lit(46), F.lit(200), F.lit(2.5), F.lit(6.177e-7 * 86400), 365.0)
    hourly = soil.soil_temperature(mean, amplitude, F.lit(46 * 24), F.lit(200 * 24), F.lit(2.5), F.lit(6.177e-7 * 3600), 8760.0)
    assert value(daily) == near(15.334803)
    assert value(hourly) == near(15.334803)


@pytest.mark.parametrize("direction, sector", [(0, 0), (22.4, 0), (22.5, 45), (340, 360), (359, 360)])
def test_wind_sector(value, direction, sector):
    assert value(codes.wind_sector(F.lit(float(direction)))) == sector


@pytest.mark.parametrize("total, rate, kind", [
    (0, 0.4, 40), (0.1, 0.4, 51), (0.1, 0.5, 53), (0.1, 1.0, 53), (0.1, 1.1, 61), (0.1, 2.5, 61), (0.1, 2.6, 63)])
def test_rain_type(value, total, rate, kind):
    assert value(codes.rain_type(*lits(total, rate))) == kind


def test_present_weather(value):
    assert value(codes.rain_type(F.lit(0.0))) == 40
    assert value(codes.rain_type(F.lit(0.2))) == 61
    assert value(codes.present_weather(F.lit(0.0), F.lit(61))) == 9
    assert value(codes.present_weather(F.lit(0.2), F.lit(40))) == 9
    assert value(codes.present_weather(F.lit(0.2), F.lit(61))) == 0
    assert value(codes.present_weather_code(F.lit(9), F.lit(40))) == 999999999
    assert value(codes.present_weather_code(F.lit(0), F.lit(61))) == 909999999
    assert value(codes.present_weather_code(F.lit(9), F.lit(71))) == 999099999
    assert value(codes.present_weather_code(F.lit(0), F.lit(99))) == 0


def test_calendar(value):
    t = ntz("2024-02-29 10:05:00")
    assert str(value(calendar.hour_end(t))) == "2024-02-29 11:00:00"
    assert str(value(calendar.hour_start(t))) == "2024-02-29 10:00:00"
    assert value(calendar.not_leap_day(t)) is False
    assert str(value(calendar.in_typical_year(ntz("2023-03-01 05:00:00")))) == "1970-03-01 05:00:00"
    assert value(calendar.month_day(F.lit("2023-03-01").cast("date"))) == "3/1"
    assert str(value(calendar.from_hour_index(calendar.hour_index(t)))) == "2024-02-29 10:00:00"
    before = ntz("1969-12-31 22:30:00")
    assert value(calendar.hour_index(before)) == -2
    assert str(value(calendar.from_hour_index(calendar.hour_index(before)))) == "1969-12-31 22:00:00"


@pytest.mark.parametrize("zone, moment, hours", [
    ("Europe/Rome", "2024-01-10 12:00:00", 1), ("Europe/Rome", "2024-07-10 12:00:00", 2),
    ("Asia/Kolkata", "2024-07-10 12:00:00", 5.5), ("Europe/Rome", "2024-03-31 00:59:00", 1),
    ("Europe/Rome", "2024-03-31 01:00:00", 2), ("America/St_Johns", "2024-01-10 12:00:00", -3.5)])
def test_utc_offset(value, zone, moment, hours):
    assert value(calendar.utc_offset_hours(ntz(moment), F.lit(zone))) == hours


def test_results_do_not_depend_on_the_session_zone(spark, value):
    t = ntz("2024-03-10 02:30:00")  # an hour New York skips
    expressions = [calendar.hour_end(t), calendar.hour_index(t), calendar.utc_offset_hours(t, F.lit("Europe/Rome")),
                   sun.solar_position(t, *lits(45, 7, 1))]
    here = [value(e) for e in expressions]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert [value(e) for e in expressions] == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
