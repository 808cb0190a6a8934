"""Declared schemas and field names.  An absent field is an all-NULL column, never a missing one."""

from __future__ import annotations

from pyspark.sql import types as T

#: One series is one station seen by one source.
KEYS = ("source", "station_id")

#: Fields a stored point may carry (fixed values).
FIELDS = (
    "t_db", "t_dp", "rh", "v_air", "wind_dir", "rain", "prec_rate", "ghi", "dif",
    "p_atm", "p_atm_min", "p_atm_max", "weathercode",
    "soil_t_0_7", "soil_t_7_28", "soil_t_28_100", "soil_t_100_255",
)

#: Unit-bearing names, used only on CSV files (fixed values).
UNIT_NAMES = {
    "t_db": "T_db[C]",
    "t_dp": "T_dp[C]",
    "rh": "RH[%]",
    "v_air": "v_air[m/s]",
    "wind_dir": "wind_dir[o]",
    "rain": "rain[mm]",
    "ghi": "GHI[W/m2]",
    "p_atm": "P_atm[hPa]",
    "soil_t_0_7": "soil_temperature_0_to_7cm (°C)",
    "soil_t_7_28": "soil_temperature_7_to_28cm (°C)",
    "soil_t_28_100": "soil_temperature_28_to_100cm (°C)",
    "soil_t_100_255": "soil_temperature_100_to_255cm (°C)",
}

POINTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

OBSERVATION = T.StructType([
    T.StructField("stationID", T.StringType()),
    T.StructField("obsTimeUtc", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("humidityAvg", T.DoubleType()),
    T.StructField("winddirAvg", T.DoubleType()),
    T.StructField("solarRadiationHigh", T.DoubleType()),
    T.StructField("metric", T.StructType([
        T.StructField("tempAvg", T.DoubleType()),
        T.StructField("dewptAvg", T.DoubleType()),
        T.StructField("windspeedAvg", T.DoubleType()),
        T.StructField("pressureMin", T.DoubleType()),
        T.StructField("pressureMax", T.DoubleType()),
        T.StructField("precipTotal", T.DoubleType()),
        T.StructField("precipRate", T.DoubleType()),
    ])),
])

#: One landed station document: all observations of one station and month.
STATION_DOCUMENT = T.StructType([
    T.StructField("observations", T.ArrayType(OBSERVATION)),
])

#: Columns of the hourly gridded CSV, in file order (fixed values); ``None`` is not stored.
GRIDDED_HOURLY = (
    ("t_db", "temperature_2m (°C)"),
    ("rh", "relativehumidity_2m (%)"),
    ("t_dp", "dewpoint_2m (°C)"),
    ("rain", "precipitation (mm)"),
    ("weathercode", "weathercode (wmo code)"),
    ("p_atm", "pressure_msl (hPa)"),
    ("v_air", "windspeed_10m (m/s)"),
    ("wind_dir", "winddirection_10m (°)"),
    ("soil_t_0_7", "soil_temperature_0_to_7cm (°C)"),
    ("soil_t_7_28", "soil_temperature_7_to_28cm (°C)"),
    ("soil_t_28_100", "soil_temperature_28_to_100cm (°C)"),
    ("soil_t_100_255", "soil_temperature_100_to_255cm (°C)"),
    ("dif", "diffuse_radiation (W/m²)"),
)

REFERENCE_STATIONS = T.StructType([
    T.StructField("continent", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("wmo", T.StringType()),
])

#: The 35 positional columns of an EPW data line (fixed values).
EPW_COLUMNS = (
    "year", "month", "day", "hour", "minute",
    "data_source_and_uncertainty_flags",
    "dry_bulb_temperature", "dew_point_temperature",
    "relative_humidity", "atmospheric_station_pressure",
    "extraterrestrial_horizontal_radiation", "extraterrestrial_direct_normal_radiation",
    "horizontal_infrared_radiation_intensity",
    "global_horizontal_radiation", "direct_normal_radiation", "diffuse_horizontal_radiation",
    "global_horizontal_illuminance", "direct_normal_illuminance",
    "diffuse_horizontal_illuminance", "zenith_luminance",
    "wind_direction", "wind_speed",
    "total_sky_cover", "opaque_sky_cover", "visibility", "ceiling_height",
    "present_weather_observation", "present_weather_codes",
    "precipitable_water", "aerosol_optical_depth",
    "snow_depth", "days_since_last_snowfall", "albedo",
    "liquid_precipitation_depth", "liquid_precipitation_quantity",
)
