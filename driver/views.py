"""Weather-like views over the driver's tables.

The tables hold no weather, so each view maps columns of a whole table to observations.  Values are
scaled by multiples of pi: no result then lies half-way between two decimals, where engines round
differently.  The SQL twins are in :mod:`driver.oracle`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolog.session import dealt

KEY = ["station_id"]
#: Event types as fields.
EVENT_FIELDS = {"click": "t_db", "view": "rh", "error": "v_air", "purchase": "p_atm", "signup": "ghi"}
HOUR_FIELDS = ("t_db", "rh", "v_air", "wind_dir", "rain", "prec_rate", "ghi", "p_atm_min", "p_atm_max")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _season(day: Column) -> Column:
    return 14 - 11 * F.cos(2 * math.pi * (F.dayofyear(day) - 15) / 365)


def _days(spark: SparkSession, sf: str, station: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col(station).alias("station_id"), F.col("l_shipdate").cast("date").alias("day"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _daily(rows: DataFrame) -> DataFrame:
    """Daily series per station: by supplier many stations with gaps, by return flag three stations
    that hold a third of all rows each."""
    return (
        rows.groupBy("station_id", "day")
        .agg(F.avg("l_quantity").alias("q"), F.avg("l_extendedprice").alias("p"),
             F.avg("l_discount").alias("c"), F.avg("l_tax").alias("x"))
        .select("station_id", "day", (_season(F.col("day")) + (F.col("q") - 25.5) / 2).alias("t_db"),
                (F.col("p") / (63 * F.pi())).alias("ghi"), (40 + F.col("c") * (188 * F.pi())).alias("rh"),
                (F.col("x") * (31 * F.pi())).alias("v_air"))
    )


def by_supplier(spark: SparkSession, sf: str) -> DataFrame:
    # a supplier seldom has two rows of one day: sums before the rows move would hold nearly all of them
    return _daily(dealt(_days(spark, sf, "l_suppkey"), "station_id", "day"))


def by_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(_days(spark, sf, "l_returnflag"))


def line_hour() -> Column:
    return (F.col("l_orderkey") + 5 * F.col("l_linenumber")) % 24


def line_instant() -> Column:
    """A line item's ship date with an hour and a minute of its own."""
    return F.col("l_shipdate") + F.make_dt_interval(hours=line_hour().cast("int"), mins=(F.col("l_partkey") % 60).cast("int"))


def line_observations(spark: SparkSession, sf: str, station: str = "l_returnflag") -> DataFrame:
    """One wide observation per line item, stations by return flag or another column, 1995 to 2001."""
    hour = line_hour()
    return table(spark, sf, "lineitem").select(
        F.col(station).alias("station_id"), line_instant().alias("ts"),
        (_season(F.col("l_shipdate").cast("date")) + 4 * F.sin(2 * math.pi * (hour - 9) / 24)
         + (F.col("l_quantity") - 25.5) / 5).alias("t_db"),
        (40 + F.col("l_discount") * (188 * F.pi())).alias("rh"),
        (F.col("l_tax") * (31 * F.pi())).alias("v_air"),
        (F.col("l_extendedprice") * F.pi() % 360).alias("wind_dir"),
        F.when(F.col("l_quantity") > 40, F.col("l_tax") * (16 * F.pi())).otherwise(F.lit(0.0)).alias("rain"),
        (F.col("l_discount") * (9 * F.pi())).alias("prec_rate"),
        (F.greatest(F.lit(0.0), F.sin(math.pi * (hour - 6) / 12))
         * (300 + F.col("l_extendedprice") / (63 * F.pi()))).alias("ghi"),
        (990 + F.col("l_quantity") / 3).alias("p_atm_min"),
        (1010 + F.col("l_quantity") / 3).alias("p_atm_max"),
    )


def event_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points of one station per user, January 2024."""
    kind = F.col("event_type")
    field = F.coalesce(*[F.when(kind == k, F.lit(f)) for k, f in EVENT_FIELDS.items()])
    return table(spark, sf, "events").select(
        F.col("user_id").alias("station_id"), "event_id", "ts", field.alias("field"),
        (F.col("value") * (F.pi() / 10)).alias("value"))


def event_places(spark: SparkSession, sf: str) -> DataFrame:
    """Place and zone of the stations behind :func:`event_points`."""
    n = F.col("station_id")
    return event_points(spark, sf).select("station_id").distinct().select(
        "station_id",
        (36 + (n * 7 % 290) / 10).alias("lat"),
        # the longitude fits the zone
        (-9 + (n * 13 % 370) / 10 + F.when(n % 3 == 2, 77).otherwise(0)).alias("lon"),
        F.when(n % 3 == 0, "Europe/Rome").when(n % 3 == 1, "Europe/London")
        .otherwise("Asia/Kolkata").alias("tz"),
    )


def supplier_places(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        n.alias("station_id"),
        (35 + n % 23 + F.col("s_acctbal") / 10000).alias("lat"),
        (-10 + n % 31 + F.col("s_acctbal") / 30000).alias("lon"))


def customer_places(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        n.alias("station_id"),
        (34 + n % 26 + F.col("c_acctbal") / 10000).alias("lat"),
        (-12 + n % 37 + F.col("c_acctbal") / 20000).alias("lon"))


def flag_places(spark: SparkSession, sf: str) -> DataFrame:
    """Place of the three return-flag stations."""
    n = F.ascii("station_id")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("station_id")).distinct().select(
        "station_id", F.round(20 + n / 3, 2).alias("lat"), F.round(n / 6 - 4, 2).alias("lon"),
        F.lit("Europe/Rome").alias("tz"))


def nation_references(spark: SparkSession, sf: str) -> DataFrame:
    """Reference stations with what a header needs."""
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.lpad(n.cast("string"), 6, "0").alias("wmo"),
        (35 + n).cast("double").alias("lat"), (-9.5 + 1.1 * n).alias("lon"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("DESIGN CONDITIONS,1,"), "n_name").alias("design_conditions"),
        (n % 3).alias("tz_hours"))


def nation_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Vertices of a star of twelve corners for each nation; every third has a hole."""
    n = F.col("n_nationkey")
    middle = table(spark, sf, "nation").select(
        F.col("n_name").alias("zone"), n.alias("n"), (36 + 3 * (n % 8) + F.lit(0.123)).alias("y"), (-10 + 8 * F.floor(n / 8) + n % 3 + F.lit(0.321)).alias("x"))
    outer = middle.select("*", F.lit(0).alias("ring"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("seq")).withColumn(
        "r", 2.5 + 1.3 * F.cos(5 * F.col("seq") + F.col("n"))).withColumn("turn", 2 * math.pi * F.col("seq") / 12)
    hole = middle.where("n % 3 = 0").select("*", F.lit(1).alias("ring"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("seq")).withColumn(
        "r", F.lit(0.9)).withColumn("turn", 2 * math.pi * F.col("seq") / 3)
    return outer.unionByName(hole).select(
        "zone", "ring", "seq", (F.col("x") + F.col("r") * F.cos("turn")).alias("lon"), (F.col("y") + F.col("r") * F.sin("turn")).alias("lat"))


def nation_circles(spark: SparkSession, sf: str) -> DataFrame:
    """A circle around each nation's reference place, from 100 to 1,540 km."""
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("circle"), (35 + n).cast("double").alias("lat"), (-9.5 + 1.1 * n).alias("lon"), (100 + 60 * n).cast("double").alias("radius_km"))


def line_brightness(spark: SparkSession, sf: str) -> DataFrame:
    """Points of fields whose names come from the data: brightness by line status and instruction."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("station_id"), line_instant().alias("ts"), F.concat(F.lit("Bright_"), "l_linestatus").alias("field"),
        (F.col("l_extendedprice") / (63 * F.pi())).alias("value"))


def part_raster(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of a raster of half degrees, 120 to a row."""
    n = F.col("p_partkey")
    return table(spark, sf, "part").select(
        (n % 120).alias("i"), F.floor(n / 120).alias("j"), (F.col("p_retailprice") / F.pi()).alias("elevation"))
