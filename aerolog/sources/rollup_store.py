"""Hourly sums of stored points, kept up to date under rewritten points.

A row holds the sum and the number of an hour's points, so its mean is known and an upsert can be put into
it without reading the hour again: the value that a point had goes out, the value that it has comes in.
Hours that no point of an upsert falls into are not computed anew. Sums are decimals with twelve places, so what goes
out is what came in, and after any number of upserts the rollup equals one that is computed afresh.

Points and rollup are two commits. The changes are taken from the stored points and written down before
either; if a job dies between the two commits, :func:`rebuild` computes the touched months again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.calendar import hour_end
from ..operators.points import POINT_KEYS
from ..session import materialized
from .point_store import _replace, latest_first, read_points, staged, stored_with

KEYS = ("source", "station_id", "field", "hour")
ROLLUP = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("station_id", T.StringType()), T.StructField("field", T.StringType()),
    T.StructField("hour", T.TimestampNTZType()), T.StructField("total", T.DecimalType(38, 12)), T.StructField("n", T.LongType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
PARTITIONS = ("source", "year", "month")


def exact(value: Column) -> Column:
    return value.cast("decimal(26,12)")


def _by_hour(changes: DataFrame) -> DataFrame:
    """Sums of ``(source, station_id, field, hour, total, n)`` by hour, with the hour's partition."""
    return changes.groupBy(*KEYS).agg(F.sum("total").cast("decimal(38,12)").alias("total"), F.sum("n").alias("n")).withColumns(
        {"year": F.year("hour"), "month": F.month("hour")})


def _contribution(points: DataFrame) -> DataFrame:
    return points.where("value is not null").select("source", "station_id", "field", hour_end(F.col("ts")).alias("hour"), exact(F.col("value")).alias("total"), F.lit(1).cast("long").alias("n"))


def changes(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """What staged points change in their hours, given the stored ones of the same partitions."""
    if old is None:
        return _by_hour(_contribution(new))
    both = old.join(new.select(*POINT_KEYS), on=_same_key(old, new), how="left_semi").select(*POINT_KEYS, "value", "ingest_ts", F.lit(True).alias("was")).unionByName(
        new.select(*POINT_KEYS, "value", "ingest_ts", F.lit(False).alias("was")))
    found = both.groupBy(*POINT_KEYS).agg(F.max_by("value", latest_first()).alias("value"), F.max(F.when(F.col("was"), F.col("value"))).alias("before"))
    moved = found.where(~F.col("value").eqNullSafe(F.col("before")))
    # out with the old value, in with the new one
    out = _contribution(moved.select(*POINT_KEYS, F.col("before").alias("value"))).withColumns({"total": -F.col("total"), "n": -F.col("n")})
    return _by_hour(_contribution(moved).unionByName(out))


def _same_key(old: DataFrame, new: DataFrame) -> Column:
    same = F.lit(True)
    for k in POINT_KEYS:
        same = same & old[k].eqNullSafe(new[k])
    return same


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """(source, station_id, field, hour, total, n, mean)."""
    return spark.read.schema(ROLLUP).parquet(path).withColumn("mean", F.col("total").cast("double") / F.col("n"))


def write_points(points: DataFrame, store: str, rollup: str, ingested: Column | None = None) -> None:
    """The upsert of ``point_store.write_points``, and of its hours in the rollup."""
    new = staged(points, ingested)
    delta = materialized(changes(new, stored_with(store, new)))
    _replace(new, store)
    _merge(delta, rollup)


def _merge(delta: DataFrame, rollup: str) -> None:
    """Add changes to the stored hours of their months; hours that are left without points go."""
    spark = delta.sparkSession
    try:
        stored = spark.read.schema(ROLLUP).parquet(rollup)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None
    rows = delta.select(*KEYS, "total", "n")
    if stored is not None:
        touched = F.lit(False)  # one name for each folder of the rollup
        for r in delta.select("source", "year", "month").distinct().collect():
            touched = touched | (F.col("source").eqNullSafe(r.source) & (F.col("year") == r.year) & (F.col("month") == r.month))
        rows = stored.where(touched).select(*KEYS, "total", "n").unionByName(rows)
    (_by_hour(rows).where("n > 0").hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "station_id", "field", "hour")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(rollup))


def rebuild(spark: SparkSession, store: str, rollup: str) -> None:
    """The whole rollup from the stored points."""
    _by_hour(_contribution(read_points(spark, store))).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "station_id", "field", "hour").write.mode(
        "overwrite").option("partitionOverwriteMode", "static").partitionBy(*PARTITIONS).parquet(rollup)
