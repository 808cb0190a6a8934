"""The stored points: Parquet partitioned by source, year, month and a bucket of stations.

A month is what a landed document covers, and a bucket of a month is what an upsert of a late document
rewrites. Reading a time range or some stations reads their months and buckets alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..operators.points import POINT_KEYS
from ..schemas import POINTS
from ..session import materialized

STORED = T.StructType([
    *POINTS.fields, T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
])
PARTITIONS = ("source", "year", "month", "bucket")
#: Buckets of stations in each month of a source. A store keeps the number it was written with.
BUCKETS = 16


def bucket_of(station: Column) -> Column:
    """The bucket of a station; null ids have one, too."""
    return F.pmod(F.xxhash64(station), F.lit(BUCKETS)).cast("int")


def month_number() -> Column:
    """Months counted through the years, from the partition columns: usable for pruning."""
    return F.col("year") * 12 + F.col("month")


def _instant(moment: dt.datetime) -> Column:
    # as text: a datetime literal would pass through the session time zone
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def read_points(spark: SparkSession, path: str, start: dt.datetime | None = None,
                stop: dt.datetime | None = None, source: str | None = None,
                stations: Sequence[str] | None = None) -> DataFrame:
    """Points of the half-open range ``[start, stop)``; other months, sources and buckets of stations are not read."""
    points = spark.read.schema(STORED).parquet(path)
    if source is not None:
        points = points.where(F.col("source") == source)
    if stations is not None:
        # the ids alone decide, on the driver: the scan is pruned to literal buckets
        ids = spark.createDataFrame([(s,) for s in stations], "id string").select(bucket_of(F.col("id"))).distinct().collect()
        points = points.where(F.col("bucket").isin([r[0] for r in ids]) & F.col("station_id").isin(list(stations)))
    if start is not None:
        points = points.where(
            (month_number() >= start.year * 12 + start.month) & (F.col("ts") >= _instant(start)))
    if stop is not None:
        points = points.where(
            (month_number() <= stop.year * 12 + stop.month) & (F.col("ts") < _instant(stop)))
    return points


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored points, or None before the first write."""
    try:
        return spark.read.schema(STORED).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_points(points: DataFrame, path: str, ingested: Column | None = None) -> None:
    """Upsert: a point written again under the same key replaces the old one.

    Only the partitions the new points touch, buckets of months, are read back and rewritten, in one dynamic partition
    overwrite. The new points are written to a staging table first, so what they come from is read once; the output is staged and moved at the commit, so a lost executor, or a job that
    fails before, leaves the stored points as they were.  The rebalance splits a partition by its
    measured size, so a station with a third of all points is not one task's work.
    """
    _replace(staged(points, ingested), path)


def staged(points: DataFrame, ingested: Column | None = None) -> DataFrame:
    """New points as they are stored, one for each key, in a written table."""
    stamp = ingested if ingested is not None else (
        F.col("ingest_ts") if "ingest_ts" in points.columns else F.lit(None))
    rows = points.where(F.col("ts").isNotNull()).select(*[F.col(f.name) for f in POINTS.fields],
                         stamp.cast("timestamp_ntz").alias("ingest_ts"),
                         F.year("ts").alias("year"), F.month("ts").alias("month"), bucket_of(F.col("station_id")).alias("bucket"))
    return materialized(_latest(rows))


def latest_first() -> Column:
    """The order in which points of one key replace each other: by ingest time, then value."""
    return F.struct(F.col("ingest_ts").isNotNull(), "ingest_ts", "value")


def _latest(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(*POINT_KEYS, "year", "month", "bucket")
        .agg(F.max_by(F.struct("value", "ingest_ts"), latest_first()).alias("_last"))
        .select(*POINT_KEYS, "_last.value", "_last.ingest_ts", "year", "month", "bucket")
    )


def stored_with(path: str, new: DataFrame) -> DataFrame | None:
    """Stored points of the partitions that the staged points ``new`` fall into, or None before the first write."""
    stored = _stored(new.sparkSession, path)
    return None if stored is None else _touched(stored, new)


def _replace(new: DataFrame, path: str) -> None:
    """Write staged points over the stored ones of their keys."""
    old = stored_with(path, new)
    rows = new if old is None else _latest(old.unionByName(new))
    (
        rows.hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "station_id", "field", "ts")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS).parquet(path)
    )


def _touched(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Stored points of the partitions that ``rows`` falls into.

    The partitions are listed first (one name per folder of the store), so that the scan is
    pruned to them whatever the statistics say.
    """
    number = month_number() * BUCKETS + F.col("bucket")
    folders: dict[str, list[int]] = {}
    for row in rows.select("source", number.alias("number")).distinct().collect():
        folders.setdefault(row.source, []).append(row.number)
    condition = F.lit(False)
    for source, touched in folders.items():
        condition = condition | (F.col("source").eqNullSafe(source) & number.isin(touched))
    return stored.where(condition)
