"""Typical-year CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import UNIT_NAMES


def write_typical_year(rows: DataFrame, path: str, columns: Sequence[str],
                       partitions: Sequence[str] = ("method", "station_id")) -> None:
    """One file per combination of ``partitions``, in time order, with unit-bearing column names.

    A combination is one typical year of 8,760 rows, so a file is always one task's work.
    """
    (
        rows.select(*partitions, F.col("tmy_ts").alias("timestamp"),
                    *[F.col(c).alias(UNIT_NAMES.get(c, c)) for c in columns])
        .repartition(*partitions).sortWithinPartitions(*partitions, "timestamp")
        .write.mode("overwrite").option("header", "true")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .partitionBy(*partitions).csv(path)
    )


def read_typical_year(spark: SparkSession, path: str, columns: Sequence[str],
                      partitions: str = "method STRING, station_id STRING") -> DataFrame:
    """Read what :func:`write_typical_year` wrote, back under plain names."""
    fields = ", ".join(f"`{UNIT_NAMES.get(c, c)}` DOUBLE" for c in columns)
    parts = f", {partitions}" if partitions else ""
    rows = (
        spark.read.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .schema(f"`timestamp` TIMESTAMP_NTZ, {fields}{parts}").csv(path)
    )
    kept = [c for c in rows.columns if c != "timestamp" and c not in {UNIT_NAMES.get(c, c) for c in columns}]
    return rows.select(*kept, F.col("timestamp").alias("tmy_ts"),
                       *[F.col(f"`{UNIT_NAMES.get(c, c)}`").alias(c) for c in columns])


def read_named_files(spark: SparkSession, paths: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Files named ``{station}_{ISO|mean}_TMY_..._{first}_{last}.csv``; the name becomes columns."""
    fields = ", ".join(f"`{UNIT_NAMES.get(c, c)}` DOUBLE" for c in columns)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv$", 1)
    pattern = r"^(.+)_(ISO|mean)_TMY_(?:(.+)_)?(\d{4})_(\d{4})$"
    rows = (
        spark.read.option("header", "true").schema(f"`timestamp` TIMESTAMP_NTZ, {fields}").csv(paths)
        .withColumn("_name", name)
    )
    parts = {"station_id": 1, "method": 2, "source": 3}
    return rows.select(
        *[F.regexp_extract("_name", pattern, g).alias(n) for n, g in parts.items()],
        F.concat_ws("-", F.regexp_extract("_name", pattern, 4),
                    F.regexp_extract("_name", pattern, 5)).alias("period"),
        F.col("timestamp").alias("tmy_ts"),
        *[F.col(f"`{UNIT_NAMES.get(c, c)}`").alias(c) for c in columns])
