"""Small lists: stations to process, reference stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import REFERENCE_STATIONS


def split_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    """Station ids of comma-separated lines: trimmed, upper-cased, without empties."""
    ids = lines.select(F.explode(F.split(column, ",")).alias("id"))
    return ids.select(F.upper(F.trim("id")).alias("id")).where(F.col("id") != "")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return split_ids(spark.read.text(path))


def read_reference_stations(spark: SparkSession, path: str) -> DataFrame:
    """``;``-separated reference stations; ``wmo`` keeps its leading zeros."""
    return spark.read.schema(REFERENCE_STATIONS).option("sep", ";").option("header", "true").csv(path)
