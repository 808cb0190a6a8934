"""EPW files: all stations written in one job, many files read in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import EPW_COLUMNS, KEYS


def write_epw(header: DataFrame, lines: DataFrame, path: str, keys: Sequence[str] = KEYS) -> None:
    """Write ``(keys, line_no, line)`` rows, one file per key below ``path``.

    A file is eight header lines and the hours of the exported span, so it is one task's work. The
    header comes first whatever the years: hours before 1970 have negative numbers.
    """
    parts = [part.select(*keys, F.lit(n).alias("_part"), "line_no", "line") for n, part in enumerate((header, lines))]
    (
        parts[0].unionByName(parts[1])
        .repartition(*keys).sortWithinPartitions(*keys, "_part", "line_no")
        .select(*keys, F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy(*keys).text(path)
    )


def read_epw(spark: SparkSession, path: str, columns: Sequence[str] = ("dry_bulb_temperature",),
             partitions: str = "") -> DataFrame:
    """Event time and the wanted columns of the data lines.

    Data lines start with a four-digit year; header lines and truncated lines are dropped.
    Impossible dates and numbers that do not parse are NULL.
    ``partitions`` declares the partition columns of the folder, for example ``"station_id STRING"``.
    """
    schema = "value STRING" + (f", {partitions}" if partitions else "")
    lines = spark.read.schema(schema).text(path)
    fields = F.split("value", ",")
    kept = [c for c in lines.columns if c != "value"]
    rows = lines.where(F.col("value").rlike(r"^\d{4},")).select(*kept, fields.alias("_f")).where(
        F.size("_f") == len(EPW_COLUMNS))

    def field(name: str):
        return F.trim(F.element_at("_f", EPW_COLUMNS.index(name) + 1))

    year, month, day, hour = (field(n).try_cast("int") for n in ("year", "month", "day", "hour"))
    return rows.select(
        *kept,
        F.try_make_timestamp_ntz(year, month, day, hour - 1, F.lit(0), F.lit(0)).alias("ts"),
        *[F.when(field(c) != "", field(c)).try_cast("double").alias(c) for c in columns])
