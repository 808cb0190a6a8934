"""Gridded re-analysis extracts (CSV text with a preamble), one file per place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.air import nan_to_null
from ..operators.points import to_points
from ..schemas import GRIDDED_HOURLY

HOURLY_FIELDS = tuple(name for name, _ in GRIDDED_HOURLY)


def fields_of(header: str, known: Sequence[tuple[str, str]] = GRIDDED_HOURLY) -> tuple[str, ...]:
    """Field names, in file order, of an extract with another set of columns.

    ``header`` is the file's own header line; columns that are not known are named ``_<position>``
    and do not become points.
    """
    names = {text: name for name, text in known}
    columns = [c.strip() for c in header.strip().split(",")]
    if columns[0] != "time":
        raise ValueError("the header of a gridded extract starts with 'time'")
    return tuple(names.get(c, f"_{n}") for n, c in enumerate(columns[1:], start=1))


def parse_lines(lines: DataFrame, fields: Sequence[str], time: str = "timestamp_ntz",
                column: str = "value") -> DataFrame:
    """Keep the data lines (they start with a date) and split them; preambles and headers go."""
    schema = ", ".join(["`time` STRING", *[f"`{f}` DOUBLE" for f in fields]])
    name = "day" if time == "date" else "ts"
    data = lines.where(F.col(column).rlike(r"^\d{4}-\d{2}-\d{2}"))
    kept = [c for c in lines.columns if c != column]
    rows = data.select(*kept, F.from_csv(F.col(column), schema, {"mode": "PERMISSIVE"}).alias("_r"))
    return rows.select(*kept, F.col("_r.time").try_cast(time).alias(name),
                       *[nan_to_null(F.col(f"_r.{f}")).alias(f) for f in fields])


def place_in_path(path: Column) -> dict[str, Column]:
    """``lat``, ``lon`` and, if named, ``station_id`` from folders ``station_id=X/lat=45.07/lon=7.69``."""
    station = F.regexp_extract(path, r"station_id=([^/]+)/", 1)
    return {
        "station_id": F.when(station != "", F.upper(station)),
        **{n: F.regexp_extract(path, rf"{n}=(-?[0-9.]+)", 1).try_cast("double") for n in ("lat", "lon")},
    }


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with the file they come from."""
    return spark.read.option("recursiveFileLookup", "true").text(paths).select(
        F.col("_metadata.file_path").alias("path"), "value")


def parse_by_header(lines: DataFrame, known: Sequence[tuple[str, str]] = GRIDDED_HOURLY) -> DataFrame:
    """Data lines of files ``(path, value)`` by the column names of each file's own header.

    Unknown columns are ignored, absent ones are NULL, as is everything in a file without a header.
    A file adds one row to the side that holds the headers.
    """
    names = F.transform(F.split("value", ","), lambda c: F.trim(c))
    places = F.struct(*(F.array_position("_names", text).alias(name) for name, text in known))
    headers = (lines.where(F.col("value").rlike(r"^\s*time\s*,")).select("path", names.alias("_names"))
               .groupBy("path").agg(F.min("_names").alias("_names")).select("path", places.alias("_at")))
    data = lines.where(F.col("value").rlike(r"^\d{4}-\d{2}-\d{2}")).withColumn("_parts", F.split("value", ","))
    kept = [c for c in lines.columns if c != "value"]

    def cell(name: str) -> Column:
        at = F.col("_at")[name]
        return F.when(at > 0, F.trim(F.get("_parts", (at - 1).cast("int"))).try_cast("double"))

    return data.join(headers, "path", "left").select(
        *kept, F.trim(F.get("_parts", F.lit(0))).try_cast("timestamp_ntz").alias("ts"),
        *(nan_to_null(cell(name)).alias(name) for name, _ in known))


def read_hourly(spark: SparkSession, paths: str | list[str], fields: Sequence[str] | None = None) -> DataFrame:
    """Hourly extracts, columns by each file's header; ``fields`` reads files by position instead."""
    lines = read_lines(spark, paths).withColumns(place_in_path(F.col("path")))
    return parse_by_header(lines) if fields is None else parse_lines(lines, fields)


def read_daily(spark: SparkSession, paths: str | list[str],
               fields: Sequence[str] = ("t_db",)) -> DataFrame:
    lines = read_lines(spark, paths)
    return parse_lines(lines.withColumns(place_in_path(F.col("path"))), fields, "date")


def gridded_points(hourly: DataFrame, source: str = "gridded") -> DataFrame:
    """Hourly rows to points; where no station is named, the place is the station."""
    place = F.concat_ws("_", F.col("lat").cast("string"), F.col("lon").cast("string"))
    rows = hourly.withColumns({
        "source": F.lit(source), "station_id": F.coalesce(F.col("station_id"), place)})
    fields = [f for f in HOURLY_FIELDS if f in hourly.columns]
    return to_points(rows, fields, ("source", "station_id", "lat", "lon", "ts"))
