"""From landed files to stored points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..sources import gridded_csv, point_store, station_json


def ingest_network(spark: SparkSession, landing: str | list[str], store: str, ingested: Column) -> None:
    """Station documents of any number of stations and months into the point store."""
    documents = station_json.read_documents(spark, landing)
    point_store.write_points(station_json.station_points(documents), store, ingested)


def ingest_gridded(spark: SparkSession, landing: str | list[str], store: str, ingested: Column) -> None:
    """Gridded extracts of any number of places into the point store."""
    hourly = gridded_csv.read_hourly(spark, landing)
    point_store.write_points(gridded_csv.gridded_points(hourly), store, ingested)


def station_list(points: DataFrame) -> DataFrame:
    """The stations a store knows."""
    return points.select("source", "station_id").distinct()
