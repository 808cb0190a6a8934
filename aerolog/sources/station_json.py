"""Landed station documents (JSON): one file, or one line, per station and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.air import kmh_to_ms
from ..operators.points import to_points
from ..schemas import STATION_DOCUMENT

NETWORK_FIELDS = ("t_db", "rh", "v_air", "wind_dir", "t_dp", "p_atm_min", "p_atm_max",
                  "rain", "prec_rate", "ghi")
_CORRUPT = "_corrupt_record"


def utc_instant(text: Column) -> Column:
    """ISO-8601 UTC text to a zone-less UTC timestamp, NULL if it is none."""
    return text.try_cast("timestamp_ntz")


def read_documents(spark: SparkSession, paths: str | list[str], one_per_file: bool = True) -> DataFrame:
    """Documents with their raw text in ``_corrupt_record`` where they do not parse."""
    schema = T.StructType([*STATION_DOCUMENT.fields, T.StructField(_CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", str(one_per_file).lower())
        .json(paths)
    )


def parse_documents(texts: DataFrame, column: str) -> DataFrame:
    """The same from a column of document texts (for example a text stream)."""
    return texts.select(F.from_json(column, STATION_DOCUMENT, {"mode": "PERMISSIVE"}).alias("_doc"),
                        F.col(column).alias("_text")).select(
        "_doc.observations", F.when(F.col("_doc.observations").isNull(), F.col("_text")).alias(_CORRUPT))


def count_rejected(documents: DataFrame) -> DataFrame:
    """How many documents were skipped because they do not parse."""
    return documents.agg(F.count_if(F.col("observations").isNull()).alias("rejected"),
                         F.count(F.lit(1)).alias("documents"))


def observations(documents: DataFrame, source: str = "network") -> DataFrame:
    """One wide row per observation in library units; documents that do not parse give none.

    The outer form keeps Spark from parsing a text document once more to test its array for
    emptiness; the empty row falls to the time filter.
    """
    rows = documents.select(F.inline_outer("observations"))
    return rows.select(
        F.lit(source).alias("source"),
        F.upper(F.trim("stationID")).alias("station_id"),
        "lat", "lon",
        utc_instant(F.col("obsTimeUtc")).alias("ts"),
        F.col("metric.tempAvg").alias("t_db"),
        F.col("humidityAvg").alias("rh"),
        kmh_to_ms(F.col("metric.windspeedAvg")).alias("v_air"),
        F.col("winddirAvg").alias("wind_dir"),
        F.col("metric.dewptAvg").alias("t_dp"),
        F.col("metric.pressureMin").alias("p_atm_min"),
        F.col("metric.pressureMax").alias("p_atm_max"),
        F.col("metric.precipTotal").alias("rain"),
        F.col("metric.precipRate").alias("prec_rate"),
        F.col("solarRadiationHigh").alias("ghi"),
    ).where(F.col("ts").isNotNull())


def station_points(documents: DataFrame, source: str = "network") -> DataFrame:
    """Documents to points."""
    return to_points(observations(documents, source), NETWORK_FIELDS,
                     ("source", "station_id", "lat", "lon", "ts"))
