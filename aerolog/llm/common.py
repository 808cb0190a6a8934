"""What the operators of this folder share: reading tables, free column names, texts as byte arrays."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows that Python works on at once.
BATCH_ROWS = 256
#: Bytes of text that numpy works on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_for_python(spark: SparkSession) -> None:
    """Let workers of this machine import the package. On a cluster it is installed on the executors or shipped with the job."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), ROOT]))


def small(batches: Iterator[pa.Array | pa.RecordBatch]) -> Iterator[pa.Array | pa.RecordBatch]:
    """Batches of at most ``BATCH_ROWS`` rows, whatever the session puts into one; an empty one stays."""
    for batch in batches:
        for k in range(0, max(len(batch), 1), BATCH_ROWS):
            yield batch.slice(k, BATCH_ROWS)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the eager work inside; it is as before afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession):
    """For eager work inside: batches of ``BATCH_ROWS`` rows, as texts can be long and a task holds a batch at a time."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front if a column is already called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's text begins (n + 1 places); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    places = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[places[0]:places[-1]]
    return data, places - places[0]


def pieces(places: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[i, j)`` that hold at most ``most`` bytes, or one row."""
    i, n = 0, len(places) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(places, places[i] + most, "right")) - 1)
        yield i, j
        i = j
