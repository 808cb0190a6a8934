"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on; all can be overridden by the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "aerolog",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster, use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # call sites in error messages cost a round trip to the JVM per column
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        # small tables: rows are dear (solar geometry, filled gaps) though their bytes are few
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/aerolog-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="aerolog-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal ``keys`` in one task, over all ``spark.sql.shuffle.partitions``.

    With a number given, the runtime leaves the parts as they are. It would merge them by their
    compressed bytes, but the aggregates and sorts of one task take more than twenty times these.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def bucketed(df: DataFrame, keys: Sequence[str], sort: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """:func:`materialized`, with the rows of equal ``keys`` in one bucket: aggregates, windows and joins by them then move nothing.

    Rows that are already clustered by the keys are written where they are. The files lie in the shared
    folder; the session's catalog holds the table's name for as long as the session lives.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_folder(spark)
    name = "aerolog_" + uuid.uuid4().hex
    writer = df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys)
    (writer.sortBy(*sort) if sort else writer).option("path", f"{folder}/table").saveAsTable(name)
    return spark.table(name)


def materialized(df: DataFrame) -> DataFrame:
    """Write an intermediate table that several results read, and read it back.

    It lies in the shared folder, so it cuts the lineage and survives the loss of executors.
    """
    folder = f"{scratch_folder(df.sparkSession)}/table"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def released(spark: SparkSession) -> None:
    """Let Spark remove what finished jobs have shuffled.

    Its cleaner does so as soon as the driver has collected the plans of these jobs, which may else take until the end. The
    tables that :func:`materialized` wrote need none of it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discarded(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialized` wrote and nothing reads any more."""
    for table in tables:
        jvm, spark = table.sparkSession.sparkContext._jvm, table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
