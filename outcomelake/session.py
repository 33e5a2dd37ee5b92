"""Session settings the operators rely on, kept in one place."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
FREE_SHUFFLES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings that must be given when the session starts.  Shuffle partition
# counts are left to the cluster: AQE coalesces small ones and splits skewed
# ones, so only tests pin a number.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later aggregation then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stack capture per column call costs milliseconds in plans of hundreds of columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "outcomelake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results and skew handling rely on, on a session made elsewhere."""
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.sources.partitionOverwriteMode",
        "spark.sql.adaptive.forceOptimizeSkewedJoin",
    ):
        spark.conf.set(key, SETTINGS[key])
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, storage that the driver and every executor see."""
    base = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if not base:
        raise ValueError(f"set {CHECKPOINT_DIR_KEY} to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside are deleted as each job ends, not when the driver next collects garbage.

    For jobs whose plans run once and are made inside, as those of writes are.
    """
    before = spark.conf.get(FREE_SHUFFLES_KEY, None)
    spark.conf.set(FREE_SHUFFLES_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES_KEY)
        else:
            spark.conf.set(FREE_SHUFFLES_KEY, before)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to shared storage and read back, for results used several times.

    Cuts the lineage at a table that survives lost executors and lets later
    filters reach a Parquet scan.
    """
    path = shared_folder(df.sparkSession, purpose)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator:
    """``materialize`` for the length of a step: its tables are deleted where the step ends, also by an error.

    For tables that no result reads any more by then.
    """
    paths: list[str] = []

    def keep(df: DataFrame, purpose: str, *by: str) -> DataFrame:
        """``by`` names columns that the folders spell out; rows are dealt by them already."""
        path = shared_folder(spark, purpose)
        paths.append(path)
        with freed_shuffles(df.sparkSession):
            df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
