"""Session settings and the shared folder that frozen intermediate tables are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "holdshort", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew-join splitting; the master comes from spark-submit if unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # frozen tables go away with the last plan that reads them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # call-site capture costs more than building the expressions of a wide plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, else the context's, else one below the warehouse.

    All three are on storage that driver and executors share, and are only reached through Spark.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is written there goes when the session's process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context.hadoopConfiguration()).deleteOnExit(place)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path before the session's process ends."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def freeze(df: DataFrame) -> DataFrame:
    """Write a table that several branches read to the shared folder, and go on from the copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
