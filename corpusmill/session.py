"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def build_session(app_name: str = "corpusmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; deployment settings stay with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's checkpoint folder, readable by every executor.

    A machine-local folder is used only in local mode, where driver and executors share one disk.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="corpusmill-")
            atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
        base = _local_scratch
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Spark drops the shuffle files of an execution when it ends, if this is set.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, purpose: str, slices: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: reliable, and it cuts the lineage.

    The written table stands for all that led to it, so the shuffle files of this execution go as it ends.
    A table that is read slice by slice names the column of its slices, each of which is a folder of its own.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    writer = df.write if slices is None else df.write.partitionBy(slices).option("compression", "zstd")
    known = spark.conf.isModifiable(_DROP_SHUFFLES)
    # None for a setting that nobody set, which says nothing about whether Spark knows it.
    before = spark.conf.get(_DROP_SHUFFLES, None)
    if known:
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        if known and before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        elif known:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Empty a table that `materialize` wrote and nothing reads any more, so that long jobs do not fill the shared folder."""
    folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    empty = table.sparkSession.createDataFrame([], table.schema)
    for folder in folders:
        here = folder.rsplit("/", 1)[1].partition("=")
        (empty.drop(here[0]) if here[1] else empty).write.mode("overwrite").parquet(folder)
