"""Spark session for local runs; on a cluster the caller passes its own session."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "8", app: str = "lakejobs", **conf: str) -> SparkSession:
    """Local session with the settings the jobs expect (UTC, ANSI, AQE)."""
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the one the session names, else a new local one.

    A cluster names a folder that every executor reaches in
    ``spark.checkpoint.dir``; only where nothing is set and all runs on one
    machine (a local master, as in tests) is a fresh temporary folder made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if named:
        if not current:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("name a folder that all executors reach in spark.checkpoint.dir")
    import tempfile

    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder, for a frame that a job reads several times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def filed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the checkpoint folder: readers open the columns they ask for, and sizes are known.

    Unlike a checkpoint it hands on none of the conditions that Spark knows to hold for ``df``.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    A zip of the sources is handed to Spark, which brings it to every executor,
    so jobs with Python functions run whatever folder the driver was started in.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    import shutil
    import tempfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    built = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(built)
    _SHIPPED.add(context.applicationId)
