"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "waymark") -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column expression takes longer than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Every job reads wall-clock columns as UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, falls back to a
    fresh temporary folder; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="waymark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
