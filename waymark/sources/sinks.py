"""Writers: full refresh and one-day partition replace."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waymark.session import shared_folder


Stage = Callable[[DataFrame, str], DataFrame]


def stamp(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Add the run date as ``extract_date``."""
    return df.withColumn("extract_date", F.lit(run_date).cast("timestamp"))


def full_refresh(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def unstaged(df: DataFrame, name: str) -> DataFrame:
    """Leave an intermediate table as part of the plan."""
    return df


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For results that several later steps read: they are computed once, survive the loss
    of executors, and later joins are planned with their true size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/waymark/{uuid.uuid4().hex}/{name}"
    full_refresh(df, path)
    return spark.read.schema(df.schema).parquet(path)


class CountedStage:
    """:func:`stage` that counts rows while it writes them, so checking a build takes no scan of its own."""

    def __init__(self) -> None:
        self.seen: list[tuple[str, Observation]] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        seen = Observation(f"{len(self.seen)} {name}")
        self.seen.append((name, seen))
        written = stage(df.observe(seen, F.count(F.lit(1)).alias("n_rows")), name)
        return written

    def counts(self, spark: SparkSession) -> DataFrame:
        """stage and n_rows of every table written so far, in order of writing; known once they are written."""
        rows = [(name, int(seen.get["n_rows"])) for name, seen in self.seen]
        return spark.createDataFrame(rows, "stage string, n_rows long")


def replace_days(df: DataFrame, path: str, day: str = "extract_date") -> None:
    """Overwrite only the ``day`` partitions present in ``df``; other days stay as they are.

    Rows are rebalanced by day first: without that every task writes a small file for
    each of its days, and adaptive execution still splits a large day over several tasks.
    """
    (
        df.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .partitionBy(day)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
