"""Tables laid out for their readers: bucketed and sorted by the key that roll-ups and joins share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.hot import HOT_ROWS, MARK, hot_keys, mark_hot
from waymark.session import shared_folder


@dataclass(frozen=True)
class LaidOut:
    """A table in two parts without a key in common.

    ``cold`` is bucketed by the key, so aggregations and joins on it, or on more columns
    with it, need no exchange. ``hot`` holds the rows of missing keys and of keys too large
    for one task, as plain files.
    """

    cold: DataFrame
    hot: DataFrame

    def apply(self, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``job`` on both parts, united; it must work key by key."""
        return reduce(DataFrame.unionByName, map(job, (self.cold, self.hot)))


def lay_out(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    *,
    buckets: int,
    sort: Sequence[str] = (),
    path: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> LaidOut:
    """Write ``df`` bucketed by ``keys`` and sorted by them and ``sort`` inside a bucket.

    One shuffle on the keys here takes the place of one in every reader. ``buckets`` should
    make a bucket some 100 to 500 MB. ``df`` is read three times (counts, cold, hot): stage
    an expensive one. The table is entered in the session's catalog under a fresh name; its
    files go to ``path``, by default the shared folder.
    """
    spark = df.sparkSession
    folder = path or f"{shared_folder(spark)}/waymark/{uuid.uuid4().hex}/{name}"
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    marked = mark_hot(df, hot_keys(df.dropna(subset=list(keys)), keys, hot_rows), keys)
    apart = missing | F.col(MARK).isNotNull()
    marked.filter(apart).drop(MARK).write.mode("overwrite").parquet(f"{folder}/hot")
    entry = f"{name}_{uuid.uuid4().hex}"
    (
        marked.filter(~apart)
        .drop(MARK)
        .repartition(buckets, *keys)
        .write.mode("overwrite")
        .option("path", f"{folder}/cold")
        .bucketBy(buckets, *keys)
        .sortBy(*keys, *sort)
        .saveAsTable(entry)
    )
    return LaidOut(spark.table(entry), spark.read.schema(df.schema).parquet(f"{folder}/hot"))
