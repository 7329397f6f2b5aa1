"""Keep the first row (or all rows tied for first) of each group.

Spark turns ``row_number() = 1`` into a per-partition limit before the shuffle
(``WindowGroupLimit``), so a group with most of the table still sends one row per input
partition to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order``, which should be total for a stable result."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.row_number().over(window)).filter("__first = 1").drop("__first")


def keep_first_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """All rows that share the first place within ``keys``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__first", F.rank().over(window)).filter("__first = 1").drop("__first")
