"""Checks on a table's keys and coverage, each one aggregation or anti join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def rows_and_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows and of distinct keys. A key with a null part is not counted as a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.when(complete, 1)).alias("n_keys"),
    )


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each stage."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("stage"), "n_rows") for n, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


def missing_keys(left: DataFrame, right: DataFrame, key: str, *, strict_null: bool = False) -> DataFrame:
    """Rows of ``left`` whose ``key`` is not in ``right``.

    ``strict_null`` follows SQL ``NOT IN``: rows with a null key never qualify, and one
    null key in ``right`` leaves no row at all.
    """
    found = left.join(right.select(key).dropna().distinct(), key, "left_anti")
    if not strict_null:
        return found
    # One uncorrelated subquery value each. An empty right side lets every row through.
    known = right.agg(F.count(F.when(F.col(key).isNull(), 1)) == 0).scalar()
    empty = right.agg(F.count(F.lit(1)) == 0).scalar()
    return found.filter(empty | (known & F.col(key).isNotNull()))


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only."""
    only_left = missing_keys(left.select(key).distinct(), right, key).withColumn("missing_in", F.lit("right"))
    only_right = missing_keys(right.select(key).distinct(), left, key).withColumn("missing_in", F.lit("left"))
    return only_left.unionByName(only_right)


def several_parents(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Ids that belong to more than one parent."""
    pairs = df.select(key, parent).distinct()
    return pairs.groupBy(key).agg(F.count(parent).alias("n_parents")).filter("n_parents > 1")


def average_children(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Distinct children per parent: mean, total and number of parents."""
    per_parent = df.select(parent, child).distinct().groupBy(parent).agg(F.count(child).alias("n"))
    return per_parent.agg(
        F.try_divide(F.sum("n"), F.count(parent)).alias("per_known_parent"),
        F.avg("n").alias("average"),
        F.sum("n").alias("children"),
        F.count(parent).alias("parents"),
    )
