"""Many conditional distinct counts of one entity in two plain aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_distinct_counts(
    df: DataFrame, keys: Sequence[str], entity: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """``count(distinct case when cond then entity end)`` for each named condition.

    Written directly, Spark expands every input row once per distinct count. Reducing to
    one row of flags per (keys, entity) first needs no expansion, and both steps combine
    map-side, so a hot ``keys`` value is spread over its entities.
    """
    flags = df.groupBy(*keys, entity).agg(
        *[F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in conditions.items()]
    )
    counted = F.col(entity).isNotNull()
    return flags.groupBy(*keys).agg(
        *[F.sum(F.when(counted, F.col(name)).otherwise(0)).cast("bigint").alias(name) for name in conditions]
    )
