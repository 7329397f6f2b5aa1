"""Distinct counts that can be added up: exact bitmaps per finest group, rolled up to any coarser one.

Distinct counts of small groups do not sum to that of a large one, so every drill-down would
read the facts again. Here entities are numbered densely once and each group keeps one bitmap
per condition and 32,768 entities; a coarser group is the union of bitmaps, which combines
map-side. A state row is 4 KB whatever the number of facts behind it; a group has as many as
blocks its entities fall into, so states pay where groups are read often or hold many entities.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.sequence import sequence
from waymark.sources.sinks import Stage, unstaged

MEASURE, BUCKET, BITS = "measure", "bucket", "bits"


def distinct_states(
    df: DataFrame, dimensions: Sequence[str], entity: str, conditions: Mapping[str, Column], stage: Stage = unstaged
) -> DataFrame:
    """One row per group of ``dimensions``, condition and block of entities: the entities that meet the condition.

    A group in which nobody meets any condition, or without any entity, keeps one empty row.
    Null entities never count; null dimensions are a group. Numbering reads the distinct
    entities several times: ``stage`` them.
    """
    flags = df.groupBy(*dimensions, entity).agg(
        *[F.max(F.when(cond, True).otherwise(False)).alias(f"__{name}") for name, cond in conditions.items()]
    )
    flags = stage(flags, "distinct_flags")
    # People of one group get neighbouring numbers, so a small group's bitmaps are few.
    near = F.min(F.xxhash64(*dimensions)) if dimensions else F.lit(0)
    entities = stage(flags.dropna(subset=[entity]).groupBy(entity).agg(near.alias("__near")), "distinct_entities")
    numbered = stage(sequence(entities, [], ["__near", entity], rank="__number").drop("__near"), "distinct_numbers")
    met = F.array_compact(F.array(*[F.when(F.col(f"__{name}"), F.lit(name)) for name in conditions]))
    known = F.col("__number").isNotNull()
    rows = flags.join(numbered, entity, "left").select(
        *dimensions, "__number", F.explode_outer(F.when(known, met)).alias(MEASURE)
    )
    # The empty row of a group says that it exists; it holds no entity.
    place = F.when(F.col(MEASURE).isNotNull(), F.col("__number"))
    return rows.groupBy(*dimensions, MEASURE, F.bitmap_bucket_number(place).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(BITS)
    )


def distinct_roll_up(states: DataFrame, dimensions: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct entities per group of ``dimensions``, some or none of those the states were made for."""
    blocks = states.groupBy(*dimensions, MEASURE, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(BITS)).alias("__n"))
    # An entity is in one block, so blocks add up.
    return blocks.groupBy(*dimensions).agg(
        *[F.coalesce(F.sum(F.when(F.col(MEASURE) == m, F.col("__n"))), F.lit(0)).cast("bigint").alias(m) for m in measures]
    )
