"""As-of neighbours: for each left row the nearest right row before and after it in time.

Both sides are sorted together per key, and the last right row seen is kept while walking
up, the next one while walking down. No pair of rows is ever formed. A key with more than
``hot_rows`` rows is cut into even ranges of that order
(:func:`waymark.operators.hot.cut_hot`), also within one instant; a summary of the hot keys
carries the last right row of earlier ranges and the first one of later ranges. Both
inputs are read several times: stage an expensive one first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.hot import CHUNK, HOT_ROWS, MARK, cut_hot


def asof_neighbours(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: Column,
    right_at: Column,
    payload: Sequence[str],
    *,
    right_order: Sequence[str] = (),
    equal_is_before: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Return ``left`` plus structs ``prev``, ``next`` and ``earliest`` of right ``payload``.

    ``prev`` is the last right row at or before ``left_at`` (strictly before when
    ``equal_is_before`` is false), ``next`` the first one after it (from the same instant
    on, in the strict case), ``earliest`` the first right row of the key.
    ``right_order`` breaks ties between right rows at one instant.
    """
    keys = list(keys)
    # Ties are broken by the fields in their order; one that is payload too is held once.
    held = [F.col(c) if c in payload else F.col(c).alias(f"o{i}") for i, c in enumerate(right_order)]
    hit = F.struct(right_at.alias("at"), *held, *[c for c in payload if c not in right_order])
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    bare, left = left.filter(keyless), left.filter(~keyless)
    l_side, r_side = (1, 0) if equal_is_before else (0, 1)
    lefts = left.select("*", left_at.alias("__at"), F.lit(l_side).alias("__side"))
    rights = (
        right.dropna(subset=keys)
        .select(*keys, right_at.alias("__at"), F.lit(r_side).alias("__side"), hit.alias("__hit"))
        .filter("__at IS NOT NULL")
    )
    # Left rows at one instant have no order of their own; a hash lets them be cut apart.
    tie = F.xxhash64(*[c for c, t in left.dtypes if not t.startswith(("map", "variant"))])
    lefts = lefts.withColumns({"__hit": F.lit(None).cast(rights.schema["__hit"].dataType), "__tie": tie})
    rights = rights.withColumn("__tie", F.lit(0).cast("bigint"))
    along = [F.col("__at"), F.col("__side"), F.col("__hit"), F.col("__tie")]
    lefts, rights = cut_hot([lefts, rights], keys, along, hot_rows)
    lefts = lefts.drop("__hit")

    spine = (
        rights.filter(MARK)
        .select(*keys, CHUNK, "__hit")
        .unionByName(lefts.filter(MARK).select(*keys, CHUNK), allowMissingColumns=True)
        .groupBy(*keys, CHUNK)
        .agg(F.min("__hit").alias("__head"), F.max("__hit").alias("__tail"))
    )
    forward = Window.partitionBy(*keys).orderBy(F.col(CHUNK).asc())
    backward = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc())
    to_before = (Window.unboundedPreceding, -1)
    carry = spine.select(
        *keys,
        CHUNK,
        F.last("__tail", ignorenulls=True).over(forward.rowsBetween(*to_before)).alias("__seen"),
        F.last("__head", ignorenulls=True).over(backward.rowsBetween(*to_before)).alias("__coming"),
        F.min("__head").over(Window.partitionBy(*keys)).alias("__earliest"),
    )

    rows = (
        lefts.drop(MARK)
        .withColumn("__kind", F.lit("left"))
        .unionByName(rights.drop(MARK).withColumn("__kind", F.lit("right")), allowMissingColumns=True)
        .unionByName(carry.withColumn("__kind", F.lit("carry")), allowMissingColumns=True)
    )
    is_carry = F.col("__kind") == "carry"
    cell = Window.partitionBy(*keys, CHUNK)
    # The carry row leads the chunk in both directions.
    up = cell.orderBy(is_carry.desc(), *[c.asc() for c in along])
    down = cell.orderBy(is_carry.desc(), *[c.desc() for c in along])
    so_far = (Window.unboundedPreceding, Window.currentRow)
    found = rows.select(
        *left.columns,
        "__kind",
        "__at",
        F.last(F.coalesce("__seen", "__hit"), ignorenulls=True).over(up.rowsBetween(*so_far)).alias("prev"),
        F.last(F.coalesce("__coming", "__hit"), ignorenulls=True).over(down.rowsBetween(*so_far)).alias("next"),
        F.min(F.coalesce("__earliest", "__hit")).over(cell).alias("earliest"),
    )
    # A left row without a time has no neighbours.
    timed = [F.when(F.col("__at").isNotNull(), F.col(c)).alias(c) for c in ("prev", "next", "earliest")]
    out = found.filter("__kind = 'left'").select(*left.columns, *timed)
    # A left row with a missing key can match nothing and goes round the sort.
    nothing = [F.lit(None).cast(out.schema[c].dataType).alias(c) for c in ("prev", "next", "earliest")]
    return out.unionByName(bare.select("*", *nothing))
