"""Sums over the events near each point in time, without joining points to events.

Events and the two ends of every point's window are sorted together per key, and the sums
so far are kept while walking up. A window's sum is the sum at its end less the sum at its
beginning, so a key with many points *and* many events costs their number, not their
product. A hot key is cut into even ranges, and a summary with one row per range carries
the sums of earlier ranges, as in :mod:`waymark.operators.sequence`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.hot import CHUNK, HOT_ROWS, MARK, cut_hot


@dataclass(frozen=True)
class Span:
    """Events from ``low`` to ``high`` seconds after the point; an open span leaves both ends out."""

    low: int
    high: int
    closed: bool = True


def window_sums(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    at: str,
    event_at: str,
    spans: Mapping[str, Span],
    sums: Mapping[str, tuple[str, Column]],
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``points`` plus one sum per entry of ``sums``, which names its span and the events' whole numbers to add.

    An event counts for a point with equal ``keys`` when its time lies in the span around
    the point's. Sums are 0 where nothing lies there, and for points without a key or time.
    Rows of ``points`` must differ: give equal ones as one row with their number.
    """
    columns = points.columns
    known = F.col(at).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    moment = F.unix_micros(at)
    # At one instant: what begins a closed span or ends an open one, then events, then the others.
    ends = [
        F.struct(
            F.lit(name).alias("__span"),
            F.lit(sign).alias("__sign"),
            (moment + F.lit(seconds * 1_000_000)).alias("__at"),
            F.lit(0 if span.closed == (sign < 0) else 2).alias("__kind"),
        )
        for name, span in spans.items()
        for sign, seconds in ((-1, span.low), (1, span.high))
    ]
    names = list(sums)
    zero = [F.lit(0).cast("bigint").alias(f"__v{i}") for i in range(len(names))]
    probes = points.filter(known).select("*", F.explode(F.array(*ends)).alias("__e"))
    probes = probes.select(*columns, "__e.*", *zero).withColumn("__tie", F.xxhash64(*columns))
    values = [F.coalesce(value.cast("bigint"), F.lit(0)).alias(f"__v{i}") for i, (_, value) in enumerate(sums.values())]
    happened = events.dropna(subset=[*keys, event_at]).select(
        *keys, F.unix_micros(event_at).alias("__at"), F.lit(1).alias("__kind"), *values
    )
    happened = happened.withColumn("__tie", F.xxhash64("__at", *[f"__v{i}" for i in range(len(names))]))
    order = ["__at", "__kind", "__tie"]
    probes, happened = cut_hot([probes, happened], keys, [F.col(c) for c in order], hot_rows)

    totals = [F.sum(f"__v{i}").alias(f"__v{i}") for i in range(len(names))]
    summary = happened.filter(MARK).select(*keys, CHUNK, *[f"__v{i}" for i in range(len(names))])
    # Ranges without events still need what came before them.
    ranges = summary.unionByName(probes.filter(MARK).select(*keys, CHUNK, *[f"__v{i}" for i in range(len(names))]))
    ranges = ranges.groupBy(*keys, CHUNK).agg(*totals)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.select(
        *keys,
        CHUNK,
        F.lit(-1).alias("__kind"),
        *[F.coalesce(F.sum(f"__v{i}").over(earlier), F.lit(0)).alias(f"__v{i}") for i in range(len(names))],
    )
    rows = probes.drop(MARK).unionByName(happened.drop(MARK), allowMissingColumns=True)
    rows = rows.unionByName(carry, allowMissingColumns=True)
    # The carry row has no time and leads its range.
    so_far = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.select(
        *columns, "__span", "__sign", *[F.sum(f"__v{i}").over(so_far).alias(f"__s{i}") for i in range(len(names))]
    ).filter("__sign IS NOT NULL")
    per_point = [
        F.sum(F.when(F.col("__span") == span, F.col("__sign") * F.col(f"__s{i}")).otherwise(0)).alias(name)
        for i, (name, (span, _)) in enumerate(sums.items())
    ]
    found = summed.groupBy(*columns).agg(*per_point)
    rest = points.filter(~known).select(*columns, *[F.lit(0).cast("bigint").alias(n) for n in names])
    return found.unionByName(rest)
