"""Snapshots as validity intervals: a history as long as its changes, not as its snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.asof import asof_neighbours
from waymark.operators.hot import HOT_ROWS
from waymark.operators.sequence import sequence


def validity_intervals(
    history: DataFrame, keys: Sequence[str], at: str, payload: Sequence[str], *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``keys``, ``payload``, valid_from and valid_until: one row per run of equal consecutive snapshots.

    ``valid_until`` is where the next run begins, null for the last. Snapshots without a time
    are left out. Of several at one instant the greatest by ``payload`` counts. A key with
    very many snapshots is cut into ranges, as in :func:`sequence`.
    """
    known = history.select(*keys, F.col(at).alias("valid_from"), *payload).filter("valid_from IS NOT NULL")
    # One snapshot an instant: combined before the shuffle, where keep_first would sort them.
    held = known.groupBy(*keys, "valid_from").agg(F.max(F.struct(*payload)).alias("__held"))
    stepped = sequence(held, keys, ["valid_from"], rank="__n", lag={"__before": "__held"}, hot_rows=hot_rows)
    starts = stepped.filter((F.col("__n") == 1) | ~F.col("__held").eqNullSafe(F.col("__before")))
    starts = starts.select(*keys, "valid_from", "__held")
    ended = sequence(starts, keys, ["valid_from"], rank="__n", lead={"valid_until": "valid_from"}, hot_rows=hot_rows)
    return ended.select(*keys, *[F.col("__held").getField(c).alias(c) for c in payload], "valid_from", "valid_until")


def valid_at(
    rows: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, payload: Sequence[str], *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` plus the ``payload`` that held at their time; null before the first snapshot."""
    found = asof_neighbours(
        rows, intervals, keys, F.col(at), F.col("valid_from"), list(payload), hot_rows=hot_rows
    )
    return found.select(*rows.columns, *[F.col("prev").getField(c).alias(c) for c in payload])
