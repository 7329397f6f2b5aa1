"""Equi-join with a time window, split by time so that a hot key does not land in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.hot import HOT_ROWS
from waymark.operators.lookup import SALTS, lookup_join

#: Columns that with the keys say where :func:`interval_join` brought a left row.
PLACE = ("__bucket", "__salt")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    *,
    before: int,
    after: int,
    matches: Callable[[Column, Column], Column],
    how: str = "inner",
    row_id: Sequence[str] | None = None,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    keep_place: bool = False,
) -> DataFrame:
    """Join rows with equal ``keys`` whose times satisfy ``matches(left_at, right_at)``.

    ``before`` and ``after`` bound, in seconds, how far the right time may lie before or
    after the left time; ``matches`` then decides exactly. Time is cut into buckets of
    that width: a left row has one bucket, a right row is copied to the two or three
    buckets its window touches, and the bucket is part of the join key, so rows of a key
    meet only their neighbours in time. A bucket of a key that is still too large is split
    further by :func:`lookup_join`. Put the smaller table on the right. Other column names
    must not clash. ``keep_place`` leaves bucket and sub-key in the columns ``PLACE``: a
    window or grouping on ``keys``, those and more needs no shuffle after the join.
    """
    width = before + after
    second = F.unix_seconds(F.col(right_at))
    bucket = F.floor(F.unix_seconds(F.col(left_at)) / width)
    # One second of slack on each side covers fractions cut off by whole seconds.
    slots = F.sequence(F.floor((second - after - 1) / width), F.floor((second + before + 1) / width))
    rights = right.withColumn("__bucket", F.explode(slots))
    joined = lookup_join(
        left.withColumn("__bucket", bucket),
        rights,
        [*keys, "__bucket"],
        how,
        matches=matches(F.col(left_at), F.col(right_at)),
        row_id=row_id or left.columns,
        hot_from=None if hot_from is None else hot_from.withColumn("__bucket", bucket),
        hot_rows=hot_rows,
        salts=salts,
        keep_salt=keep_place,
    )
    return joined if keep_place else joined.drop("__bucket")
