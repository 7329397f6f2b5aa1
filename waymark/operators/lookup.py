"""Joins of a large table to a keyed one when a few keys may own most of the large one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators.hot import HOT_ROWS, MARK, hot_keys, mark_hot

SALTS = 64
SMALL_ROWS = 100_000


def broadcast_if_small(table: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Mark a list-like table for broadcast after counting that it has at most ``max_rows`` rows.

    A larger one is returned as it is, and joined by shuffling.
    """
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    matches: Column | None = None,
    row_id: Sequence[str] | None = None,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    keep_salt: bool = False,
) -> DataFrame:
    """``rows`` (left) joined to ``table`` on ``keys`` and ``matches``; ``how`` is ``left`` or ``inner``.

    Rows of keys with more than ``hot_rows`` rows, and rows with a null key (which can never match), are
    spread over ``salts`` sub-keys; only the hot entries of ``table`` are repeated. All
    other keys are joined once, untouched. ``row_id`` names columns that tell rows of one
    key apart (all columns if not given). The count reads ``hot_from``, by default
    ``rows``: where those come from other joins, give an earlier table with the same keys.
    ``keep_salt`` leaves the sub-key in ``__salt``: rows lie together by ``keys`` and it.
    """
    table_keys = [f"__t{i}" for i in range(len(keys))]
    hot = hot_keys((rows if hot_from is None else hot_from).dropna(subset=list(keys)), keys, hot_rows)

    def equal(left: Sequence[str], right: Sequence[str]) -> Column:
        on = F.lit(True)
        for a, b in zip(left, right, strict=True):
            on = on & (F.col(a) == F.col(b))
        return on

    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    spread = F.pmod(F.xxhash64(*(row_id or rows.columns)), F.lit(salts)).cast("int")
    salted = mark_hot(rows, hot, keys).withColumn("__salt", F.when(F.col(MARK) | any_null, spread).otherwise(F.lit(0)))
    copies = F.when(F.col(MARK), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    renamed = table.withColumnsRenamed(dict(zip(keys, table_keys, strict=True)))
    repeated = mark_hot(renamed, hot, table_keys).withColumn("__slot", F.explode(copies)).drop(MARK)
    on = equal([*keys, "__salt"], [*table_keys, "__slot"])
    if matches is not None:
        on = on & matches
    joined = salted.drop(MARK).join(repeated, on, how).drop("__slot", *table_keys)
    return joined if keep_salt else joined.drop("__salt")
