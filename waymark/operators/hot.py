"""Keys with too many rows for one task, and ranges that cut their rows by what the rows hold.

A hot key's rows are cut at boundaries taken from a sample of its own rows, so the pieces
are even whether its times are spread or all the same instant, and its ids dense or not.
The sample is picked by a hash of the row, so every reading of the plan cuts alike. Cuts
only deal the work out: results never depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
#: Hot keys at most: the largest ones. Any other key then has less than this part of all rows.
MOST_KEYS = 10_000
#: Ranges of a key at most, and rows sampled for each range, about.
MOST_RANGES, SAMPLED = 10_000, 30
MARK, CHUNK = "__hot", "__chunk"
_PARTS = 1 << 40


def key_names(keys: Sequence[str]) -> list[str]:
    return [f"__h{i}" for i in range(len(keys))]


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """The keys with more than ``hot_rows`` rows, the ``MOST_KEYS`` largest at most, from one
    column-pruned, map-side combined count. The bound makes the list safe to broadcast.
    """
    named = key_names(keys)
    counted = rows.groupBy(*[F.col(k).alias(h) for k, h in zip(keys, named, strict=True)]).agg(F.count(F.lit(1)).alias("__n"))
    largest = counted.filter(F.col("__n") > hot_rows).orderBy(F.desc("__n"), *named).limit(MOST_KEYS)
    return largest.select(*named, "__n", F.lit(True).alias(MARK))


def _same(keys: Sequence[str], named: Sequence[str]) -> Column:
    on: Column = F.lit(True)
    for k, h in zip(keys, named, strict=True):
        on = on & F.col(k).eqNullSafe(F.col(h))
    return on


def mark_hot(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``__hot``: true for rows of a hot key, null for all others."""
    named = key_names(keys)
    return rows.join(F.broadcast(hot.select(*named, MARK)), _same(keys, named), "left").drop(*named)


def _ranges(n: Column, hot_rows: int) -> Column:
    return F.least(F.ceil(n / hot_rows), F.lit(MOST_RANGES)).cast("int")


def _boundaries(sample: Column, ranges: Column) -> Column:
    """``ranges`` - 1 values that cut the ordered ``sample`` into even parts."""
    wanted = F.sequence(F.lit(1), F.greatest(ranges - 1, F.lit(1)))
    picked = F.transform(wanted, lambda k: F.get(sample, F.floor(k * F.size(sample) / ranges).cast("int")))
    return F.when((ranges > 1) & (F.size(sample) > 0), F.array_distinct(picked))


def _place(bounds: Column, row: Column) -> Column:
    """How many of the ascending ``bounds`` are at or below ``row``, by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        upper = F.struct((middle + 1).alias("low"), span["high"].alias("high"))
        lower = F.struct(span["low"].alias("low"), middle.alias("high"))
        return F.when(span["low"] >= span["high"], span).when(F.get(bounds, middle) <= row, upper).otherwise(lower)

    return F.aggregate(steps, start, halve, lambda span: span["low"])


def cut_hot(parts: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column], hot_rows: int) -> list[DataFrame]:
    """Each of ``parts`` plus ``__hot`` and ``__chunk``, the range a hot key's row lies in; null for other keys.

    The parts are counted and cut together; all have the ``keys`` and what ``order`` reads,
    with equal types. ``order`` tells rows apart as far as a key's rows must be cut; ranges
    follow it. Without ``keys`` the whole table is one hot key. The rows are read once more
    to count their keys, and those of hot keys once more to sample what ``order`` reads.
    """
    row = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    narrow = [part.select(*keys, row.alias("__row")) for part in parts]
    every = narrow[0]
    for part in narrow[1:]:
        every = every.unionByName(part)
    picked = F.pmod(F.xxhash64("__row"), F.lit(_PARTS)) < F.lit(float(_PARTS)) * SAMPLED * F.col("__ranges") / F.col("__n")
    sample = F.sort_array(F.collect_list("__row"))
    if not keys:
        total = every.agg(F.count(F.lit(1)).alias("n")).scalar()
        sized = every.withColumn("__n", total).withColumn("__ranges", _ranges(F.col("__n"), hot_rows))
        cut = sized.filter(picked).agg(sample.alias("s"), F.max("__ranges").alias("r"))
        bounds = cut.select(_boundaries(F.col("s"), F.col("r")).alias("b")).scalar()
        return [
            part.withColumn("__bounds", bounds)
            .withColumns({MARK: F.lit(True), CHUNK: F.coalesce(_place(F.col("__bounds"), row), F.lit(0))})
            .drop("__bounds")
            for part in parts
        ]
    named = key_names(keys)
    hot = hot_keys(every, keys, hot_rows)
    sized = every.join(F.broadcast(hot), _same(keys, named)).withColumn("__ranges", _ranges(F.col("__n"), hot_rows))
    cut = sized.filter(picked).groupBy(*named).agg(sample.alias("s"), F.max("__ranges").alias("r"))
    # A key too evenly unlucky to be sampled keeps one range.
    bounds = cut.select(*named, _boundaries(F.col("s"), F.col("r")).alias("__bounds"))
    again = [F.col(h).alias(f"{h}_") for h in named]
    same = F.lit(True)
    for h in named:
        same = same & F.col(h).eqNullSafe(F.col(f"{h}_"))
    known = hot.join(F.broadcast(bounds.select(*again, "__bounds")), same, "left").select(*named, MARK, "__bounds")
    chunk = F.when(F.col(MARK), F.coalesce(_place(F.col("__bounds"), row), F.lit(0)))
    return [
        part.join(F.broadcast(known), _same(keys, named), "left").withColumn(CHUNK, chunk).drop("__bounds", *named)
        for part in parts
    ]
