"""Position, neighbours and size of a group, also of one too large for a task.

A plain window over ``keys`` sorts a whole group in one task, which fails once a single
visitor owns a large share of the log. Ordinary groups are sorted that way here; a group
with more than ``hot_rows`` rows is cut into even ranges of its own order
(:func:`waymark.operators.hot.cut_hot`), and the window is over ``keys + range``. A summary
of the hot groups, pre-aggregated map-side to one row per range, tells how many rows come
before each range and what its neighbours hold; that row is unioned in front of the
range's own rows. The only window over ``keys`` alone runs on the summary, so it is bounded
by the number of ranges. Stage an expensive input first: it is read several times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.hot import CHUNK, HOT_ROWS, MARK, cut_hot


def sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    rank: str = "rank",
    reverse_rank: str | None = None,
    total: str | None = None,
    lead: Mapping[str, str] | None = None,
    lag: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add rank, reverse rank, group size, and next / previous values per group.

    ``order`` must be a strict total order inside a group (end it with a unique id).
    ``keys`` may be empty, which numbers the whole table, always by ranges. ``lead`` /
    ``lag`` map an output name to its source. With ``hot_rows`` None no group is counted
    or cut: for a caller that knows that none is too large, and has rows that lie together.
    """
    lead = dict(lead or {})
    lag = dict(lag or {})
    if hot_rows is None:
        group = Window.partitionBy(*keys)
        ordered = group.orderBy(*order)
        place, size = F.row_number().over(ordered).cast("bigint"), F.count(F.lit(1)).over(group)
        return df.select(
            *df.columns,
            place.alias(rank),
            *([(size - place + 1).alias(reverse_rank)] if reverse_rank else []),
            *([size.alias(total)] if total else []),
            *[F.lead(src).over(ordered).alias(name) for name, src in lead.items()],
            *[F.lag(src).over(ordered).alias(name) for name, src in lag.items()],
        )
    (rows,) = cut_hot([df], keys, [F.col(c) for c in order], hot_rows)

    first = F.struct(*order, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(lead.values())])
    last = F.struct(*order, *[F.col(c).alias(f"__v{i}") for i, c in enumerate(lag.values())])
    summary = (
        rows.filter(MARK)
        .groupBy(*keys, CHUNK)
        .agg(
            F.count(F.lit(1)).alias("__n"),
            *([F.min(first).alias("__head")] if lead else []),
            *([F.max(last).alias("__tail")] if lag else []),
        )
    )
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys,
        CHUNK,
        F.lit(0).alias("__row"),
        F.sum("__n").over(earlier).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias("__total"),
        *([F.lead("__head").over(by_chunk).alias("__next")] if lead else []),
        *([F.lag("__tail").over(by_chunk).alias("__prev")] if lag else []),
    )

    cell = Window.partitionBy(*keys, CHUNK)
    inside = cell.orderBy("__row", *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.drop(MARK).withColumn("__row", F.lit(1)).unionByName(carry, allowMissingColumns=True)

    def carried(column: str) -> Column:
        return F.first(column).over(so_far)

    sized = reverse_rank or total
    numbered = numbered.select(
        "*",
        # The carry row of a range has __row 0, so this counts data rows only.
        F.sum("__row").over(so_far).alias("__pos"),
        F.coalesce(carried("__before"), F.lit(0)).alias("__offset"),
        *([F.coalesce(carried("__total"), F.sum("__row").over(cell)).alias("__size")] if sized else []),
        *([carried("__next").alias("__after_chunk")] if lead else []),
        *([carried("__prev").alias("__before_chunk")] if lag else []),
        *([F.lead("__row").over(inside).isNull().alias("__ends_chunk")] if lead else []),
        *[F.lead(src).over(inside).alias(f"__lead{i}") for i, src in enumerate(lead.values())],
        *[F.lag(src).over(inside).alias(f"__lag{i}") for i, src in enumerate(lag.values())],
    ).filter("__row = 1")

    position = (F.col("__offset") + F.col("__pos")).cast("bigint")
    out = [position.alias(rank)]
    if reverse_rank:
        out.append((F.col("__size") - position + 1).cast("bigint").alias(reverse_rank))
    if total:
        out.append(F.col("__size").cast("bigint").alias(total))
    for i, name in enumerate(lead):
        beyond = F.col("__after_chunk").getField(f"__v{i}")
        out.append(F.when(F.col("__ends_chunk"), beyond).otherwise(F.col(f"__lead{i}")).alias(name))
    for i, name in enumerate(lag):
        beyond = F.col("__before_chunk").getField(f"__v{i}")
        out.append(F.when(F.col("__pos") == 1, beyond).otherwise(F.col(f"__lag{i}")).alias(name))
    return numbered.select(*df.columns, *out)
