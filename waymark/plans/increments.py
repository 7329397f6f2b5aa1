"""The page-visit table kept up day by day instead of built anew.

State is one :class:`~waymark.sources.cells.CellTable`: sequenced page visits in cells of
opening day and a hash of the session, and two side tables, the cell of each session and each
visitor's first and latest visit per load. A load reads its own rows, the keys of known
sessions and the cells of the sessions it touches; a late row reopens its session wherever
that lies. A session keeps its cell for good, so nothing else moves.

What depends on a visitor's whole history (new or returned) is looked up when the table is
read: a late first visit changes it without rewriting a page.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import keep_first
from waymark.operators.hot import HOT_ROWS
from waymark.plans import web
from waymark.sources.cells import CELL, CellTable
from waymark.sources.sinks import Stage, stage as write_stage

SESSION_KEYS = ("domain", "visitor_id", "session_id")
SEQUENCE_COLUMNS = ("rank_from_start", "rank_from_end", "visit_end_time", "visit_length")
#: Cells of one opening day. A cell should hold some 100 to 500 MB.
BUCKETS = 16


def _same(keys: Sequence[str], named: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)])


def _cell(keys: Sequence[str], first: Column, buckets: int) -> Column:
    """Opening day and bucket as text; sessions without any time share one day."""
    bucket = F.lpad(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"), 4, "0")
    return F.concat(F.coalesce(F.date_format(first, "yyyy-MM-dd"), F.lit("none")), F.lit("."), bucket)


def load_pages(
    rows: DataFrame,
    path: str,
    keys: Sequence[str] = SESSION_KEYS,
    *,
    buckets: int = BUCKETS,
    stage: Stage = write_stage,
    hot_rows: int = HOT_ROWS,
) -> list[str]:
    """Add a delivery of page views, of any days, to the table at ``path``; the cells it rewrote.

    ``rows`` have ``keys``, ``visitor_id``, ``visit_start_time`` and ``page_visit_id``, which
    tells the events of a session apart; other columns are kept, and one that earlier loads
    lacked is null there. An event that was delivered before is left as it is, so a delivery
    may be repeated. Of events that repeat inside a delivery the earliest stays. Missing keys
    are a session of their own, as in :func:`web.sequence_pages`; as its ranks from the end
    change with every row, such a session is read and ranked whole by each load that adds to it.

    A cell of up to ``hot_rows`` rows is brought together once, and its events are told
    apart, ranked and written there; sessions of larger cells are counted and cut.
    """
    spark = rows.sparkSession
    table = CellTable(spark, path)
    latest = table.latest()
    day = stage(rows, "delivery")

    named = [f"__k{i}" for i in range(len(keys))]
    seen = day.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)]).agg(
        F.min("visit_start_time").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    known = table.side("sessions", latest)
    if known is None:
        places = seen.withColumns({"__new": F.lit(True), "__cell_of": _cell(named, F.col("__first"), buckets)})
    else:
        places = seen.join(known.withColumnRenamed(CELL, "__known"), _same(named, keys), "left").select(
            *named,
            "__n",
            F.col("__known").isNull().alias("__new"),
            F.coalesce("__known", _cell(named, F.col("__first"), buckets)).alias("__cell_of"),
        )
    # Written once: joined below with rows that may be skewed, which a written side lets Spark split.
    places = stage(places, "sessions_seen")
    sizes = dict(places.groupBy("__cell_of").agg(F.sum("__n")).collect())
    touched = sorted(sizes)
    if not touched:
        return []

    placed = day.join(places.drop("__n"), _same(keys, named)).select(*day.columns, F.col("__cell_of").alias(CELL))
    placed = stage(placed, "events").withColumn("__delivered", F.lit(1))
    before = table.rows(latest, touched)
    if before is not None:
        for cell, n in before.groupBy(CELL).count().collect():
            sizes[cell] += n
        before = before.drop(*SEQUENCE_COLUMNS).withColumn("__delivered", F.lit(0))
        placed = before.unionByName(placed, allowMissingColumns=True)
    columns = [c for c in placed.columns if c not in ("__delivered", CELL)]
    order = ["__delivered", F.col("visit_start_time"), F.xxhash64(*columns)]

    def unrepeated(df: DataFrame) -> DataFrame:
        return keep_first(df, [CELL, *keys, "page_visit_id"], order).drop("__delivered")

    large = [c for c in touched if sizes[c] > hot_rows]
    in_large = F.col(CELL).isin(large)
    # The one shuffle of these rows: all windows are over the cell and more, and the writer wants cells.
    together = (placed.filter(~in_large) if large else placed).repartition(CELL)
    sequenced = web.sequence_pages(unrepeated(together), [CELL, *keys], hot_rows=None)
    cut = None
    if large:
        events = stage(unrepeated(placed.filter(in_large)), "large_cells")
        cut = web.sequence_pages(events, [CELL, *keys], hot_rows=hot_rows)

    opened = places.filter("__new").select(
        *[F.col(n).alias(k) for n, k in zip(named, keys, strict=True)], F.col("__cell_of").alias(CELL)
    )
    table.write(sequenced, touched, {"sessions": opened, "visitors": web.visitor_dimension(day)}, latest, cut)
    return touched


def loaded_visitors(spark: SparkSession, path: str) -> DataFrame:
    """First and latest visit per visitor over all loads."""
    table = CellTable(spark, path)
    parts = table.side("visitors", table.latest())
    if parts is None:
        raise ValueError(f"nothing was loaded to {path}")
    return parts.groupBy("visitor_id").agg(
        F.min("first_visit_time").alias("first_visit_time"), F.max("most_recent_visit_time").alias("most_recent_visit_time")
    )


def loaded_pages(spark: SparkSession, path: str, unit: str = "month") -> DataFrame:
    """All page visits loaded so far, with their places in the session, edge flags and new or returned."""
    table = CellTable(spark, path)
    pages = table.rows(table.latest())
    if pages is None:
        raise ValueError(f"nothing was loaded to {path}")
    pages = pages.drop(CELL)
    return web.new_or_returned(pages, loaded_visitors(spark, path), unit).withColumns(web.edge_flags())
