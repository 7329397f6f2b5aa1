"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

A document of ``z`` mean sizes gets the rate ``cap / (1 + (cap - 1) exp(-lambda z))``: the
rates closest in entropy to one copy each that stay below ``cap`` and give the source's
words. ``lambda``, one per source, minimises a convex dual; its Newton steps are sums over
(source, size) cells, the only thing that is read again in each step. Rates are then
rounded to whole copies along the sizes of a source, which keeps the rounding error of a
source's words below about its largest document, and, in a cell cut into slots, below one
copy of that size per slot. Of several starts of the rounding each source takes the one
whose words come nearest to its target.

Sums that decide anything are sums of whole numbers, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.frames import own_names, stage

WEIGHTS, CAP = (1, 2, 3), 3
WORD = r"[^\x20\x09-\x0D]+"
#: Whole numbers stand for thousandths of words, and for 2^-30 of a copy.
MILLI, UNIT = 1000, 1 << 30
#: Documents of one source and size that are ranked together.
SLOT_ROWS = 256
#: A cell that holds more than one in so many of all rows is hot.
HOT_PART = 1000
#: Starts of the rounding that are tried for each source.
STARTS = 32
#: Sizes in a block of the running sums over a source.
BLOCK = 256
STEPS = 60
OWN = ["size", "source_size", "target", "copies", "taken"]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """Sorts like the source by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _weighted(cells: DataFrame, weights: Sequence[int]) -> DataFrame:
    """key, total, n and weight of every source; weights repeat along the sorted keys.

    Sources are numbered within blocks of equal first letters, after the blocks before.
    """
    sources = (
        cells.groupBy("key")
        .agg(F.sum(F.col("size") * F.col("n")).alias("total"), F.sum("n").alias("n"))
        .withColumn("block", F.substring("key", 1, 3))
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sources.groupBy("block").agg(F.count("*").alias("k")).select(
        "block", F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("before")
    )
    rank = F.row_number().over(Window.partitionBy("block").orderBy("key")) - 1 + F.col("before")
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return sources.join(blocks, "block").select("key", "total", "n", weight.alias("weight"))


def _targets(sources: DataFrame, cap: int) -> DataFrame:
    """Add ``target``: shares by weight; a source stops at ``cap`` times its words and the rest is shared anew."""
    limit = F.col("total") * cap
    level, full = None, -1
    while True:
        stops = F.lit(False) if level is None else limit <= F.col("weight") * level
        row = sources.agg(
            F.sum("total").alias("all"),
            F.sum(F.when(stops, limit).otherwise(0)).alias("stopped"),
            F.sum(F.when(stops, 0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(stops).alias("full"),
        ).first()
        if row["all"] is None or not row["open"]:
            return sources.withColumn("target", limit.cast("double"))
        if row["full"] == full:
            return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(float(level))))
        level, full = (row["all"] - row["stopped"]) / row["open"], row["full"]


def _rate(size: Column, cap: int) -> Column:
    z = size / F.col("scale")
    # A source that takes all it may has rate ``cap`` throughout.
    tilted = cap / (1 + (cap - 1) * F.exp(F.greatest(F.least(-F.col("lam") * z, F.lit(700.0)), F.lit(-700.0))))
    return F.when(F.col("full") & (size > 0), F.lit(float(cap))).otherwise(tilted)


def _whole(amount: Column) -> Column:
    return F.sum(F.round(amount * MILLI).cast("long"))


def _balance(cells: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """Newton steps on the dual of all sources at once, kept within a bracket of the solution."""
    state = stage(
        sources.select(
            "*",
            (F.col("target") >= F.col("total") * cap).alias("full"),
            F.greatest(F.col("total") / F.col("n"), F.lit(1e-9)).alias("scale"),
            F.lit(0.0).alias("lam"),
            F.lit(-1e6).alias("low"),
            F.lit(1e6).alias("high"),
        ),
        "balance",
    )
    for _ in range(STEPS):
        rate = _rate(F.col("size"), cap)
        sums = (
            cells.join(state.filter("NOT full").select("key", "lam", "scale", "full"), "key")
            .withColumn("w", F.col("n") * F.col("size") * rate)
            .groupBy("key")
            .agg(
                _whole(F.col("w")).alias("given"),
                _whole(F.col("w") * F.col("size") / F.col("scale") * (1 - rate / cap)).alias("slope"),
            )
        )
        over = F.coalesce(F.col("given") / MILLI - F.col("target"), F.lit(0.0))
        done = F.abs(over) <= F.greatest(F.col("target") * 1e-6, F.lit(0.5))
        low = F.when(over < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("lam")).otherwise(F.col("high"))
        reach = 1 + F.abs(F.col("lam"))
        newton = F.when(F.col("slope") > 0, -over / (F.col("slope") / MILLI)).otherwise(-F.signum(over) * reach)
        moved = F.col("lam") + F.greatest(F.least(newton, reach), -reach)
        inside = F.when((moved > low) & (moved < high), moved).otherwise((low + high) / 2)
        state = stage(
            state.join(sums, "key", "left").select(
                *sources.columns,
                "full",
                "scale",
                F.when(done, F.col("lam")).otherwise(inside).alias("lam"),
                low.alias("low"),
                high.alias("high"),
                done.alias("done"),
            ),
            "balance",
        )
        if state.filter("NOT done").count() == 0:
            break
        state = state.drop("done")
    return state


def _cell_copies(start: Column) -> Column:
    """Copies a cell gives from ``start`` on; about, for one that is cut into slots."""
    exact = F.floor((start + F.least("n", F.lit(SLOT_ROWS)) * F.col("rate")) / UNIT) - F.floor(start / UNIT)
    return F.when(F.col("n") <= SLOT_ROWS, exact).otherwise(F.round(F.col("n") / UNIT * F.col("rate")).cast("long"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, text: Column | None = None) -> DataFrame:
    """``docs`` plus size, source_size, target, copies and taken.

    ``size`` counts the words of the text (null: 0). Sources in code point order, null
    last, weigh ``weights``, repeating, and share the words of all documents; a target
    stops at ``cap`` times its source's words. ``copies`` is 0 to ``cap``, and ``taken``
    is copies times size. A document without words is taken once and gives no words.
    Rows that repeat are mixed each. Own columns with the added names are replaced.
    ``text`` says where the text is, if not in a column of that name.
    """
    text = F.col("text") if text is None else text
    docs = own_names(docs, OWN)
    sized = docs.withColumn("__key", _key(F.col("source"))).withColumn("size", words(text))
    cells = stage(sized.groupBy(F.col("__key").alias("key"), "size").agg(F.count("*").alias("n")), "cells")
    sources = stage(_targets(stage(_weighted(cells, weights), "sources"), cap), "targets")
    state = _balance(cells, sources, cap).select("key", "total", "target", "full", "scale", "lam")

    # Copies before each cell, modulo one copy: by blocks of sizes, then within the block.
    rated = cells.join(state, "key").select(
        "key", "size", "n", "total", "target", F.round(_rate(F.col("size"), cap) * UNIT).cast("long").alias("rate")
    )
    part = (F.col("n") % UNIT) * (F.col("rate") % UNIT) % UNIT
    rated = rated.withColumn("block", F.floor(F.col("size") / BLOCK)).withColumn("part", part)
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rated.groupBy("key", "block").agg(F.sum("part").alias("sum")).select(
        "key", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("earlier")
    )
    smaller = Window.partitionBy("key", "block").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rated.withColumn("inside", F.coalesce(F.sum("part").over(smaller), F.lit(0))).join(blocks, ["key", "block"])
    placed = placed.withColumn("start", (F.col("earlier") + F.col("inside")) % UNIT).drop("earlier", "inside", "block")
    placed = stage(placed, "placed")
    begins = [k * UNIT // STARTS for k in range(STARTS)]
    totals = placed.groupBy("key", "target").agg(
        *[F.sum(_cell_copies(F.col("start") + b) * F.col("size")).alias(f"w{b}") for b in begins]
    )
    tried = F.array(*[F.struct(F.abs(F.col(f"w{b}") - F.col("target")).alias("off"), F.lit(b).alias("b")) for b in begins])
    best = totals.select("key", F.array_min(tried)["b"].alias("begin"))
    starts = stage(
        placed.join(best, "key").select(
            F.col("key").alias("__key2"),
            F.col("size").alias("__size2"),
            F.col("total").alias("source_size"),
            "target",
            F.col("rate").alias("__rate"),
            F.ceil(F.col("n") / SLOT_ROWS).alias("__slots"),
            F.col("n").alias("__n"),
            ((F.col("start") + F.col("begin")) % UNIT).alias("__start"),
        ),
        "starts",
    )

    order = F.xxhash64("doc_id")
    cell = (F.col("__key") == F.col("__key2")) & (F.col("size") == F.col("__size2"))
    # Fewer than HOT_PART cells have such a part of all rows, so they may be broadcast, and their
    # rows are dealt by slot. All others are joined and ranked where their cell is: no text moves twice.
    all_rows = cells.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = stage(starts.filter(F.col("__n") * HOT_PART > all_rows), "hot")
    dealt = sized.join(F.broadcast(hot), cell).withColumn("__slot", F.pmod(order, "__slots"))
    dealt = dealt.repartition("__key", "size", "__slot")
    others = sized.join(F.broadcast(hot.select("__key2", "__size2")), cell, "left_anti").join(starts, cell)
    others = others.withColumn("__slot", F.pmod(order, "__slots"))
    # A cell with very many documents is ranked slot by slot, each with a start of its own.
    start = F.when(F.col("__slots") == 1, F.col("__start")).otherwise(
        F.pmod(F.xxhash64("__key", "size", "__slot"), F.lit(UNIT))
    )
    slot = ["__key", "size", "__slot"]
    rank = F.row_number().over(Window.partitionBy(*slot).orderBy(order, "doc_id")).cast("long")
    upto = start + F.col("__rank") * F.col("__rate")
    copies = F.floor(upto / UNIT) - F.floor((upto - F.col("__rate")) / UNIT)
    parts = [df.withColumn("__rank", rank).withColumn("copies", copies) for df in (dealt, others)]
    return parts[0].unionByName(parts[1]).select(
        *docs.columns, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
