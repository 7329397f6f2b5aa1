"""One key holds most rows: results stay whole and no task receives the whole group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.operators import Span, asof_neighbours, interval_join, lookup_join, sequence, window_sums
from waymark.operators.hot import CHUNK, cut_hot


@pytest.fixture(scope="module")
def log(spark):
    # Half of all rows belong to one key, some share one instant, a few have no key.
    rows = spark.range(0, 3000, numPartitions=4)
    return rows.select(
        "id",
        F.expr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 2 = 0 THEN 1 ELSE id % 40 END").alias("key"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST((id * 7919) % 4320 AS INT), 0)").alias("at"),
        F.concat(F.lit("v"), F.col("id")).alias("value"),
    )


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def largest_share(df, *keys):
    """Largest number of rows that one combination of ``keys`` sends to one task."""
    return df.groupBy(*keys).count().agg(F.max("count")).collect()[0][0]


@pytest.mark.parametrize("hot_rows", [10, 100, 1_000_000])
def test_sequence_equals_plain_window(log, hot_rows):
    out = sequence(
        log, ["key"], ["at", "id"], rank="rank", reverse_rank="back", total="n", lead={"next": "at", "nv": "value"}, lag={"prev": "value"}, hot_rows=hot_rows
    )
    w = Window.partitionBy("key").orderBy("at", "id")
    back = Window.partitionBy("key").orderBy(F.desc("at"), F.desc("id"))
    plain = log.select(
        "*",
        F.row_number().over(w).alias("rank"),
        F.row_number().over(back).alias("back"),
        F.count("*").over(Window.partitionBy("key")).alias("n"),
        F.lead("at").over(w).alias("next"),
        F.lead("value").over(w).alias("nv"),
        F.lag("value").over(w).alias("prev"),
    )
    columns = ["id", "key", "rank", "back", "n", "next", "nv", "prev"]
    assert rows_of(out, *columns) == rows_of(plain, *columns)


@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_global_sequence(log, hot_rows):
    out = sequence(log, [], ["at", "id"], rank="rank", lag={"prev": "value"}, hot_rows=hot_rows)
    w = Window.orderBy("at", "id")
    plain = log.select("*", F.row_number().over(w).alias("rank"), F.lag("value").over(w).alias("prev"))
    assert rows_of(out, "id", "rank", "prev") == rows_of(plain, "id", "rank", "prev")


# Dense ids, ids spread over all 64 bits, and one instant for all rows.
@pytest.mark.parametrize("order", ["id", "xxhash64(id)", "CAST(id AS STRING)", "struct(timestamp'2024-01-01 00:00:00', xxhash64(id))"])
@pytest.mark.parametrize("keys", [[], ["all"]])
def test_ranges_are_even(spark, order, keys):
    rows = spark.range(0, 20_000, numPartitions=4).selectExpr("id", "1 AS all", f"{order} AS o")
    (cut,) = cut_hot([rows], keys, [F.col("o")], 1000)
    sizes = [r["count"] for r in cut.groupBy(CHUNK).count().collect()]
    # The summary has one row for each range.
    assert len(sizes) == 20
    assert max(sizes) < 2500
    ends = cut.groupBy(CHUNK).agg(F.min("o").alias("low"), F.max("o").alias("high")).orderBy(CHUNK).collect()
    assert all(a.high < b.low for a, b in zip(ends, ends[1:], strict=False))


def test_ranges_cut_alike_in_every_reading(log):
    (cut,) = cut_hot([log], ["key"], [F.col("at"), F.col("id")], 50)
    again = cut.select("id", F.col(CHUNK).alias("c"))
    assert cut.join(again, "id").filter(~F.col(CHUNK).eqNullSafe(F.col("c"))).count() == 0


def test_sequence_splits_the_hot_key(log):
    (cut,) = cut_hot([log], ["key"], [F.col("at"), F.col("id")], 100)
    assert largest_share(cut, "key", CHUNK) < 300 < largest_share(log, "key") // 4
    plan = sequence(log, ["key"], ["at", "id"], rank="rank")._jdf.queryExecution().executedPlan().toString()
    # Rows are exchanged by key and range; by key alone only the count and the summary.
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert CHUNK in wide[0]


@pytest.mark.parametrize("hot_rows", [10, 100, 1_000_000])
@pytest.mark.parametrize("closed", [True, False])
def test_window_sums_equal_a_join(log, closed, hot_rows):
    points = log.filter("id % 3 = 0").select("id", "key", "at").unionByName(
        log.filter("id % 300 = 0").selectExpr("id + 10000 AS id", "key", "CAST(NULL AS TIMESTAMP) AS at")
    )
    events = log.filter("id % 3 = 1").select("key", F.col("at").alias("then"), (F.col("id") % 5).alias("v"))
    spans = {"near": Span(-600, 1500, closed), "later": Span(0, 3600, closed)}
    sums = {"n": ("near", F.lit(1)), "v": ("near", F.col("v")), "m": ("later", F.lit(1))}
    found = window_sums(points, events, ["key"], "at", "then", spans, sums, hot_rows=hot_rows)
    e = events.select(F.col("key").alias("k"), "then", "v")
    off = F.unix_micros("then") - F.unix_micros("at")

    def inside(span):
        low, high = span.low * 1_000_000, span.high * 1_000_000
        return (off >= low) & (off <= high) if closed else (off > low) & (off < high)

    pairs = points.join(e, F.col("key") == F.col("k"), "left")
    plain = pairs.groupBy("id").agg(
        F.count_if(inside(spans["near"])).alias("n"),
        F.coalesce(F.sum(F.when(inside(spans["near"]), F.col("v"))), F.lit(0)).alias("v"),
        F.count_if(inside(spans["later"])).alias("m"),
    )
    assert rows_of(found, "id", "n", "v", "m") == rows_of(plain, "id", "n", "v", "m")


@pytest.mark.parametrize("hot_rows", [10, 100, 1_000_000])
@pytest.mark.parametrize("equal_is_before", [True, False])
def test_asof_equals_brute_force(log, equal_is_before, hot_rows):
    left = log.filter("id % 3 = 0").select("id", "key", "at")
    right = log.filter("id % 3 = 1").select("key", "at", "value")
    found = asof_neighbours(
        left,
        right,
        ["key"],
        F.col("at"),
        F.col("at"),
        ["value"],
        right_order=["value"],
        equal_is_before=equal_is_before,
        hot_rows=hot_rows,
    )
    r = right.select(F.col("key").alias("k"), F.col("at").alias("rat"), F.col("value").alias("v"))
    before = F.col("rat") <= F.col("at") if equal_is_before else F.col("rat") < F.col("at")
    pairs = left.join(r, F.col("key") == F.col("k"))
    prev = pairs.filter(before).groupBy("id").agg(F.max(F.struct("rat", "v")).alias("p"))
    nxt = pairs.filter(~before).groupBy("id").agg(F.min(F.struct("rat", "v")).alias("n"))
    first = r.groupBy("k").agg(F.min(F.struct("rat", "v")).alias("e"))
    plain = left.join(prev, "id", "left").join(nxt, "id", "left").join(first, F.col("key") == F.col("k"), "left")
    assert rows_of(found, "id", "prev.value", "next.value", "earliest.value") == rows_of(plain, "id", "p.v", "n.v", "e.v")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_salts_hot_keys(log, how):
    table = log.groupBy("key").agg(F.count("*").alias("n"))
    out = lookup_join(log, table, ["key"], how, hot_rows=100, salts=8)
    plain = log.join(table, "key", how)
    assert rows_of(out, "id", "key", "n") == rows_of(plain, "id", "key", "n")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_interval_join_equals_plain_join(log, how, hot_rows):
    left = log.filter("id % 3 = 0").select("id", "key", "at")
    right = log.filter("id % 3 = 1").select("key", F.col("at").alias("rat"), "value")

    def near(a, b):
        return F.timestamp_diff("MINUTE", a, b).between(-10, 25)

    out = interval_join(left, right, ["key"], "at", "rat", before=11 * 60, after=26 * 60, matches=near, how=how, hot_rows=hot_rows)
    r = right.withColumnRenamed("key", "k")
    plain = left.join(r, (F.col("key") == F.col("k")) & near(F.col("at"), F.col("rat")), how)
    assert rows_of(out, "id", "key", "rat", "value") == rows_of(plain, "id", "key", "rat", "value")
