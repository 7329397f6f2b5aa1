"""Plans: no cartesian product, partial first-row limits, filters at the scan, narrow reads."""

import uuid

import pytest
from pyspark.sql import functions as F

from waymark.operators import keep_first
from waymark.plans import web
from waymark.queries import QUERIES
from waymark.queries.standins import rows
from waymark.sources.layout import lay_out
from waymark.sources.tables import read_table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(name, spark, sf):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_keep_first_limits_before_the_shuffle(spark, sf):
    plan = plan_of(keep_first(read_table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_date_window_reaches_the_scan(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(QUERIES["rolling_scan"](spark, sf))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "o_custkey" not in plan


def test_distinct_counts_do_not_expand(spark, sf):
    assert "Expand" not in plan_of(QUERIES["inbound_wide"](spark, sf))


def test_last_touch_forms_no_pairs(spark, sf):
    plan = plan_of(QUERIES["last_touch_detail"](spark, sf))
    # The only joins look keys up: in the list of hot keys, or whether a key converts at all.
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert all("LeftSemi" in line or "BroadcastHashJoin" in line and "__h0" in line for line in joins)


def test_unused_direction_of_asof_is_dropped(spark, sf):
    plan = plan_of(QUERIES["last_touch_detail"](spark, sf))
    assert "AS next" not in plan


def test_linear_touch_credit_sums_to_one(spark, sf):
    credit = QUERIES["linear_credit"](spark, sf).groupBy("org_id").agg(F.sum("linear_credit").alias("c"))
    assert credit.filter(F.abs(F.col("c") - 1) > 1e-4).count() == 0


def test_one_entrance_and_exit_per_session(spark, sf):
    pages = QUERIES["page_sequence"](spark, sf)
    counts = pages.groupBy("domain", "visitor_id", "session_id").agg(
        F.count_if(F.col("is_entrance") == "True").alias("i"),
        F.count_if(F.col("is_exit") == "True").alias("o"),
        F.count_if(F.col("is_bounce") == "True").alias("b"),
        F.count("*").alias("n"),
    )
    assert counts.filter("i <> 1 OR o <> 1 OR (b = 1) <> (n = 1)").count() == 0


def test_asof_snapshot_is_not_later_than_the_visit(spark, sf):
    found = QUERIES["asof_latest"](spark, sf)
    assert found.filter(F.to_date("ip_snapshot_ts") > F.to_date("visit_start_time")).count() == 0


def test_every_event_has_a_channel(spark, sf):
    for name in ("channel_rules_v1", "channel_rules_derived", "channel_rules_v3", "channel_rules_v2"):
        assert QUERIES[name](spark, sf).filter("channel_detail IS NULL").count() == 0


def test_bucketed_pages_are_rolled_up_and_joined_without_a_shuffle(spark, sf, tmp_path):
    pages = rows(spark, sf, "page_views")
    pages = pages.withColumn("visitor_id", F.when(F.col("visitor_id") % 10 > 0, F.col("visitor_id")))
    most = pages.groupBy("visitor_id").count().dropna().agg(F.max("count")).first()[0]
    laid = lay_out(pages, "pages", ["visitor_id"], buckets=4, path=str(tmp_path / uuid.uuid4().hex), hot_rows=most - 1)
    assert laid.hot.filter("visitor_id is not null").count() >= most
    assert laid.cold.count() + laid.hot.count() == pages.count()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        cold = plan_of(web.sessions_with_visitor(laid.cold))
        plain = plan_of(web.sessions_with_visitor(pages))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Exchange" not in cold and "Exchange" in plain
    found = laid.apply(web.sessions_with_visitor)
    assert sorted(map(str, found.collect())) == sorted(map(str, web.sessions_with_visitor(pages).select(*found.columns).collect()))
