"""Readers and writers, checked by reading back what was written."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import functions as F

from waymark.queries.registry import query
from waymark.queries.standins import table
from waymark.session import shared_folder
from waymark.sources import sinks
from waymark.sources.tables import read_delimited, read_evolved


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/waymark/{uuid.uuid4().hex}/{name}"


@query("external_csv", "SELECT DISTINCT s_name AS sdr_name, 'manager ' || s_nationkey AS manager_name FROM supplier")
def external_csv(spark, sf):
    path = _folder(spark, "managers")
    listed = table(spark, sf, "supplier").selectExpr("s_name AS sdr_name", "'manager ' || CAST(s_nationkey AS STRING) AS manager_name")
    listed.write.mode("overwrite").option("header", True).csv(path)
    return read_delimited(spark, path, "sdr_name STRING, manager_name STRING")


@query("full_refresh", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def full_refresh(spark, sf):
    path = _folder(spark, "orders")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sinks.full_refresh(orders.select("o_orderkey", "o_custkey"), path)
    sinks.full_refresh(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), path)
    return spark.read.parquet(path)


@query(
    "partition_replace",
    """SELECT event_id, event_type, CAST(ts AS DATE) AS extract_date, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-16' THEN 2 ELSE 1 END AS run
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-16' OR event_type = 'view'""",
)
def partition_replace(spark, sf):
    path = _folder(spark, "days")
    events = table(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("extract_date"))
    sinks.replace_days(events.withColumn("run", F.lit(1)), path)
    again = events.filter((F.col("extract_date") == F.lit(dt.date(2024, 1, 16))) & (F.col("event_type") == "view"))
    sinks.replace_days(again.withColumn("run", F.lit(2)), path)
    return read_evolved(spark, path)


@query(
    "schema_evolution",
    """SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN user_id END AS user_id, CAST(ts AS DATE) AS extract_date FROM events""",
)
def schema_evolution(spark, sf):
    path = _folder(spark, "evolving")
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("extract_date"))
    later = F.col("extract_date") >= F.lit(dt.date(2024, 1, 16))
    sinks.replace_days(events.filter(~later).drop("user_id"), path)
    sinks.replace_days(events.filter(later), path)
    return read_evolved(spark, path)


@query(
    "dynamic_filters",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000",
)
def dynamic_filters(spark, sf):
    slots = [F.col("o_orderstatus") == "F", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice") > 100000]
    orders = table(spark, sf, "orders")
    return orders.filter(reduce(lambda a, b: a & b, slots)).select("o_orderkey", "o_orderstatus", "o_orderpriority")
