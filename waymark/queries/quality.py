"""Key and coverage checks, and text functions, on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from waymark.operators import quality, valid_at, validity_intervals
from waymark.queries.registry import query, r6
from waymark.queries.standins import ev, K, rows, table, with_
from waymark.session import shared_folder
from waymark.sources import versions


@query("grain_check", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def grain_check(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("row_vs_distinct", "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys FROM orders")
def row_vs_distinct(spark, sf):
    return quality.rows_and_keys(table(spark, sf, "orders"), ["o_custkey"])


@query(
    "stage_counts",
    """SELECT 'pages' AS stage, count(*) AS n_rows FROM events WHERE event_type = 'view'
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'with lines', count(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def stage_counts(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return quality.stage_counts(
        {
            "pages": table(spark, sf, "events").filter("event_type = 'view'"),
            "orders": orders,
            "with lines": orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")),
        }
    )


@query(
    "reconcile_both",
    """SELECT c_custkey AS id, 'right' AS missing_in FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT DISTINCT o_custkey, 'left' FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer)""",
)
def reconcile_both(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    ordering = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return quality.reconcile(customers, ordering, "id")


@query(
    "reconcile_suppliers",
    """SELECT s_suppkey AS id, 'right' AS missing_in FROM supplier WHERE s_suppkey NOT IN (SELECT l_partkey FROM lineitem)
UNION ALL SELECT DISTINCT l_partkey, 'left' FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def reconcile_suppliers(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    parts = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    return quality.reconcile(suppliers, parts, "id")


@query(
    "not_in_with_nulls",
    with_("all_events")
    + """, l AS (SELECT event_id, session_id FROM all_events WHERE event_type = 'view'),
r AS (SELECT session_id FROM all_events WHERE event_type = 'click'), known AS (SELECT session_id FROM r WHERE session_id IS NOT NULL)
SELECT event_id, session_id, 'no null on the right' AS form FROM l WHERE session_id NOT IN (SELECT session_id FROM known)
UNION ALL SELECT event_id, session_id, 'null on the right' FROM l WHERE session_id NOT IN (SELECT session_id FROM r)
UNION ALL SELECT event_id, session_id, 'anti join' FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.session_id = l.session_id)""",
)
def not_in_with_nulls(spark, sf):
    events = rows(spark, sf, "all_events").select("event_id", "session_id", "event_type")
    views = events.filter("event_type = 'view'").drop("event_type")
    clicks = events.filter("event_type = 'click'").select("session_id")

    def form(right, name, strict):
        found = quality.missing_keys(views, right, "session_id", strict_null=strict)
        return found.select("event_id", "session_id", F.lit(name).alias("form"))

    return (
        form(clicks.dropna(), "no null on the right", True)
        .unionByName(form(clicks, "null on the right", True))
        .unionByName(form(clicks, "anti join", False))
    )


@query(
    "one_to_many",
    "SELECT l_partkey, count(DISTINCT l_suppkey) AS n_parents FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1",
)
def one_to_many(spark, sf):
    return quality.several_parents(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query(
    "avg_per_parent",
    """SELECT round(sum(n) / count(o_custkey), 6) AS per_known_parent, round(avg(n), 6) AS average, CAST(sum(n) AS BIGINT) AS children,
  count(o_custkey) AS parents FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01' GROUP BY 1)""",
)
def avg_per_parent(spark, sf):
    month = table(spark, sf, "orders").filter(
        "o_orderdate >= TIMESTAMP '1998-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'"
    )
    out = quality.average_children(month, "o_custkey", "o_orderkey")
    return out.withColumns({c: r6(c) for c in ("per_known_parent", "average")})


@query(
    "string_funcs",
    """SELECT c_custkey, lower(c_name) AS low, c_name || ', ' || c_mktsegment AS joined, replace(c_name, '#', '') AS replaced,
  substr(c_name, 10, 4) AS part, lower(c_mktsegment) LIKE 'm_chin%' AS wild, split(c_name, '#')[-1] AS tail FROM customer""",
)
def string_funcs(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.lower("c_name").alias("low"),
        F.concat("c_name", F.lit(", "), "c_mktsegment").alias("joined"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit("")).alias("replaced"),
        F.substring("c_name", 10, 4).alias("part"),
        F.lower("c_mktsegment").like("m_chin%").alias("wild"),
        F.element_at(F.split("c_name", "#"), -1).alias("tail"),
    )


@query(
    "cast_funcs",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS as_number,
  TRY_CAST(substr(o_orderpriority, 3, 2) AS BIGINT) AS not_a_number, CAST(o_orderdate AS DATE) AS as_date,
  CAST(date_sub('hour', TIMESTAMP '1998-01-01 12:30:00', o_orderdate) AS BIGINT) AS hours FROM orders""",
)
def cast_funcs(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CAST(o_orderkey AS STRING) AS as_text",
        "TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS as_number",
        "TRY_CAST(substr(o_orderpriority, 3, 2) AS BIGINT) AS not_a_number",
        "CAST(o_orderdate AS DATE) AS as_date",
        "timestampdiff(HOUR, TIMESTAMP '1998-01-01 12:30:00', o_orderdate) AS hours",
    )


@query(
    "match_coverage",
    """SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS filled,
  count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000 THEN o_custkey END) AS urgent_large FROM orders""",
)
def match_coverage(spark, sf):
    flags = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("filled"),
        F.max(F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000), 1).otherwise(0)).alias("urgent_large"),
    )
    return flags.agg(
        F.count("o_custkey").alias("customers"),
        F.sum("filled").alias("filled"),
        F.sum("urgent_large").alias("urgent_large"),
    )


# The next day's orders: some are gone, some new, some have another price, status or both.
NEXT_DAY = """SELECT o_orderkey + CASE WHEN o_orderkey % 89 = 0 THEN 1000000000 ELSE 0 END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 50 = 1 THEN 'X' WHEN o_orderkey % 50 <> 2 THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 100 IN (1, 7) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM {orders}"""


@query(
    "version_changes",
    f"WITH old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders), new AS ({NEXT_DAY.format(orders='orders')})"
    + """, side AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
    CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
    CASE WHEN o.o_orderkey = n.o_orderkey THEN concat_ws(',', CASE WHEN o.o_orderstatus IS DISTINCT FROM n.o_orderstatus THEN 'o_orderstatus' END,
      CASE WHEN o.o_totalprice IS DISTINCT FROM n.o_totalprice THEN 'o_totalprice' END) END AS changed_columns
  FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey)
SELECT * FROM side WHERE change <> 'changed' OR changed_columns <> ''""",
)
def version_changes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    later = spark.sql(NEXT_DAY.format(orders="{orders}"), orders=orders)
    folder = f"{shared_folder(spark)}/waymark/{uuid.uuid4().hex}"
    versions.write_version(orders, f"{folder}/old", ["o_orderkey"])
    versions.write_version(later, f"{folder}/new", ["o_orderkey"])
    found = versions.changes(spark, f"{folder}/old", f"{folder}/new", ["o_orderkey"])
    return found.withColumn("changed_columns", F.array_join("changed_columns", ","))


STATES = f"""ev AS (SELECT *, {K} FROM events),
snaps AS (SELECT user_id, ts, max(CASE WHEN k % 7 <> 6 THEN k % 3 END) AS state FROM ev WHERE event_type IN ('click', 'view') GROUP BY ALL),
steps AS (SELECT *, lag(state) OVER w AS before, row_number() OVER w AS n FROM snaps WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT user_id, state, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_until FROM steps
  WHERE n = 1 OR state IS DISTINCT FROM before)"""


def _states(spark, sf):
    snaps = ev(spark, sf).filter("event_type IN ('click', 'view')").selectExpr("user_id", "ts", "CASE WHEN k % 7 <> 6 THEN k % 3 END AS state")
    return validity_intervals(snaps, ["user_id"], "ts", ["state"])


@query("validity_intervals", f"WITH {STATES} SELECT * FROM runs")
def validity_of_states(spark, sf):
    return _states(spark, sf)


@query(
    "valid_at",
    f"WITH {STATES}"
    + """ SELECT e.event_id, e.user_id, e.ts, s.state FROM (SELECT * FROM ev WHERE event_type = 'signup') e
ASOF LEFT JOIN snaps s ON s.user_id = e.user_id AND s.ts <= e.ts""",
)
def state_at_signup(spark, sf):
    signups = ev(spark, sf).filter("event_type = 'signup'").select("event_id", "user_id", "ts")
    return valid_at(signups, _states(spark, sf), ["user_id"], "ts", ["state"])
