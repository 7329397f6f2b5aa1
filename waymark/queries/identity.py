"""Identity resolution and geography on the customer, supplier and event tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from waymark.plans import identity
from waymark.queries.registry import query
from waymark.queries.standins import ev, K, rows, table, with_

RUN_DATE = dt.date(2024, 1, 16)


@query(
    "identity_first_seen",
    with_("leads", "identifies")
    + """SELECT DISTINCT l.id AS lead_or_contact_id, l.email, i.anonymous_id, i.first_appearance_at, 'example.com' AS source,
  TIMESTAMP '2024-01-16 00:00:00' AS extract_date
FROM leads l JOIN (SELECT anonymous_id, email, min(timestamp) AS first_appearance_at FROM identifies GROUP BY ALL) i
  ON l.email = i.email""",
)
def identity_first_seen(spark, sf):
    return identity.lead_to_visitor(rows(spark, sf, "leads"), rows(spark, sf, "identifies"), RUN_DATE, "example.com")


@query(
    "identity_bridge_rank",
    with_("leads", "identifies")
    + """, clients AS (
  SELECT DISTINCT 'g' || CAST(vec_id % 60 AS VARCHAR) AS ga_cid, 'GA' AS source FROM embeddings WHERE len(embedding) > 0
  UNION SELECT DISTINCT ga_cid, 'Segment' FROM identifies),
ranked AS (SELECT *, rank() OVER (PARTITION BY ga_cid ORDER BY source) AS rnk FROM clients)
SELECT DISTINCT 'L' || CAST(c_custkey AS VARCHAR) AS sfdc_lead_or_contact_id, r.ga_cid AS ga_client_id, r.source, l.created_at AS first_appearance_at
FROM customer c JOIN leads l ON l.id = 'L' || CAST(c_custkey AS VARCHAR)
JOIN ranked r ON r.rnk = 1 AND r.ga_cid = 'g' || CAST(c.c_nationkey * 3 AS VARCHAR)""",
)
def identity_bridge_rank(spark, sf):
    # Sessions are the embedding rows (a repeated column); both bridges go through the nation.
    sessions = table(spark, sf, "embeddings").selectExpr("'g' || CAST(vec_id % 60 AS STRING) AS client_id", "embedding AS hits")
    nation = table(spark, sf, "nation").selectExpr("'g' || CAST(n_nationkey * 3 AS STRING) AS ga_client_id", "n_nationkey AS bridge_id")
    lead_bridge = table(spark, sf, "customer").selectExpr("'L' || CAST(c_custkey AS STRING) AS lead_id", "c_nationkey AS bridge_id")
    return identity.lead_to_client(rows(spark, sf, "leads"), sessions, rows(spark, sf, "identifies"), nation, lead_bridge)


@query(
    "unnest_scan",
    """SELECT label, count(*) AS n, round(sum(x), 3) AS total
FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY label""",
)
def unnest_scan(spark, sf):
    flat = identity.unnest(table(spark, sf, "embeddings"), "embedding", ["label"], "x")
    return flat.groupBy("label").agg(F.count("x").alias("n"), F.round(F.sum(F.col("x").cast("double")), 3).alias("total"))


PEOPLE = """people AS (
  SELECT DISTINCT * FROM (
    SELECT id, email, 'lead' AS origin, created_at AS lead_create_ts FROM leads WHERE is_deleted = FALSE
    UNION ALL
    SELECT coalesce(l.id, c.id), c.email, CASE WHEN l.id IS NULL THEN 'contact' ELSE 'lead' END,
      coalesce(l.created_at, c.created_at)
    FROM contacts c LEFT JOIN leads l ON l.converted_contact_id = c.id WHERE c.is_deleted = FALSE))"""


@query("lead_contact_unify", with_("leads", "contacts", then=PEOPLE) + "SELECT * FROM people")
def lead_contact_unify(spark, sf):
    return identity.unify_people(rows(spark, sf, "leads"), rows(spark, sf, "contacts"))


@query(
    "lead_contact_unify_contact_first",
    with_("leads", "contacts")
    + """SELECT DISTINCT * FROM (
  SELECT id, email, 'lead' AS origin, created_at AS lead_create_ts FROM leads WHERE is_deleted IS DISTINCT FROM TRUE
  UNION ALL
  SELECT c.id, c.email, 'contact', c.created_at FROM contacts c LEFT JOIN leads l ON l.converted_contact_id = c.id
  WHERE c.is_deleted IS DISTINCT FROM TRUE)""",
)
def lead_contact_unify_contact_first(spark, sf):
    return identity.unify_people(
        rows(spark, sf, "leads"), rows(spark, sf, "contacts"), precedence="contact", keep_null_deleted=True
    )


ACCOUNTS = """accounts AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS area,
  r_name AS region, n_name || '/' || r_name AS subregion FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def accounts(spark, sf):
    joined = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr(
        "n_nationkey AS id", "CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS area", "r_name AS region", "n_name || '/' || r_name AS subregion"
    )


PLACED = """placed AS (SELECT DISTINCT * FROM (
  SELECT a.id, a.email, 'lead' AS origin, a.created_at AS lead_create_ts, a.theater, coalesce(m.area, c.area, a.area) AS area,
    coalesce(m.region, c.region, a.region) AS region, coalesce(m.subregion, c.subregion) AS subregion
  FROM leads a LEFT JOIN accounts m ON a.matched_acct_id = m.id LEFT JOIN accounts c ON a.converted_acct_id = c.id
  WHERE NOT a.is_deleted
  UNION ALL
  SELECT coalesce(l.id, c.id), c.email, CASE WHEN l.id IS NULL THEN 'contact' ELSE 'lead' END, coalesce(l.created_at, c.created_at),
    coalesce(l.theater, c.account_theater), coalesce(a.area, c.area), coalesce(a.region, c.region), a.subregion
  FROM contacts c LEFT JOIN leads l ON l.converted_contact_id = c.id LEFT JOIN accounts a ON c.account_id = a.id
  WHERE NOT c.is_deleted))"""


@query("lead_contact_geography", with_("leads", "contacts", then=f"{ACCOUNTS}, {PLACED}") + "SELECT * FROM placed")
def lead_contact_geography(spark, sf):
    return identity.unify_people(rows(spark, sf, "leads"), rows(spark, sf, "contacts"), accounts=accounts(spark, sf))


MERGES = """gone AS (SELECT c_name AS name, c_mktsegment AS company, 'L' || c_custkey AS id, 'u' || c_custkey || '@old.example.org' AS email,
    c_nationkey % 3 = 0 AS is_deleted, CAST(DATE '2024-01-01' + CAST(c_nationkey AS INT) AS TIMESTAMP) AS last_modified_at FROM customer),
history AS (SELECT 'L' || (c_custkey + 1) AS lead_id, c_name || ', ' || c_mktsegment AS old_value,
    CASE WHEN c_nationkey % 2 = 0 THEN 'leadMerged' ELSE 'created' END AS field,
    CAST(DATE '2024-01-01' + CAST(c_nationkey AS INT) AS TIMESTAMP) AS created_at FROM customer),
merges AS (SELECT g.id AS deleted_lead_id, g.email AS deleted_email, h.lead_id AS master_lead_id, m.email AS master_email,
    g.last_modified_at AS merged_at
  FROM gone g JOIN history h ON h.old_value = g.name || ', ' || g.company AND h.created_at = g.last_modified_at AND h.field = 'leadMerged'
  JOIN gone m ON h.lead_id = m.id WHERE g.is_deleted AND m.email <> g.email)"""


def merges(spark, sf, domain="@old.example.org"):
    customer = table(spark, sf, "customer")
    day = "CAST(DATE '2024-01-01' + CAST(c_nationkey AS INT) AS TIMESTAMP)"
    leads = customer.selectExpr(
        "c_name AS name",
        "c_mktsegment AS company",
        "'L' || CAST(c_custkey AS STRING) AS id",
        f"'u' || CAST(c_custkey AS STRING) || '{domain}' AS email",
        "c_nationkey % 3 = 0 AS is_deleted",
        f"{day} AS last_modified_at",
    )
    history = customer.selectExpr(
        "'L' || CAST(c_custkey + 1 AS STRING) AS lead_id",
        "c_name || ', ' || c_mktsegment AS old_value",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'leadMerged' ELSE 'created' END AS field",
        f"{day} AS created_at",
    )
    return identity.merged_leads(leads, history)


@query("merged_leads", "WITH " + MERGES + " SELECT * FROM merges")
def merged_leads(spark, sf):
    return merges(spark, sf)


@query(
    "merged_identity",
    "WITH "
    + MERGES
    + """SELECT DISTINCT s.org_id, s.email AS signup_email, m.master_email, m.master_lead_id,
  coalesce(m.master_email, s.email) AS merged_email
FROM (SELECT o_custkey AS org_id, 'u' || o_custkey || '@old.example.org' AS email FROM orders) s LEFT JOIN merges m ON s.email = m.deleted_email""",
)
def merged_identity(spark, sf):
    signups = table(spark, sf, "orders").selectExpr(
        "o_custkey AS org_id", "'u' || CAST(o_custkey AS STRING) || '@old.example.org' AS email"
    )
    return identity.apply_merges(signups, merges(spark, sf))


# Each customer is merged into the next, in runs of up to seven; the seventh was merged before, so a run ends there.
CHAINED = """chained AS (SELECT 'L' || c_custkey AS deleted_lead_id, 'u' || c_custkey || '@old.example.org' AS deleted_email,
    'L' || (c_custkey + 1) AS master_lead_id, 'u' || (c_custkey + 1) || '@old.example.org' AS master_email,
    CAST(DATE '2024-01-01' + CAST(c_custkey % 7 AS INT) AS TIMESTAMP) AS merged_at FROM customer WHERE c_nationkey <> 3)"""


@query(
    "merge_chains",
    "WITH RECURSIVE "
    + CHAINED
    + """, steps AS (SELECT deleted_lead_id, deleted_email, merged_at, master_lead_id, master_email, merged_at AS last_at, 1 AS n FROM chained
  UNION ALL SELECT s.deleted_lead_id, s.deleted_email, s.merged_at, c.master_lead_id, c.master_email, c.merged_at, n + 1
  FROM steps s JOIN chained c ON c.deleted_lead_id = s.master_lead_id AND c.merged_at > s.last_at)
SELECT deleted_lead_id, deleted_email, merged_at, arg_max(master_lead_id, n) AS master_lead_id, arg_max(master_email, n) AS master_email
FROM steps GROUP BY 1, 2, 3""",
)
def merge_chains(spark, sf):
    merges = table(spark, sf, "customer").filter("c_nationkey <> 3").selectExpr(
        "'L' || CAST(c_custkey AS STRING) AS deleted_lead_id",
        "'u' || CAST(c_custkey AS STRING) || '@old.example.org' AS deleted_email",
        "'L' || CAST(c_custkey + 1 AS STRING) AS master_lead_id",
        "'u' || CAST(c_custkey + 1 AS STRING) || '@old.example.org' AS master_email",
        "CAST(DATE '2024-01-01' + CAST(c_custkey % 7 AS INT) AS TIMESTAMP) AS merged_at",
    )
    return identity.last_survivors(merges)


@query(
    "first_child_per_parent",
    """SELECT o_custkey AS org_id, o_orderkey AS user_id, c_name AS email, o_orderdate AS joined_at FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) o
LEFT JOIN customer ON c_custkey = o_custkey WHERE rn = 1""",
)
def first_child_per_parent(spark, sf):
    orders = table(spark, sf, "orders")
    memberships = orders.selectExpr("o_custkey AS org_id", "o_orderkey AS user_id", "o_orderdate AS created_at")
    users = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").selectExpr(
        "o_orderkey AS id", "c_name AS email", "o_orderdate AS created_at"
    )
    return identity.first_user_per_org(users, memberships).select("org_id", "user_id", "email", "joined_at")


SIGNUPS = """signups AS (SELECT m.org_id, m.user_id, u.email, coalesce(u.created_at, m.created_at) AS signed_up_at
  FROM memberships m JOIN users u ON u.id = m.user_id)"""


@query(
    "org_person_map",
    with_("users", "memberships", "leads", "contacts", then=f"{SIGNUPS}, {PEOPLE}")
    + """SELECT org_id, lead_or_contact_id, user_id, email, signed_up_at, origin, lead_create_ts FROM (
  SELECT s.*, p.id AS lead_or_contact_id, p.origin, p.lead_create_ts, row_number() OVER (PARTITION BY s.org_id, p.id, s.email
    ORDER BY s.signed_up_at NULLS FIRST, p.lead_create_ts NULLS FIRST, s.user_id, p.origin NULLS FIRST) AS rn
  FROM signups s LEFT JOIN people p ON s.email = p.email) WHERE rn = 1""",
)
def org_person_map(spark, sf):
    people = identity.unify_people(rows(spark, sf, "leads"), rows(spark, sf, "contacts"))
    return identity.org_to_person(rows(spark, sf, "users"), rows(spark, sf, "memberships"), people)


@query(
    "org_person_map_product_led",
    with_("users", "memberships", "orgs", "leads", "contacts", then=PEOPLE)
    + """, joined AS (
  SELECT m.org_id, m.user_id, s.email, coalesce(s.created_at, m.created_at) AS signed_up_at, m.created_at AS joined_at,
    s.created_at AS user_created_at, p.id AS lead_or_contact_id, p.origin, p.lead_create_ts, o.deactivated_at, o.is_customer
  FROM memberships m JOIN users s ON s.id = m.user_id JOIN orgs o ON o.id = m.org_id AND o.is_customer AND o.motion = 'Product-Led'
  LEFT JOIN people p ON s.email = p.email WHERE s.email NOT LIKE '%@service.example.com'),
placed AS (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY signed_up_at NULLS FIRST, lead_create_ts NULLS FIRST, user_id,
      lead_or_contact_id NULLS FIRST, origin NULLS FIRST, email, joined_at) AS rnk_is_first_signup,
    row_number() OVER (PARTITION BY org_id, user_id, email, lead_or_contact_id ORDER BY signed_up_at NULLS FIRST, lead_create_ts NULLS FIRST,
      origin NULLS FIRST, joined_at) AS rnk_email FROM (SELECT DISTINCT * FROM joined))
SELECT org_id, lead_or_contact_id, user_id, email, signed_up_at, origin, lead_create_ts, deactivated_at, is_customer, rnk_is_first_signup
FROM placed WHERE rnk_email = 1""",
)
def org_person_map_product_led(spark, sf):
    people = identity.unify_people(rows(spark, sf, "leads"), rows(spark, sf, "contacts"))
    return identity.org_to_person_product_led(
        rows(spark, sf, "users"), rows(spark, sf, "memberships"), rows(spark, sf, "orgs"), people, "%@service.example.com"
    )


@query(
    "earliest_org_per_lead",
    with_("memberships", "users", "leads")
    + """SELECT DISTINCT org_id, lead_or_contact_id FROM (
  SELECT m.org_id, l.id AS lead_or_contact_id, rank() OVER (PARTITION BY l.id ORDER BY CAST(m.created_at AS DATE)) AS rnk
  FROM memberships m JOIN users u ON u.id = m.user_id JOIN leads l ON l.email = u.email) WHERE rnk = 1""",
)
def earliest_org_per_lead(spark, sf):
    # Days, so that several orgs share the first place.
    signups = identity.signup_users(rows(spark, sf, "users"), rows(spark, sf, "memberships"))
    leads = rows(spark, sf, "leads").select(F.col("id").alias("lead_or_contact_id"), "email")
    dated = signups.join(leads, "email").withColumn("signed_up_at", F.to_date("joined_at"))
    return identity.earliest_org_per_lead(dated)


SNAPSHOTS = """snaps AS (SELECT user_id AS id, CAST(ts AS DATE) AS day, 'user ' || min(k) AS name,
    CASE min(k) % 3 WHEN 0 THEN 'Inbound SDR' WHEN 1 THEN 'Outbound SDR' ELSE 'Other' END AS role, user_id + 1 AS manager_id
  FROM ev GROUP BY user_id, CAST(ts AS DATE))"""


def snapshots(spark, sf):
    daily = ev(spark, sf).groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("day")).agg(F.min("k").alias("k"))
    return daily.selectExpr(
        "id",
        "day",
        "'user ' || CAST(k AS STRING) AS name",
        "CASE k % 3 WHEN 0 THEN 'Inbound SDR' WHEN 1 THEN 'Outbound SDR' ELSE 'Other' END AS role",
        "id + 1 AS manager_id",
    )


@query(
    "snapshot_join",
    f"WITH ev AS (SELECT *, {K} FROM events), {SNAPSHOTS}"
    + """SELECT e.event_id, e.user_id AS owner_id, e.ts AS activity_at, s.name AS user_name, s.role, m.name AS manager_name
FROM ev e LEFT JOIN snaps s ON s.id = e.user_id AND s.day = CAST(e.ts AS DATE)
LEFT JOIN snaps m ON m.id = s.manager_id AND m.day = s.day""",
)
def snapshot_join(spark, sf):
    activities = ev(spark, sf).selectExpr("event_id", "user_id AS owner_id", "ts AS activity_at")
    return identity.as_of_day(activities, snapshots(spark, sf), "owner_id", "activity_at")


@query(
    "static_lookup",
    """SELECT o_orderkey, o_orderpriority AS user_name, manager_name
FROM orders LEFT JOIN (VALUES ('1-URGENT', 'Ann'), ('2-HIGH', 'Bo'), ('5-LOW', 'Cy')) m(sdr_name, manager_name)
  ON o_orderpriority = sdr_name""",
)
def static_lookup(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderpriority AS user_name")
    managers = spark.createDataFrame([("1-URGENT", "Ann"), ("2-HIGH", "Bo"), ("5-LOW", "Cy")], "sdr_name string, manager_name string")
    return identity.with_manager(orders, managers)


HISTORY = """history AS (SELECT context_ip AS ip, visit_start_time AS execution_ts,
    CASE WHEN visitor_id % 9 <> 8 THEN 'c' || substr(page_visit_id, 1, 2) END AS country, 'NATION_' || (visitor_id % 25) AS country_name
  FROM page_views WHERE domain = 'docs.example.com' AND visit_start_time >= TIMESTAMP '2024-01-04 12:00:00'),
latest AS (SELECT p.page_visit_id, h.country, h.country_name, h.execution_ts,
    row_number() OVER (PARTITION BY p.page_visit_id ORDER BY h.execution_ts DESC NULLS LAST) AS rn
  FROM page_views p LEFT JOIN history h ON p.context_ip = h.ip AND CAST(h.execution_ts AS DATE) <= CAST(p.visit_start_time AS DATE)),
earliest AS (SELECT *, row_number() OVER (PARTITION BY ip ORDER BY execution_ts) AS rn FROM history)"""


def _history(spark, sf):
    pages = rows(spark, sf, "page_views")
    docs = pages.filter("domain = 'docs.example.com' AND visit_start_time >= TIMESTAMP '2024-01-04 12:00:00'")
    return docs.selectExpr(
        "context_ip AS ip",
        "visit_start_time AS execution_ts",
        "CASE WHEN visitor_id % 9 <> 8 THEN 'c' || substr(page_visit_id, 1, 2) END AS country",
        "'NATION_' || CAST(visitor_id % 25 AS STRING) AS country_name",
    )


def _visits(spark, sf):
    return rows(spark, sf, "page_views").select("page_visit_id", "context_ip", "visit_start_time")


@query(
    "asof_latest",
    with_("page_views", then=HISTORY)
    + """SELECT p.page_visit_id, p.context_ip, p.visit_start_time, l.country, l.country_name, l.execution_ts AS ip_snapshot_ts
FROM page_views p JOIN latest l ON l.page_visit_id = p.page_visit_id AND l.rn = 1""",
)
def asof_latest(spark, sf):
    return identity.country_of_visit(_visits(spark, sf), _history(spark, sf), fallback=False)


@query(
    "asof_fallback",
    with_("page_views", then=HISTORY)
    + """SELECT p.page_visit_id, p.context_ip, p.visit_start_time,
  coalesce(l.country, CASE WHEN l.country IS NULL THEN e.country END) AS country,
  coalesce(l.country_name, CASE WHEN l.country IS NULL THEN e.country_name END) AS country_name,
  coalesce(l.execution_ts, CASE WHEN l.country IS NULL THEN e.execution_ts END) AS ip_snapshot_ts
FROM page_views p JOIN latest l ON l.page_visit_id = p.page_visit_id AND l.rn = 1
LEFT JOIN earliest e ON e.ip = p.context_ip AND e.rn = 1""",
)
def asof_fallback(spark, sf):
    return identity.country_of_visit(_visits(spark, sf), _history(spark, sf))


@query(
    "geo_enrich",
    """SELECT c_custkey, country_name, theater FROM (SELECT c_custkey, n_name AS country_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
LEFT JOIN (SELECT DISTINCT n_name AS country, r_name AS theater FROM supplier JOIN nation ON s_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey) ON country = country_name""",
)
def geo_enrich(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    touchpoints = (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("n_name AS country", "r_name AS theater")
    )
    return identity.with_theater(customers.selectExpr("c_custkey", "n_name AS country_name"), touchpoints)


@query(
    "exclude_pattern",
    """SELECT c_custkey, CASE WHEN c_nationkey % 5 <> 4 THEN lower(c_mktsegment) || '@' || lower(c_name) END AS email,
  CASE WHEN c_nationkey % 5 <> 4 THEN 'kept by both' ELSE 'kept null' END AS kept
FROM customer WHERE c_nationkey % 5 = 4 OR lower(c_mktsegment) || '@' || lower(c_name) NOT LIKE 'machinery@%'""",
)
def exclude_pattern(spark, sf):
    people = table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_nationkey % 5 <> 4 THEN lower(c_mktsegment) || '@' || lower(c_name) END AS email"
    )
    with_null = identity.without_internal(people, "machinery@%")
    known = identity.without_internal(people, "machinery@%", keep_null=False).select("c_custkey", F.lit("kept by both").alias("kept"))
    return with_null.join(known, "c_custkey", "left").fillna("kept null", ["kept"])
