"""Sales-assist credit and promotional credit on the event, order and lineitem tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from waymark.plans import assist, credits, identity
from waymark.queries.identity import ACCOUNTS, MERGES, PEOPLE, PLACED, SNAPSHOTS, accounts, merges, snapshots
from waymark.queries.registry import query, r6
from waymark.queries.standins import rows, table, with_
from waymark.sources.sinks import stage

SINCE = dt.date(2024, 1, 3)

TASK_LOG = """task_log AS (
  SELECT subject, who_id, owner_id, activity_at FROM tasks WHERE activity_at >= TIMESTAMP '2024-01-03'
    AND (subject LIKE '%[Call]%' OR subject LIKE '%[Email] [In]%')
  UNION ALL SELECT tool_type, who_id, owner_id, activity_at FROM tasks WHERE activity_at >= TIMESTAMP '2024-01-03'
    AND tool_direction = 'Inbound' AND tool_type LIKE 'Received Email')"""


def _tasks(spark, sf):
    return assist.task_log(rows(spark, sf, "tasks"), SINCE)


@query("task_log", with_("tasks", then=TASK_LOG) + "SELECT * FROM task_log")
def task_log(spark, sf):
    return _tasks(spark, sf)


@query(
    "activity_enrich",
    with_("tasks", "leads", "contacts", then=f"{TASK_LOG}, {SNAPSHOTS}, {ACCOUNTS}, {PLACED}")
    + """, enriched AS (SELECT t.subject, coalesce(l2.id, l.id) AS lead_id, l.converted_contact_id, c.id AS contact_id, t.who_id, t.activity_at, t.owner_id,
    CASE WHEN CAST(t.activity_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND t.owner_id IN (3, 5, 8, 13) THEN 'cSDR' ELSE s.role END AS task_owner_role,
    s.name AS user_name, m.name AS manager_name
  FROM task_log t JOIN snaps s ON s.id = t.owner_id AND s.day = CAST(t.activity_at AS DATE)
  LEFT JOIN snaps m ON m.id = s.manager_id AND m.day = s.day
  LEFT JOIN leads l ON l.converted_contact_id = t.who_id LEFT JOIN leads l2 ON l2.id = t.who_id LEFT JOIN contacts c ON c.id = t.who_id
  WHERE s.role IN ('Inbound SDR', 'Outbound SDR', 'cSDR'))
SELECT e.*, p.theater, p.region, p.subregion, CASE WHEN task_owner_role = 'cSDR' THEN 1 ELSE 0 END AS is_csdr
FROM enriched e LEFT JOIN placed p ON p.id = e.who_id""",
)
def activity_enrich(spark, sf):
    leads, contacts = rows(spark, sf, "leads"), rows(spark, sf, "contacts")
    people = identity.unify_people(leads, contacts, accounts=accounts(spark, sf))
    return assist.enrich_activities(
        _tasks(spark, sf),
        snapshots(spark, sf),
        leads,
        contacts,
        people,
        cloud_owners=(3, 5, 8, 13),
        cloud_from=dt.date(2024, 1, 10),
        cloud_until=dt.date(2024, 1, 20),
    )


@query(
    "signup_leads",
    with_("orgs", "users", "leads")
    + """, people AS (SELECT DISTINCT id, email, created_at AS lead_create_ts FROM leads WHERE NOT is_deleted),
merged AS (SELECT o.id AS org_id, u.email AS signup_email, CASE WHEN o.id % 4 = 0 THEN 'u1@mail.example.org' END AS master_email,
    CASE WHEN o.id % 4 = 0 THEN 'L2' END AS master_lead_id, o.created_at AS signed_up_at FROM orgs o JOIN users u ON u.id = o.id)
SELECT DISTINCT org_id, coalesce(master_lead_id, p.id) AS lead_or_contact_id, signup_email, master_email, signed_up_at
FROM merged m JOIN people p ON p.email = coalesce(master_email, signup_email)
WHERE date_sub('day', p.lead_create_ts, signed_up_at) >= -1""",
)
def signup_leads(spark, sf):
    orgs = rows(spark, sf, "orgs").join(rows(spark, sf, "users").select("id", "email"), "id")
    signups = orgs.selectExpr(
        "id AS org_id",
        "email AS signup_email",
        "CASE WHEN id % 4 = 0 THEN 'u1@mail.example.org' END AS master_email",
        "CASE WHEN id % 4 = 0 THEN 'L2' END AS master_lead_id",
        "created_at AS signed_up_at",
    ).withColumn("merged_email", F.coalesce("master_email", "signup_email"))
    people = rows(spark, sf, "leads").filter("NOT is_deleted").selectExpr(
        "id", "email", "'lead' AS origin", "created_at AS lead_create_ts"
    )
    return assist.signup_leads(signups, people).select(
        "org_id", "lead_or_contact_id", "signup_email", "master_email", "signed_up_at"
    )


def _pairs_sql(mail: int, call: int) -> str:
    return PAIRS.replace("<= 6 AND", f"<= {mail} AND").replace("<= 3 AND", f"<= {call} AND")


PAIRS = """pairs AS (SELECT s.org_id, s.lead_or_contact_id, s.signed_up_at, a.subject, a.activity_at, a.owner_id, a.user_name, a.manager_name, a.is_csdr
  FROM signup_leads s JOIN activities a ON coalesce(a.lead_id, a.contact_id) = s.lead_or_contact_id
  WHERE a.activity_at < s.signed_up_at AND (
    (CAST(s.signed_up_at AS DATE) - CAST(a.activity_at AS DATE) <= 6 AND lower(a.subject) LIKE '%email%')
    OR (CAST(s.signed_up_at AS DATE) - CAST(a.activity_at AS DATE) <= 3 AND a.subject LIKE '%[Call]%')))"""
FIRST_ACT = """first_act AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY activity_at, owner_id) AS rn FROM pairs) WHERE rn = 1)"""


def _pairs(spark, sf):
    # Six and three days instead of thirty and fifteen, so that some activities are too old.
    return assist.qualifying_pairs(rows(spark, sf, "signup_leads"), rows(spark, sf, "activities"), call_days=3, mail_days=6)


@query(
    "qualifying_activity",
    with_("signup_leads", "activities", then=f"{PAIRS}, {FIRST_ACT}")
    + "SELECT org_id, lead_or_contact_id, signed_up_at, activity_at, owner_id, user_name, subject FROM first_act",
)
def qualifying_activity(spark, sf):
    return assist.first_activity(_pairs(spark, sf)).select(
        "org_id", "lead_or_contact_id", "signed_up_at", "activity_at", "owner_id", "user_name", "subject"
    )


@query(
    "qualifying_activity_published",
    with_("signup_leads", "activities", then=f"{_pairs_sql(30, 15)}, {FIRST_ACT}")
    + "SELECT org_id, lead_or_contact_id, signed_up_at, activity_at, owner_id, user_name, subject FROM first_act",
)
def qualifying_activity_published(spark, sf):
    pairs = assist.qualifying_pairs(rows(spark, sf, "signup_leads"), rows(spark, sf, "activities"))
    return assist.first_activity(pairs).select(
        "org_id", "lead_or_contact_id", "signed_up_at", "activity_at", "owner_id", "user_name", "subject"
    )


PROMO = """first_promo AS (SELECT org_id, promo_code, promo_created_at, creator_id AS promo_owner, name AS promo_user, manager AS promo_manager FROM (
  SELECT p.*, s.name, m.name AS manager, row_number() OVER (PARTITION BY p.org_id ORDER BY promo_created_at, creator_id) AS rn
  FROM promos p JOIN promo_snapshots s ON s.id = p.creator_id AND s.day = CAST(p.promo_created_at AS DATE)
  LEFT JOIN promo_snapshots m ON m.id = s.manager_id AND m.day = s.day
  WHERE status = 'Claimed' AND promo_code_id <> '48' AND promo_code <> 'P4' AND s.role IN ('Inbound SDR', 'Outbound SDR', 'cSDR')) WHERE rn = 1)"""


def _promos(spark, sf):
    return assist.first_promo(rows(spark, sf, "promos"), rows(spark, sf, "promo_snapshots"), ("48",), ("P4",))


@query("first_promo", with_("promos", "promo_snapshots", then=PROMO) + "SELECT * FROM first_promo")
def first_promo(spark, sf):
    return _promos(spark, sf)


def _resolved(safe: bool) -> str:
    promo, act = "CAST(p.promo_created_at AS DATE)", "CAST(a.activity_at AS DATE)"
    by = f"{promo} <= {act}" + (f" OR ({promo} IS NOT NULL AND {act} IS NULL)" if safe else "")
    return f"""CASE WHEN {by} THEN {promo} ELSE {act} END AS first_act_date, CASE WHEN {by} THEN promo_user ELSE a.user_name END AS assist_user,
  CASE WHEN {by} THEN promo_manager ELSE a.manager_name END AS assist_manager, CASE WHEN {by} THEN promo_owner ELSE a.owner_id END AS assist_owner,
  CASE WHEN {by} THEN 'promo_code' WHEN a.activity_at IS NOT NULL THEN 'activity' END AS assisted_orig"""


ASSIST_TABLES = ("signup_leads", "activities", "promos", "promo_snapshots")


def _earliest_sql(safe: bool) -> str:
    return f"""SELECT s.org_id, s.lead_or_contact_id, s.signed_up_at AS first_org_signup_at, a.is_csdr, {_resolved(safe)}
FROM signup_leads s LEFT JOIN first_promo p ON p.org_id = s.org_id LEFT JOIN first_act a ON a.org_id = s.org_id"""


def _earliest(spark, sf, safe):
    return assist.earliest_assist(rows(spark, sf, "signup_leads"), _promos(spark, sf), assist.first_activity(_pairs(spark, sf)), safe)


@query("earliest_assist", with_(*ASSIST_TABLES, then=f"{PAIRS}, {FIRST_ACT}, {PROMO}") + _earliest_sql(False))
def earliest_assist(spark, sf):
    return _earliest(spark, sf, False)


@query("earliest_assist_null_safe", with_(*ASSIST_TABLES, then=f"{PAIRS}, {FIRST_ACT}, {PROMO}") + _earliest_sql(True))
def earliest_assist_null_safe(spark, sf):
    return _earliest(spark, sf, True)


@query(
    "all_assists",
    with_(*ASSIST_TABLES, then=f"{PAIRS}, {PROMO}")
    + f"""SELECT DISTINCT s.org_id, s.lead_or_contact_id, s.signed_up_at AS first_org_signup_at, a.activity_at, a.is_csdr, {_resolved(False)}
FROM signup_leads s LEFT JOIN first_promo p ON p.org_id = s.org_id
LEFT JOIN pairs a ON a.org_id = s.org_id AND a.lead_or_contact_id = s.lead_or_contact_id""",
)
def all_assists(spark, sf):
    return assist.all_assists(rows(spark, sf, "signup_leads"), _promos(spark, sf), _pairs(spark, sf))


NAMED = "(VALUES ('user 1', 'Ann'), ('user 2', 'Bo'), ('user 4', 'Cy'), ('user 16', 'Di')) m(sdr_name, manager_name)"
CHAIN_MERGES = MERGES.replace("@old.example.org", "@mail.example.org")
ORG_SIGNUPS = """org_signups AS (SELECT DISTINCT o.id AS org_id, u.id AS user_id, u.email, coalesce(u.created_at, o.created_at) AS signed_up_at
  FROM (SELECT * FROM orgs WHERE is_customer) o LEFT JOIN memberships m ON m.org_id = o.id AND EXISTS (SELECT 1 FROM users x WHERE x.id = m.user_id)
  LEFT JOIN users u ON u.id = m.user_id)"""
CHAIN = f"""{CHAIN_MERGES}, {ORG_SIGNUPS}, {PEOPLE}, {TASK_LOG}, {SNAPSHOTS},
signup_leads AS (SELECT s.org_id, coalesce(g.master_lead_id, p.id) AS lead_or_contact_id, min(s.signed_up_at) AS signed_up_at
  FROM org_signups s LEFT JOIN merges g ON g.deleted_email = s.email JOIN people p ON p.email = coalesce(g.master_email, s.email)
  WHERE date_sub('day', p.lead_create_ts, s.signed_up_at) >= -1 GROUP BY 1, 2),
activities AS (SELECT t.subject, coalesce(l2.id, l.id) AS lead_id, c.id AS contact_id, t.activity_at, t.owner_id, s.name AS user_name, m.manager_name,
    CASE WHEN s.role = 'cSDR' THEN 1 ELSE 0 END AS is_csdr
  FROM task_log t JOIN snaps s ON s.id = t.owner_id AND s.day = CAST(t.activity_at AS DATE) LEFT JOIN {NAMED} ON m.sdr_name = s.name
  LEFT JOIN leads l ON l.converted_contact_id = t.who_id LEFT JOIN leads l2 ON l2.id = t.who_id LEFT JOIN contacts c ON c.id = t.who_id
  WHERE s.role IN ('Inbound SDR', 'Outbound SDR', 'cSDR')),
first_promo AS (SELECT org_id, promo_code, promo_created_at, creator_id AS promo_owner, name AS promo_user, manager_name AS promo_manager FROM (
  SELECT p.*, s.name, m.manager_name, row_number() OVER (PARTITION BY p.org_id ORDER BY promo_created_at, creator_id) AS rn
  FROM promos p JOIN promo_snapshots s ON s.id = p.creator_id AND s.day = CAST(p.promo_created_at AS DATE) LEFT JOIN {NAMED} ON m.sdr_name = s.name
  WHERE status = 'Claimed' AND s.role IN ('Inbound SDR', 'Outbound SDR', 'cSDR')) WHERE rn = 1)"""
CHAIN_TABLES = ("orgs", "users", "memberships", "leads", "contacts", "tasks", "promos", "promo_snapshots")


@query("org_signups", with_("orgs", "users", "memberships", then=ORG_SIGNUPS) + "SELECT * FROM org_signups")
def org_signups(spark, sf):
    return assist.org_signups(rows(spark, sf, "orgs"), rows(spark, sf, "users"), rows(spark, sf, "memberships"))


@query(
    "assist_chain",
    with_(*CHAIN_TABLES, then=f"{CHAIN}, {_pairs_sql(30, 15)}, {FIRST_ACT}")
    + f"""SELECT s.org_id, s.lead_or_contact_id, s.signed_up_at AS first_org_signup_at, a.is_csdr, {_resolved(False)}
FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY signed_up_at, lead_or_contact_id) AS rn FROM signup_leads) s
LEFT JOIN first_promo p ON p.org_id = s.org_id LEFT JOIN first_act a ON a.org_id = s.org_id WHERE s.rn = 1""",
)
def assist_chain(spark, sf):
    """From tasks, orgs, users and promos as they are kept to the assist of each org."""
    leads, contacts = rows(spark, sf, "leads"), rows(spark, sf, "contacts")
    names = [("user 1", "Ann"), ("user 2", "Bo"), ("user 4", "Cy"), ("user 16", "Di")]
    managers = spark.createDataFrame(names, "sdr_name string, manager_name string")
    people = identity.unify_people(leads, contacts)
    signups = org_signups(spark, sf).select("org_id", "email", "signed_up_at")
    merged = identity.apply_merges(signups, merges(spark, sf, "@mail.example.org"))
    signed = stage(assist.signup_leads(merged, people).select("org_id", "lead_or_contact_id", "signed_up_at"), "signup_leads")
    placed = identity.unify_people(leads, contacts, accounts=accounts(spark, sf))
    acts = assist.enrich_activities(_tasks(spark, sf), snapshots(spark, sf), leads, contacts, placed, managers=managers)
    first = assist.first_activity(assist.qualifying_pairs(signed, stage(acts, "activities")))
    promos = assist.first_promo(rows(spark, sf, "promos"), rows(spark, sf, "promo_snapshots"), managers=managers)
    return assist.earliest_assist(signed, promos, first)


@query(
    "global_order",
    """SELECT o_orderkey AS org_id, o_orderdate AS first_org_signup_at, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS signup_rnk
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE o_orderdate >= TIMESTAMP '1996-08-31 23:00:00' AND c_nationkey <> 1""",
)
def global_order(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    signups = table(spark, sf, "orders").join(customers, "o_custkey").selectExpr(
        "o_orderkey AS org_id", "o_orderdate AS first_org_signup_at", "o_custkey AS assist_owner", "c_nationkey AS is_csdr"
    )
    cutoff = F.expr("timestamp '1996-08-31 16:00:00 America/Los_Angeles'")
    ordered = assist.signup_order(signups, cutoff)
    return ordered.select("org_id", "first_org_signup_at", "signup_rnk")


@query(
    "quarter_flag",
    """SELECT o_orderkey AS org_id, o_orderdate AS first_org_signup_at, o.r AS signup_rnk, r_name AS region,
  CASE WHEN quarter(o_orderdate) = 3 AND year(o_orderdate) = 1998 THEN 1 ELSE 0 END AS is_signup_current_quarter,
  CASE WHEN o_custkey IN (5, 50) THEN 'Override' ELSE o_orderpriority END AS manager_name_adj
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) END AS r FROM orders) o
JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def quarter_flag(spark, sf):
    orders = table(spark, sf, "orders")
    assists = orders.selectExpr(
        "o_orderkey AS org_id",
        "o_orderdate AS first_org_signup_at",
        "o_custkey AS assist_owner",
        "o_orderpriority AS assist_manager",
        "CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS is_csdr",
    )
    order = assist.signup_order(assists, F.lit("1990-01-01").cast("timestamp"))
    regions = (
        orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("o_orderkey AS org_id", "r_name AS region")
    )
    out = assist.finish_report(assists, order, regions, dt.date(1998, 10, 5), {5: "Override", 50: "Override"})
    return out.select("org_id", "first_org_signup_at", "signup_rnk", "region", "is_signup_current_quarter", "manager_name_adj")


GRANTS = """grants AS (SELECT DISTINCT o_custkey AS org_id, DATE '1999-06-30' + CAST(o_custkey % 400 AS INT) AS credit_expiration_date FROM orders
  WHERE o_orderpriority = '1-URGENT'),
billing AS (SELECT o_custkey AS org_id, CAST(l_shipdate AS DATE) AS date, -l_extendedprice / 1000 AS bill_amount_usd,
    CASE WHEN l_returnflag = 'A' THEN 'PromoCredit' ELSE 'Usage' END AS metric_type,
    CASE WHEN l_linestatus = 'F' THEN 'PAYG' ELSE 'Commit' END AS commercial_model
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
burned AS (SELECT g.org_id, credit_expiration_date, date, sum(bill_amount_usd) AS bill_amount_usd,
    sum(sum(bill_amount_usd)) OVER (PARTITION BY g.org_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_total
  FROM grants g JOIN billing b ON g.org_id = b.org_id AND metric_type = 'PromoCredit' AND commercial_model IN ('PAYG', 'Commit')
    AND credit_expiration_date >= date GROUP BY g.org_id, credit_expiration_date, date),
reached AS (SELECT org_id, credit_expiration_date, min(CASE WHEN abs(running_total) >= 100 THEN date END) AS date_reach_100,
    min(CASE WHEN abs(running_total) >= 200 THEN date END) AS date_reach_200, min(CASE WHEN abs(running_total) >= 300 THEN date END) AS date_reach_300,
    min(CASE WHEN abs(running_total) >= 400 THEN date END) AS date_reach_400 FROM burned GROUP BY ALL)"""


def _burned(spark, sf):
    orders = table(spark, sf, "orders")
    grants = orders.filter("o_orderpriority = '1-URGENT'").selectExpr(
        "o_custkey AS org_id", "DATE '1999-06-30' + CAST(o_custkey % 400 AS INT) AS credit_expiration_date"
    )
    billing = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_custkey AS org_id",
        "CAST(l_shipdate AS DATE) AS date",
        "-l_extendedprice / 1000 AS bill_amount_usd",
        "CASE WHEN l_returnflag = 'A' THEN 'PromoCredit' ELSE 'Usage' END AS metric_type",
        "CASE WHEN l_linestatus = 'F' THEN 'PAYG' ELSE 'Commit' END AS commercial_model",
    )
    return credits.burn_down(grants, billing)


@query(
    "burn_down",
    "WITH " + GRANTS + " SELECT org_id, date, round(bill_amount_usd, 6) AS bill_amount_usd, round(running_total, 6) AS running_total FROM burned",
)
def burn_down(spark, sf):
    return _burned(spark, sf).select("org_id", "date", r6("bill_amount_usd").alias("bill_amount_usd"), r6("running_total").alias("running_total"))


@query("threshold_dates", "WITH " + GRANTS + " SELECT * FROM reached")
def threshold_dates(spark, sf):
    return credits.threshold_dates(_burned(spark, sf))


@query(
    "payment_flag",
    "WITH "
    + GRANTS
    + """SELECT r.*, c_mktsegment AS billing_method, CASE c_mktsegment WHEN 'STRIPE' THEN coalesce(c_acctbal > 0, FALSE) WHEN 'MARKETPLACE' THEN TRUE WHEN 'MANUAL' THEN TRUE END AS has_payment_method
FROM reached r JOIN (SELECT c_custkey, c_acctbal, c_nationkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'MARKETPLACE' WHEN 'FURNITURE' THEN 'MANUAL'
    WHEN 'BUILDING' THEN 'OTHER' ELSE 'STRIPE' END AS c_mktsegment FROM customer) ON c_custkey = r.org_id
WHERE date_reach_200 IS NOT NULL AND c_nationkey < 20 AND c_acctbal < 9000""",
)
def payment_flag(spark, sf):
    customer = table(spark, sf, "customer")
    orgs = customer.selectExpr(
        "c_custkey AS id",
        "c_custkey AS billing_customer_id",
        "c_nationkey AS nation",
        "c_acctbal AS balance",
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 'MARKETPLACE' WHEN 'FURNITURE' THEN 'MANUAL' WHEN 'BUILDING' THEN 'OTHER' ELSE 'STRIPE' END AS billing_method",
    )
    payers = customer.selectExpr("c_custkey AS id", "c_acctbal > 0 AS has_payment_method_attached")
    chosen = [F.col("nation") < 20, F.col("balance") < 9000]
    return credits.credit_report(credits.threshold_dates(_burned(spark, sf)), orgs, payers, chosen).drop("nation", "balance")
