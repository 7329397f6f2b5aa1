"""Inquiries, dashboard and conversion figures on the event, part and lineitem tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from waymark.functions import times
from waymark.plans import dashboard, identity, inquiry
from waymark.plans.pipeline import build_web
from waymark.queries.identity import PEOPLE, SIGNUPS
from waymark.queries.registry import query, r6
from waymark.queries.standins import rows, table, with_
from waymark.queries.web import page_logs
from waymark.sources.sinks import CountedStage, stage, stamp

DAY = dt.date(2024, 1, 16)
RUN_DATE = dt.date(2024, 2, 15)
DOMAINS = ("www.example.com", "developer.example.com")


@query(
    "rolling_scan",
    """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-10-01' AND o_orderdate < TIMESTAMP '1998-02-13'""",
)
def rolling_scan(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return orders.filter(times.rolling_window("o_orderdate", dt.date(1998, 2, 14)))


@query(
    "member_base",
    with_("members", "campaigns", "leads", "contacts")
    + """, joined AS (
  SELECT m.row_id AS campaign_member_id, campaign_id, campaign_name, campaign_type, coalesce(lead_id, contact_id) AS lead_or_contact_id,
    lead_id, contact_id, created_ts, m.country, inquiry_date_time, region_match, focus_account AS focused_account_lead, utm_medium, utm_campaign,
    utm_source, start_date AS campaign_start_date, campaign_theater, campaign_region, campaign_format, tactic, actual_cost,
    CASE WHEN m.country = 'United States' THEN 'Americas' WHEN m.country LIKE '%Korea%' THEN 'APAC'
      WHEN t.theater IS NOT NULL THEN t.theater WHEN geo IN ('APAC', 'EMEA') THEN geo
      WHEN geo IN ('North America', 'Latin America & Caribbean') THEN 'Americas' ELSE 'Other' END AS theater,
    CASE WHEN campaign_function IN ('Digital', 'Event', 'Field', 'Partner') THEN campaign_function ELSE 'Other' END AS campaign_function,
    CASE WHEN campaign_team IN ('Corporate', 'Strategic Events') THEN 'Strategic Events'
      WHEN campaign_team IN ('Growth - Digital', 'Field Marketing', 'Partner', 'Growth - Lifecycle', 'Global Campaigns') THEN campaign_team
      ELSE 'Other' END AS campaign_team,
    CASE WHEN priority_account THEN 1 ELSE 0 END AS priority_account_lead
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY created_ts) AS rn FROM members) m JOIN campaigns c ON m.campaign_id = c.id LEFT JOIN leads l ON m.lead_id = l.id
  LEFT JOIN contacts ct ON m.contact_id = ct.id
  LEFT JOIN (SELECT n_name AS country, r_name AS theater FROM nation JOIN region ON n_regionkey = r_regionkey) t ON m.country = t.country
  WHERE rn = 1 AND coalesce(l.is_deleted, FALSE) = FALSE AND coalesce(ct.is_deleted, FALSE) = FALSE
    AND campaign_name NOT LIKE 'FCI%' AND campaign_name NOT LIKE '%Professional Active Users%'
    AND campaign_type <> 'Email Nurture' AND campaign_type <> 'Ungated Content')
SELECT * FROM joined""",
)
def member_base(spark, sf):
    # The full key of the given rows as member id: ids repeat with equal keys.
    return _member_base(spark, sf)


def _member_base(spark, sf):
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return inquiry.member_base(
        rows(spark, sf, "members").withColumn("id", F.col("row_id")).drop("row_id"),
        rows(spark, sf, "campaigns"),
        rows(spark, sf, "leads"),
        rows(spark, sf, "contacts"),
        nation.selectExpr("n_name AS country", "r_name AS theater"),
        stage=stage,
    )


@query(
    "member_buckets",
    with_("members", "campaigns", "leads", "contacts")
    + """SELECT priority_account, theater, campaign_function, campaign_team, count(*) AS n FROM (
  SELECT priority_account,
    CASE WHEN m.country = 'United States' THEN 'Americas' WHEN m.country LIKE '%Korea%' THEN 'APAC'
      WHEN m.country LIKE 'NATION%' THEN (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = m.country)
      WHEN geo IN ('APAC', 'EMEA') THEN geo
      WHEN geo = 'North America' THEN 'Americas' ELSE 'Other' END AS theater,
    CASE WHEN campaign_function IN ('Digital', 'Event', 'Field', 'Partner') THEN campaign_function ELSE 'Other' END AS campaign_function,
    CASE WHEN campaign_team IN ('Corporate', 'Strategic Events') THEN 'Strategic Events'
      WHEN campaign_team IN ('Growth - Digital', 'Field Marketing', 'Partner', 'Growth - Lifecycle', 'Global Campaigns') THEN campaign_team
      ELSE 'Other' END AS campaign_team
  FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY created_ts) AS rn FROM members) m JOIN campaigns c ON m.campaign_id = c.id LEFT JOIN leads l ON m.lead_id = l.id
  LEFT JOIN contacts ct ON m.contact_id = ct.id
  WHERE coalesce(l.is_deleted, FALSE) = FALSE AND coalesce(ct.is_deleted, FALSE) = FALSE
    AND rn = 1 AND campaign_name NOT LIKE 'FCI%' AND campaign_type <> 'Email Nurture')
GROUP BY ALL""",
)
def member_buckets(spark, sf):
    # The full key of the given rows as member id, so that hardly any row is a repeat.
    numbered = rows(spark, sf, "members").withColumn("id", F.col("row_id")).drop("row_id")
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = inquiry.member_base(
        numbered,
        rows(spark, sf, "campaigns"),
        rows(spark, sf, "leads"),
        rows(spark, sf, "contacts"),
        nation.selectExpr("n_name AS country", "r_name AS theater"),
        stage=stage,
    )
    flag = (F.col("priority_account_lead") == 1).alias("priority_account")
    return base.groupBy(flag, "theater", "campaign_function", "campaign_team").agg(F.count(F.lit(1)).alias("n"))


def _lead_map(spark, sf):
    return identity.lead_to_visitor(rows(spark, sf, "leads"), rows(spark, sf, "identifies"), DAY, "www.example.com")


LEAD_MAP = """lead_map AS (SELECT DISTINCT l.id AS lead_or_contact_id, i.anonymous_id FROM leads l JOIN identifies i ON l.email = i.email)"""
MEMBER_LINKS = """links AS (SELECT 'M' || event_id AS campaign_member_id, CASE WHEN k % 3 <> 2 THEN 'O' || k END AS opportunity_id,
    CAST(ts AS DATE) AS inquiry_created_date_utc FROM ev)"""
CHANNELS = """channels AS (SELECT * FROM (
  SELECT 'M' || (event_id - event_id % 3) AS inquiry_id, event_type AS channel, 'T' || k % 4 AS sfdc_campaign_type,
    'agg ' || k % 3 AS channel_aggregate, 'detail ' || event_id AS channel_detail,
    row_number() OVER (PARTITION BY event_id - event_id % 3 ORDER BY ts DESC, event_id) AS rn FROM ev) WHERE rn = 1)"""


def _attribution(spark, sf):
    return rows(spark, sf, "all_events").selectExpr(
        "'M' || CAST(event_id - event_id % 3 AS STRING) AS inquiry_id",
        "event_type AS channel",
        "'act' AS action",
        "'T' || CAST(k % 4 AS STRING) AS sfdc_campaign_type",
        "'agg ' || CAST(k % 3 AS STRING) AS channel_aggregate",
        "'detail ' || CAST(event_id AS STRING) AS channel_detail",
        "ts AS interaction_date",
    )


def _members(spark, sf):
    return rows(spark, sf, "all_events").selectExpr(
        "'M' || CAST(event_id AS STRING) AS id", "CASE WHEN k % 3 <> 2 THEN 'O' || CAST(k AS STRING) END AS opportunity_id", "ts AS created_ts"
    )


@query(
    "inquiries_of_day",
    with_("inquiries", then=MEMBER_LINKS)
    + """SELECT i.* EXCLUDE (k), l.opportunity_id, l.inquiry_created_date_utc FROM inquiries i JOIN links l USING (campaign_member_id)
WHERE CAST(inquiry_created_ts AS DATE) = DATE '2024-01-16'""",
)
def inquiries_of_day(spark, sf):
    return inquiry.inquiries_of_day(rows(spark, sf, "inquiries").drop("k"), _members(spark, sf), DAY)


@query(
    "latest_channel",
    with_(then=CHANNELS) + "SELECT inquiry_id, channel, sfdc_campaign_type, channel_aggregate, channel_detail FROM channels",
)
def latest_channel(spark, sf):
    return inquiry.latest_channel(_attribution(spark, sf)).drop("action")


@query(
    "lead_score",
    with_("leads")
    + """SELECT id AS lead_or_contact_id, round(lsm_score, 6) AS lead_score, first_routed_at AS lead_first_routed_at,
  CASE WHEN first_routed_at IS NOT NULL THEN 'Yes' ELSE 'No' END AS lead_routed,
  CASE WHEN first_routed_at IS NULL THEN 'Yes' ELSE 'No' END AS published_routed FROM leads""",
)
def lead_score(spark, sf):
    leads = rows(spark, sf, "leads")
    published = inquiry.lead_scores(leads, parity=True).select("lead_or_contact_id", F.col("lead_routed").alias("published_routed"))
    return inquiry.lead_scores(leads).withColumn("lead_score", r6("lead_score")).join(published, "lead_or_contact_id")


SESSION_LISTS = """session_lists AS (
  SELECT campaign_member_id, string_agg(DISTINCT anonymous_id, ',' ORDER BY anonymous_id) AS anonymous_id,
    string_agg(DISTINCT session_id, ',' ORDER BY session_id) AS session_id
  FROM (SELECT q.campaign_member_id, g.anonymous_id, g.session_id
    FROM inquiries q JOIN lead_map m ON q.lead_or_contact_id = m.lead_or_contact_id JOIN identifies g ON g.anonymous_id = m.anonymous_id
    WHERE abs(date_sub('minute', g.timestamp, q.inquiry_created_ts)) <= 1440)
  GROUP BY campaign_member_id)"""


DAY_LISTS = SESSION_LISTS.replace("<= 1440)", "<= 1440 AND CAST(g.timestamp AS DATE) = DATE '2024-01-16')")


@query(
    "inquiry_sessions",
    with_("inquiries", "leads", "identifies", then=f"{LEAD_MAP}, {SESSION_LISTS}") + "SELECT * FROM session_lists",
)
def inquiry_sessions(spark, sf):
    return inquiry.inquiry_sessions(rows(spark, sf, "inquiries"), _lead_map(spark, sf), rows(spark, sf, "identifies"))


PIPELINE = """pipeline AS (SELECT DISTINCT 'M' || event_id AS campaign_member_id,
    coalesce(CASE WHEN k % 2 = 0 THEN 'L' || user_id END, 'L' || user_id) AS lead_or_contact_id, 'O' || k AS opportunity_id, value AS pg,
    CASE WHEN value - 10 > 0 THEN 'Yes' ELSE 'No' END AS pg_attributed_inquiry FROM ev)"""


def _pipeline(spark, sf):
    return rows(spark, sf, "all_events").selectExpr(
        "'M' || CAST(event_id AS STRING) AS inquiry_id",
        "CASE WHEN k % 2 = 0 THEN 'L' || CAST(user_id AS STRING) END AS lead_id",
        "'L' || CAST(user_id AS STRING) AS contact_id",
        "'O' || CAST(k AS STRING) AS opportunity_id",
        "value AS pg_new_arr_amount_credit",
        "value - 10 AS opp_new_arr",
    )


def _lead_orgs(spark, sf):
    signups = identity.signup_users(rows(spark, sf, "users"), rows(spark, sf, "memberships"))
    leads = rows(spark, sf, "leads").select(F.col("id").alias("lead_or_contact_id"), "email")
    dated = signups.join(leads, "email").withColumn("signed_up_at", F.col("joined_at"))
    return identity.earliest_org_per_lead(dated)


LEAD_ORGS = """lead_orgs AS (SELECT DISTINCT org_id, lead_or_contact_id FROM (
  SELECT m.org_id, l.id AS lead_or_contact_id, rank() OVER (PARTITION BY l.id ORDER BY m.created_at) AS rnk
  FROM memberships m JOIN users u ON u.id = m.user_id JOIN leads l ON l.email = u.email) WHERE rnk = 1)"""


@query(
    "inquiry_fact",
    with_(
        "inquiries", "leads", "identifies", "memberships", "users", "milestones",
        then=", ".join([LEAD_MAP, MEMBER_LINKS, CHANNELS, DAY_LISTS, PIPELINE, LEAD_ORGS]),
    )
    + """SELECT i.campaign_member_id, i.lead_or_contact_id, i.inquiry_created_ts, i.campaign_type, k.opportunity_id, round(p.pg, 6) AS pg,
  c.channel, c.channel_detail, round(l.lsm_score, 6) AS lead_score, CASE WHEN l.id IS NULL THEN NULL WHEN l.first_routed_at IS NOT NULL THEN 'Yes' ELSE 'No' END AS lead_routed,
  s.anonymous_id, s.session_id, o.org_id, m.first_throughput_at AS oa_status, m.email_verified_at, m.product_active_at,
  TIMESTAMP '2024-01-16 00:00:00' AS extract_date
FROM inquiries i JOIN links k USING (campaign_member_id)
LEFT JOIN pipeline p ON p.campaign_member_id = i.campaign_member_id AND p.lead_or_contact_id = i.lead_or_contact_id AND p.opportunity_id = k.opportunity_id
LEFT JOIN channels c ON c.inquiry_id = i.campaign_member_id LEFT JOIN leads l ON l.id = i.lead_or_contact_id
LEFT JOIN session_lists s ON s.campaign_member_id = i.campaign_member_id
LEFT JOIN lead_orgs o ON o.lead_or_contact_id = i.lead_or_contact_id LEFT JOIN milestones m ON m.org_id = o.org_id
WHERE CAST(i.inquiry_created_ts AS DATE) = DATE '2024-01-16'""",
)
def inquiry_fact(spark, sf):
    fact = inquiry.inquiry_fact(
        rows(spark, sf, "inquiries"),
        _members(spark, sf),
        _attribution(spark, sf),
        rows(spark, sf, "leads"),
        _pipeline(spark, sf),
        _lead_map(spark, sf),
        rows(spark, sf, "identifies"),
        _lead_orgs(spark, sf),
        rows(spark, sf, "milestones"),
        DAY,
    )
    return fact.select(
        "campaign_member_id",
        "lead_or_contact_id",
        "inquiry_created_ts",
        "campaign_type",
        "opportunity_id",
        r6("pg").alias("pg"),
        "channel",
        "channel_detail",
        r6("lead_score").alias("lead_score"),
        "lead_routed",
        "anonymous_id",
        "session_id",
        "org_id",
        "oa_status",
        "email_verified_at",
        "product_active_at",
        "extract_date",
    )


@query(
    "pipeline_credit",
    with_("inquiries", then=f"{MEMBER_LINKS}, {PIPELINE}")
    + """SELECT i.campaign_member_id, i.lead_or_contact_id, l.opportunity_id, round(p.pg, 6) AS pg, p.pg_attributed_inquiry
FROM inquiries i JOIN links l USING (campaign_member_id)
LEFT JOIN pipeline p ON p.campaign_member_id = i.campaign_member_id AND p.lead_or_contact_id = i.lead_or_contact_id
  AND p.opportunity_id = l.opportunity_id""",
)
def pipeline_credit(spark, sf):
    links = _members(spark, sf).select(F.col("id").alias("campaign_member_id"), "opportunity_id")
    asked = rows(spark, sf, "inquiries").select("campaign_member_id", "lead_or_contact_id").join(links, "campaign_member_id")
    return inquiry.with_pipeline(asked, _pipeline(spark, sf)).withColumn("pg", r6("pg"))


# Visits of the dashboard: visitors are lead-mapped per domain.
VISITOR_LEADS = """vleads AS (SELECT DISTINCT user_id AS visitor_id, 'L' || (user_id + k % 2) AS lead_or_contact_id,
    CASE WHEN k % 2 = 0 THEN 'www.example.com' ELSE 'developer.example.com' END AS domain FROM ev
  WHERE event_type = 'click')"""
VISITS = f"""{VISITOR_LEADS}, visits AS (
  SELECT p.page_visit_id, p.visitor_id, p.session_id, p.visit_start_time, p.domain, p.url, v.lead_or_contact_id
  FROM page_views p LEFT JOIN vleads v ON v.visitor_id = p.visitor_id AND v.domain = p.domain
  WHERE p.visit_start_time >= TIMESTAMP '2023-10-01' AND p.visit_start_time < TIMESTAMP '2024-02-14'
    AND p.domain IN ('www.example.com', 'developer.example.com'))"""
STAGED = f"""{VISITS}, near AS (
  SELECT v.*, f.campaign_member_id, f.inquiry_date_time, f.campaign_type, f.mql_date_time, f.sqm_date_time, f.sao_date_time,
    date_sub('day', v.visit_start_time, f.inquiry_date_time) AS delta_inqcreation_visit,
    date_sub('day', f.inquiry_date_time, f.mql_date_time) AS delta_mql_inq,
    date_sub('day', f.inquiry_date_time, f.sqm_date_time) AS delta_sqm_inq,
    date_sub('day', f.inquiry_date_time, f.sao_date_time) AS delta_sao_inq
  FROM visits v LEFT JOIN funnel f ON f.lead_or_contact_id = v.lead_or_contact_id
    AND date_sub('day', v.visit_start_time, f.inquiry_date_time) BETWEEN -7 AND 7),
staged AS (SELECT *,
    CASE WHEN delta_inqcreation_visit BETWEEN 0 AND 1 THEN 1 ELSE 0 END AS flg_1d_inq,
    CASE WHEN delta_inqcreation_visit BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS flg_7d_inq,
    CASE WHEN delta_inqcreation_visit BETWEEN 0 AND 1 AND delta_mql_inq <= 7 THEN 1 ELSE 0 END AS flg_7d_mql,
    CASE WHEN delta_inqcreation_visit BETWEEN 0 AND 1 AND delta_mql_inq <= 7 AND delta_sqm_inq <= 14 THEN 1 ELSE 0 END AS flg_14d_sqm,
    CASE WHEN delta_inqcreation_visit BETWEEN 0 AND 1 AND delta_mql_inq <= 7 AND delta_sqm_inq <= 14 AND delta_sao_inq <= 60
      THEN 1 ELSE 0 END AS num_60d_sqm FROM near),
typed AS (SELECT v.*, t.campaign_member_id, t.inquiry_date_time, t.campaign_type,
    CASE WHEN t.campaign_type = 'Cloud Sign-Up' THEN 1 ELSE 0 END AS flg_cloud_signup,
    CASE WHEN t.campaign_type = 'Platform Download' THEN 1 ELSE 0 END AS flg_cp_download
  FROM visits v JOIN typed_inquiries t ON t.lead_or_contact_id = v.lead_or_contact_id
    AND date_sub('day', v.visit_start_time, t.inquiry_date_time) BETWEEN -7 AND 7)"""


def _visitor_leads(spark, sf):
    # A click names a lead on one domain; on the other, and without clicks, a visitor has none.
    clicks = rows(spark, sf, "all_events").filter("event_type = 'click'")
    return clicks.selectExpr(
        "user_id AS anonymous_id",
        "'L' || CAST(user_id + k % 2 AS STRING) AS lead_or_contact_id",
        "CASE WHEN k % 2 = 0 THEN 'www.example.com' ELSE 'developer.example.com' END AS source",
    )


def _pages(spark, sf):
    return rows(spark, sf, "page_views").select("page_visit_id", "visitor_id", "session_id", "visit_start_time", "domain", "url")


def _dashboard(spark, sf):
    return dashboard.web_dashboard(
        _pages(spark, sf), _visitor_leads(spark, sf), rows(spark, sf, "funnel"), rows(spark, sf, "typed_inquiries"), RUN_DATE, domains=DOMAINS, stage=stage
    )


@query(
    "pages_with_leads",
    with_("page_views", then=VISITS) + "SELECT *, CAST(date_trunc('month', visit_start_time) AS DATE) AS visit_month FROM visits",
)
def pages_with_leads(spark, sf):
    scanned = _pages(spark, sf).filter(times.rolling_window("visit_start_time", RUN_DATE) & F.col("domain").isin(*DOMAINS))
    return dashboard.pages_with_leads(scanned, _visitor_leads(spark, sf))


@query(
    "funnel_flags",
    with_("page_views", "funnel", "typed_inquiries", then=STAGED)
    + """SELECT page_visit_id, lead_or_contact_id, campaign_member_id, delta_inqcreation_visit, delta_mql_inq, delta_sqm_inq, delta_sao_inq,
  flg_1d_inq, flg_7d_inq, flg_7d_mql, flg_14d_sqm, num_60d_sqm FROM staged""",
)
def funnel_flags(spark, sf):
    visits = pages_with_leads(spark, sf)
    out = dashboard.funnel_flags(dashboard.visit_inquiries(visits, rows(spark, sf, "funnel")))
    return out.select(
        "page_visit_id",
        "lead_or_contact_id",
        "campaign_member_id",
        "delta_inqcreation_visit",
        "delta_mql_inq",
        "delta_sqm_inq",
        "delta_sao_inq",
        "flg_1d_inq",
        "flg_7d_inq",
        "flg_7d_mql",
        "flg_14d_sqm",
        "num_60d_sqm",
    )


@query(
    "inquiry_type_flags",
    with_("page_views", "funnel", "typed_inquiries", then=STAGED)
    + "SELECT page_visit_id, lead_or_contact_id, campaign_member_id, campaign_type, flg_cloud_signup, flg_cp_download FROM typed",
)
def inquiry_type_flags(spark, sf):
    out = dashboard.inquiry_type_flags(pages_with_leads(spark, sf), rows(spark, sf, "typed_inquiries"))
    return out.select(
        "page_visit_id", "lead_or_contact_id", "campaign_member_id", "campaign_type", "flg_cloud_signup", "flg_cp_download"
    )


MERGED = """, s AS (SELECT * REPLACE (coalesce(session_id, 'Null ') AS session_id, coalesce(lead_or_contact_id, 'Null') AS lead_or_contact_id) FROM staged),
t AS (SELECT * REPLACE (coalesce(session_id, 'Null ') AS session_id) FROM typed),
merged AS (
  SELECT DISTINCT coalesce(s.domain, t.domain) AS domain, coalesce(s.session_id, t.session_id) AS session_id,
    coalesce(s.visit_start_time, t.visit_start_time) AS visit_start_time, coalesce(s.page_visit_id, t.page_visit_id) AS page_visit_id,
    coalesce(s.lead_or_contact_id, t.lead_or_contact_id) AS lead_or_contact_id,
    coalesce(s.campaign_member_id, t.campaign_member_id) AS campaign_member_id,
    coalesce(s.campaign_type, t.campaign_type) AS campaign_type,
    s.flg_1d_inq, s.flg_7d_mql, s.num_60d_sqm, t.flg_cloud_signup, t.flg_cp_download
  FROM s FULL JOIN t ON s.domain = t.domain AND s.session_id = t.session_id AND s.visit_start_time = t.visit_start_time
    AND s.page_visit_id = t.page_visit_id AND s.lead_or_contact_id = t.lead_or_contact_id AND s.campaign_member_id = t.campaign_member_id)
"""
MERGED_COLUMNS = [
    "domain",
    "session_id",
    "visit_start_time",
    "page_visit_id",
    "lead_or_contact_id",
    "campaign_member_id",
    "campaign_type",
    "flg_1d_inq",
    "flg_7d_mql",
    "num_60d_sqm",
    "flg_cloud_signup",
    "flg_cp_download",
]


@query(
    "dashboard_merge",
    with_("page_views", "funnel", "typed_inquiries", then=STAGED)
    + MERGED
    + """SELECT *, CAST(date_trunc('week', CAST(visit_start_time AS DATE) + 1) AS DATE) - 1 AS visit_week,
  CAST(date_trunc('month', visit_start_time) AS DATE) AS visit_month, last_day(visit_start_time) AS visit_month_end FROM merged""",
)
def dashboard_merge(spark, sf):
    return _dashboard(spark, sf).select(*MERGED_COLUMNS, "visit_week", "visit_month", "visit_month_end")


@query(
    "dashboard_milestones",
    with_("page_views", "funnel", "typed_inquiries", "memberships", "users", "leads", "milestones", then=STAGED)
    + MERGED
    + f""", {LEAD_ORGS}
SELECT r.page_visit_id, r.lead_or_contact_id, r.campaign_member_id, o.org_id, m.email_verified_at, m.cluster_created_at,
  CASE WHEN CAST(m.email_verified_at AS DATE) - 7 <= CAST(m.signed_up_at AS DATE) THEN 1 ELSE 0 END AS email_verified_7d,
  CASE WHEN CAST(m.usage_at AS DATE) - 7 <= CAST(m.signed_up_at AS DATE) THEN m.usage_at END AS onboarding_activated_7d,
  m.product_active_at AS stg1_pao, m.stage2_active_at AS stg2_pao
FROM merged r LEFT JOIN lead_orgs o ON o.lead_or_contact_id = r.lead_or_contact_id LEFT JOIN milestones m ON m.org_id = o.org_id""",
)
def dashboard_milestones(spark, sf):
    out = dashboard.dashboard_milestones(stage(_dashboard(spark, sf), "report"), _lead_orgs(spark, sf), rows(spark, sf, "milestones"))
    return out.select(
        "page_visit_id",
        "lead_or_contact_id",
        "campaign_member_id",
        "org_id",
        "email_verified_at",
        "cluster_created_at",
        "email_verified_7d",
        "onboarding_activated_7d",
        "stg1_pao",
        "stg2_pao",
    )


# The same report from the whole build: page logs, e-mail lead map, inquiries.
BUILD = STAGED.replace(
    VISITS,
    f"""pv2 AS (SELECT * REPLACE (CASE WHEN domain <> 'docs.example.com' THEN session_id END AS session_id) FROM page_views),
vleads AS (SELECT DISTINCT CAST(substr(anonymous_id, 2) AS BIGINT) AS visitor_id, lead_or_contact_id, 'www.example.com' AS domain FROM lead_map),
visits AS (SELECT p.page_visit_id, p.visitor_id, p.session_id, p.visit_start_time, p.domain, p.url, v.lead_or_contact_id
  FROM pv2 p LEFT JOIN vleads v ON v.visitor_id = p.visitor_id AND v.domain = p.domain
  WHERE p.visit_start_time >= TIMESTAMP '2023-10-01' AND p.visit_start_time < TIMESTAMP '2024-02-14'
    AND p.domain IN ('www.example.com', 'docs.example.com'))""",
)


def _build(spark, sf, kept):
    # Visitors are numbers in the page logs, so the identifies name them the same way.
    identifies = rows(spark, sf, "identifies").withColumn("anonymous_id", F.expr("CAST(substr(anonymous_id, 2) AS BIGINT)"))
    return build_web(
        page_logs(spark, sf),
        rows(spark, sf, "leads"),
        identifies,
        rows(spark, sf, "funnel"),
        rows(spark, sf, "typed_inquiries"),
        RUN_DATE,
        domains=("www.example.com", "docs.example.com"),
        lead_source="www.example.com",
        stage=kept,
    )


BUILD_TABLES = ("page_views", "leads", "identifies", "funnel", "typed_inquiries")


@query("web_build", with_(*BUILD_TABLES, then=f"{LEAD_MAP}, {BUILD}") + MERGED + "SELECT * FROM merged")
def web_build(spark, sf):
    return _build(spark, sf, stage)["rpt_web_dashboard"].select(*MERGED_COLUMNS)


@query(
    "web_build_counts",
    with_(*BUILD_TABLES, then=f"{LEAD_MAP}, {BUILD}")
    + """SELECT 'dim_visitor' AS stage, count(*) AS n_rows FROM (SELECT DISTINCT visitor_id FROM pv2)
UNION ALL SELECT 'page_log', count(*) FROM pv2 UNION ALL SELECT 'fct_page_visit', count(*) FROM pv2
UNION ALL SELECT 'lookup_lead_visitor', count(*) FROM lead_map UNION ALL SELECT 'visits', count(*) FROM visits""",
)
def web_build_counts(spark, sf):
    counted = CountedStage()
    _build(spark, sf, counted)
    return counted.counts(spark)


@query(
    "visit_flag_counts",
    with_("page_views", "funnel", "typed_inquiries", then=STAGED)
    + """SELECT page_visit_id, visitor_id, session_id, visit_start_time, domain, url, lead_or_contact_id,
  CAST(date_trunc('month', visit_start_time) AS DATE) AS visit_month, sum(flg_1d_inq)::BIGINT AS n_1d_inq, sum(flg_7d_inq)::BIGINT AS n_7d_inq,
  sum(flg_7d_mql)::BIGINT AS n_7d_mql, sum(flg_14d_sqm)::BIGINT AS n_14d_sqm, sum(num_60d_sqm)::BIGINT AS n_60d_sao FROM staged GROUP BY ALL""",
)
def visit_flag_counts(spark, sf):
    visits = stage(pages_with_leads(spark, sf), "visits")
    return dashboard.visit_flag_counts(visits, rows(spark, sf, "funnel"))


HOSTS = {"www.example.com": "site", "docs.example.com": "docs", "developer.example.com": "developer"}


@query(
    "monthly_kpis",
    with_("page_views", "inquiries", "memberships", "users", "leads", "contacts", then=f"{SIGNUPS}, {PEOPLE}")
    + """, firsts AS (SELECT DISTINCT m.org_id, 'L' || m.org_id AS lead_or_contact_id, m.created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY created_at, user_id) AS rn FROM memberships) m WHERE rn = 1),
clients AS (SELECT DISTINCT 'g' || o_custkey AS ga_client_id, 'L' || o_custkey AS lead_or_contact_id FROM orders),
sessions AS (SELECT 'g' || visitor_id AS ga_client_id, visitor_id, visit_start_time, domain AS hostname,
    CASE WHEN length(page_visit_id) % 2 = 0 THEN 'New' ELSE 'Returning' END AS is_new_visitor, length(url) AS num_pageviews FROM page_views),
joined AS (SELECT s.*, i.campaign_type, i.lead_or_contact_id AS asked, f.lead_or_contact_id AS signed
  FROM sessions s LEFT JOIN clients c ON c.ga_client_id = s.ga_client_id
  LEFT JOIN inquiries i ON i.lead_or_contact_id = c.lead_or_contact_id AND i.inquiry_created_ts >= s.visit_start_time
    AND i.inquiry_created_ts <= s.visit_start_time + INTERVAL 24 HOUR
  LEFT JOIN firsts f ON f.lead_or_contact_id = c.lead_or_contact_id AND f.created_at >= s.visit_start_time
    AND f.created_at <= s.visit_start_time + INTERVAL 24 HOUR
  LEFT JOIN leads l ON l.id = c.lead_or_contact_id
  WHERE s.visit_start_time >= TIMESTAMP '2024-01-03' AND (l.email IS NULL OR l.email NOT LIKE '%9@mail%'))
SELECT CAST(date_trunc('month', visit_start_time) AS DATE) AS visit_month,
  CASE hostname WHEN 'www.example.com' THEN 'site' WHEN 'docs.example.com' THEN 'docs' ELSE 'developer' END AS domain,
  count(DISTINCT ga_client_id) AS num_uv,
  round(sum(CASE WHEN is_new_visitor = 'New' THEN 1 ELSE 0 END) / count(DISTINCT ga_client_id), 6) AS percent_new_visitor,
  round(sum(num_pageviews) / count(DISTINCT ga_client_id), 6) AS avg_pageview,
  count(DISTINCT CASE WHEN campaign_type <> 'Cloud Sign-Up' THEN asked END) AS num_converted_leads,
  round(count(DISTINCT CASE WHEN campaign_type <> 'Cloud Sign-Up' THEN asked END) / count(DISTINCT ga_client_id), 6) AS web_to_lead_cvr,
  count(DISTINCT CASE WHEN campaign_type IN ('Platform Download', 'Community Download') THEN ga_client_id END) AS cp_cc_inquiry,
  round(count(DISTINCT CASE WHEN campaign_type IN ('Platform Download', 'Community Download') THEN ga_client_id END)
    / count(DISTINCT ga_client_id), 6) AS cp_cvr,
  count(DISTINCT signed) AS signup, round(count(DISTINCT signed) / count(DISTINCT ga_client_id), 6) AS signup_cvr
FROM joined GROUP BY 1, 2""",
)
def monthly_kpis(spark, sf):
    pages = rows(spark, sf, "page_views")
    sessions = pages.selectExpr(
        "'g' || CAST(visitor_id AS STRING) AS ga_client_id",
        "visit_start_time",
        "domain AS hostname",
        "CASE WHEN length(page_visit_id) % 2 = 0 THEN 'New' ELSE 'Returning' END AS is_new_visitor",
        "length(url) AS num_pageviews",
    )
    customers = table(spark, sf, "orders").select("o_custkey").distinct()
    clients = customers.selectExpr(
        "'g' || CAST(o_custkey AS STRING) AS ga_client_id", "'L' || CAST(o_custkey AS STRING) AS lead_or_contact_id"
    )
    asked = rows(spark, sf, "inquiries").selectExpr(
        "lead_or_contact_id", "campaign_type AS tactic", "campaign_type", "inquiry_created_ts AS created_ts"
    )
    firsts = identity.first_user_per_org(
        rows(spark, sf, "memberships").selectExpr("user_id AS id", "CAST(NULL AS STRING) AS email", "created_at").dropDuplicates(["id"]),
        rows(spark, sf, "memberships"),
    ).selectExpr("'L' || CAST(org_id AS STRING) AS lead_or_contact_id", "joined_at AS created_at")
    out = dashboard.monthly_kpis(
        sessions, clients, asked, firsts, rows(spark, sf, "leads"), HOSTS, "%9@mail%", since=dt.date(2024, 1, 3), stage=stage
    )
    rates = [c for c, t in out.dtypes if t == "double"]
    return out.withColumns({c: r6(c) for c in rates})


@query("run_date_stamp", "SELECT o_orderkey, TIMESTAMP '2024-01-16 00:00:00' AS extract_date FROM orders")
def run_date_stamp(spark, sf):
    return stamp(table(spark, sf, "orders").select("o_orderkey"), DAY)
