"""Campaign attribution and paid media on the lineitem, part, customer and event tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators import distinct_roll_up, quality
from waymark.plans import campaign, paid_media, rulesets
from waymark.queries.registry import query, r6, rules_sql
from waymark.queries.standins import rows, table, with_
from waymark.sources.sinks import stage

PARENT = 7
SINCE = dt.date(2024, 1, 3)

EXCLUDED = f"excluded AS (SELECT DISTINCT id FROM campaigns WHERE parent_id = {PARENT} AND id <> {PARENT})"
BRIDGE = "bridge AS (SELECT DISTINCT 'L' || o_custkey AS lead_id FROM orders WHERE o_orderstatus = 'F')"
ATTRIBUTED = f"""{EXCLUDED}, {BRIDGE}, attributed AS (
  SELECT m.id FROM members m JOIN campaigns c ON c.id = m.campaign_id JOIN leads l ON l.converted_contact_id = m.contact_id
    JOIN bridge b ON b.lead_id = l.id WHERE m.lead_id IS NULL AND c.id NOT IN (SELECT id FROM excluded)
  UNION SELECT m.id FROM members m JOIN campaigns c ON c.id = m.campaign_id JOIN bridge b ON b.lead_id = m.lead_id
  WHERE c.id NOT IN (SELECT id FROM excluded))"""


def _excluded(spark, sf):
    return campaign.child_campaigns(rows(spark, sf, "campaigns"), PARENT)


def _bridge(spark, sf):
    filled = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return filled.selectExpr("'L' || CAST(o_custkey AS STRING) AS lead_id").distinct()


def _attributed(spark, sf):
    return campaign.attributed_members(
        rows(spark, sf, "members"), rows(spark, sf, "campaigns"), rows(spark, sf, "leads"), _bridge(spark, sf), _excluded(spark, sf)
    )


@query("excluded_campaigns", with_("campaigns", then=EXCLUDED) + "SELECT id FROM excluded")
def excluded_campaigns(spark, sf):
    return _excluded(spark, sf)


@query("attributed_members", with_("members", "campaigns", "leads", then=ATTRIBUTED) + "SELECT DISTINCT id FROM attributed")
def attributed_members(spark, sf):
    return _attributed(spark, sf)


LEAD_TOUCHES = """lead_touches AS (SELECT p.p_partkey AS campaign_id, 'Q' || o_orderkey AS inquiry_id,
    CASE o_custkey % 4 WHEN 0 THEN 'tm.lifecycle.b' WHEN 1 THEN 'ch.gmail.q' WHEN 2 THEN 'x.tm.devx.y' END AS utm_campaign,
    CASE o_custkey % 5 WHEN 0 THEN 'ppc' WHEN 1 THEN 'nurtureemail' WHEN 2 THEN 'display' WHEN 3 THEN 'gmail' END AS utm_medium,
    CASE o_custkey % 3 WHEN 0 THEN 'azure' WHEN 1 THEN 'bing' END AS utm_source,
    c.campaign_name, c.campaign_team, o_orderdate AS interaction_time, CAST(o_orderdate AS DATE) AS interaction_date,
    'L' || o_custkey AS lead_id, CASE WHEN o_orderstatus = 'F' THEN 'O' || o_orderkey END AS opportunity_id, o_orderpriority AS action,
    c.campaign_type AS sfdc_campaign_type, 1 AS lead, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS opp, c.campaign_theater,
    c.campaign_function AS sfdc_campaign_function, CAST(DATE '2023-12-01' + CAST(o_custkey % 60 AS INT) AS TIMESTAMP) AS lead_created_date,
    CASE WHEN o_custkey % 4 <> 3 THEN 'A' || o_custkey % 4 END AS account_id
  FROM orders JOIN part p ON p.p_partkey = o_custkey JOIN campaigns c ON c.id = p.p_partkey)"""
ROLES = "roles AS (SELECT DISTINCT 'C' || s_suppkey AS contact_id, 'OS' || s_nationkey AS opportunity_id FROM supplier)"
TOUCHES = f"""{ATTRIBUTED}, {LEAD_TOUCHES}, {ROLES}, touches AS (
  SELECT t.campaign_id, t.inquiry_id, utm_campaign, utm_medium, utm_source, campaign_name, campaign_team, interaction_time, interaction_date,
    t.lead_id AS lead_or_contact_id, r.opportunity_id, action, sfdc_campaign_type, lead,
    CASE WHEN r.opportunity_id IS NOT NULL THEN 1 ELSE 0 END AS opp, 'lead' AS origin, campaign_theater, sfdc_campaign_function, lead_created_date,
    account_id
  FROM lead_touches t LEFT JOIN leads l ON l.id = t.lead_id LEFT JOIN roles r ON r.contact_id = l.converted_contact_id WHERE t.opportunity_id IS NULL
  UNION ALL
  SELECT campaign_id, inquiry_id, utm_campaign, utm_medium, utm_source, campaign_name, campaign_team, interaction_time, interaction_date,
    lead_id, opportunity_id, action, sfdc_campaign_type, lead, opp, 'lead', campaign_theater, sfdc_campaign_function, lead_created_date, account_id
  FROM lead_touches WHERE opportunity_id IS NOT NULL
  UNION ALL
  SELECT DISTINCT campaign_id, m.id, utm_campaign, utm_medium, utm_source, campaign_name, campaign_team, t, CAST(t AS DATE),
    m.contact_id, r.opportunity_id, status, campaign_type, 0, 1, 'contact', campaign_theater, campaign_function, ct.created_at, o.account_id
  FROM (SELECT m.*, campaign_name, campaign_team, campaign_type, campaign_theater, campaign_function, date_trunc('minute',
      CASE WHEN abs(CAST(created_ts AS DATE) - CAST(associated_ts AS DATE)) > 1 OR campaign_type = 'PG Prospecting Days'
        THEN associated_ts ELSE created_ts END) AS t FROM members m JOIN campaigns c ON c.id = m.campaign_id) m
  JOIN roles r ON r.contact_id = m.contact_id JOIN opportunities o ON o.id = r.opportunity_id LEFT JOIN contacts ct ON ct.id = m.contact_id
  WHERE m.id NOT IN (SELECT id FROM attributed) AND campaign_id NOT IN (SELECT id FROM excluded))"""


def _roles(spark, sf):
    held = table(spark, sf, "supplier")
    return held.selectExpr("'C' || CAST(s_suppkey AS STRING) AS contact_id", "'OS' || CAST(s_nationkey AS STRING) AS opportunity_id").distinct()


def _lead_touches(spark, sf):
    described = rows(spark, sf, "campaigns").select(F.col("id").alias("campaign_id"), "campaign_name", "campaign_team", "campaign_type", "campaign_theater", "campaign_function")
    orders = table(spark, sf, "orders").withColumn("campaign_id", F.col("o_custkey"))
    return orders.join(described, "campaign_id").selectExpr(
        "campaign_id",
        "'Q' || CAST(o_orderkey AS STRING) AS inquiry_id",
        "CASE o_custkey % 4 WHEN 0 THEN 'tm.lifecycle.b' WHEN 1 THEN 'ch.gmail.q' WHEN 2 THEN 'x.tm.devx.y' END AS utm_campaign",
        "CASE o_custkey % 5 WHEN 0 THEN 'ppc' WHEN 1 THEN 'nurtureemail' WHEN 2 THEN 'display' WHEN 3 THEN 'gmail' END AS utm_medium",
        "CASE o_custkey % 3 WHEN 0 THEN 'azure' WHEN 1 THEN 'bing' END AS utm_source",
        "campaign_name",
        "campaign_team",
        "o_orderdate AS interaction_time",
        "CAST(o_orderdate AS DATE) AS interaction_date",
        "'L' || CAST(o_custkey AS STRING) AS lead_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'O' || CAST(o_orderkey AS STRING) END AS opportunity_id",
        "o_orderpriority AS action",
        "campaign_type AS sfdc_campaign_type",
        "1 AS lead",
        "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS opp",
        "campaign_theater",
        "campaign_function AS sfdc_campaign_function",
        "CAST(DATE '2023-12-01' + CAST(o_custkey % 60 AS INT) AS TIMESTAMP) AS lead_created_date",
        "CASE WHEN o_custkey % 4 <> 3 THEN 'A' || CAST(o_custkey % 4 AS STRING) END AS account_id",
    )


def _touches(spark, sf):
    return campaign.touch_set(
        _lead_touches(spark, sf),
        rows(spark, sf, "leads"),
        _roles(spark, sf),
        rows(spark, sf, "members").drop("row_id"),
        rows(spark, sf, "campaigns"),
        _attributed(spark, sf),
        _excluded(spark, sf),
        rows(spark, sf, "opportunities"),
        rows(spark, sf, "contacts"),
    )


@query("campaign_touchset", with_("members", "campaigns", "leads", "contacts", "opportunities", then=TOUCHES) + "SELECT * FROM touches")
def campaign_touchset(spark, sf):
    return _touches(spark, sf)


CAMPAIGN_FIELDS = {
    f: f for f in ("sfdc_campaign_type", "utm_medium", "utm_campaign", "campaign", "campaign_team", "campaign_type", "campaign_type_lower", "campaign_format")
}
UNATTRIBUTED = ", ".join(f"'{t}'" for t in rulesets.TYPES_NOT_ATTRIBUTED)
BUCKETED = f"""{TOUCHES}, described AS (
  SELECT t.*, c.campaign_type, lower(c.campaign_type) AS campaign_type_lower, c.campaign_format, c.tactic, lower(t.utm_campaign) AS campaign
  FROM touches t LEFT JOIN campaigns c ON c.id = t.campaign_id
  WHERE t.sfdc_campaign_type NOT IN ({UNATTRIBUTED}) AND t.campaign_name NOT LIKE 'FCI%' AND t.campaign_id NOT IN (SELECT id FROM excluded)),
bucketed AS (SELECT * EXCLUDE (campaign, campaign_type_lower, campaign_format, campaign_type),
    {rules_sql(rulesets.campaign_channel_rules(), "Organic", CAMPAIGN_FIELDS)} AS channel,
    {rules_sql(rulesets.marketing_group_rules(), "Other Marketing Sourced", CAMPAIGN_FIELDS)} AS marketing_group,
    {rules_sql(rulesets.web_type_rules(), "Other", CAMPAIGN_FIELDS)} AS web_type,
    CASE WHEN campaign_name IN ('small ring', 'blue bolt') THEN 1 ELSE 0 END AS has_devx_content,
    CASE WHEN campaign_name IN ('small ring', 'blue bolt') THEN campaign_name END AS web_content
  FROM described)"""
VOCABULARY = rulesets.Vocabulary(devx_campaign_names=("small ring", "blue bolt"))


def _bucketed(spark, sf):
    return campaign.bucket_touches(_touches(spark, sf), rows(spark, sf, "campaigns"), _excluded(spark, sf), VOCABULARY)


@query("campaign_buckets", with_("members", "campaigns", "leads", "contacts", "opportunities", then=BUCKETED) + "SELECT * FROM bucketed")
def campaign_buckets(spark, sf):
    return _bucketed(spark, sf)


TOUCHPOINTS = """touchpoints AS (SELECT o_orderdate + INTERVAL 20 HOUR - INTERVAL 1 DAY * (o_orderkey % 2) AS visit_time, 'L' || o_custkey AS lead_id,
    CASE o_orderkey % 6 WHEN 0 THEN 'type.community' WHEN 1 THEN 'tm.campaigns.w' ELSE 'w' || o_orderkey % 6 END AS campaign_name,
    CASE WHEN o_orderkey % 4 <> 3 THEN 'src' || o_orderkey % 4 END AS source,
    CASE o_orderkey % 2 WHEN 0 THEN 'Paid Media' ELSE 'Global Campaigns' END AS marketing_group,
    CASE o_orderkey % 5 WHEN 0 THEN 'gmail' WHEN 1 THEN 'Search Engine Marketing' WHEN 2 THEN 'Email' WHEN 3 THEN 'Other' ELSE 'Partner referral' END AS channel,
    CASE o_orderkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'referral' END AS medium, 'tactic ' || o_orderkey % 3 AS tactic,
    CAST(o_orderkey % 2 AS INT) AS has_devx_content, CASE WHEN o_orderkey % 7 = 6 THEN 'Training' ELSE 'digital touch' END AS sfdc_campaign_type FROM orders),
visits AS (SELECT * EXCLUDE (channel, sfdc_campaign_type), CASE WHEN channel = 'gmail' AND marketing_group = 'Paid Media' THEN 'Paid Email'
    WHEN channel = 'Search Engine Marketing' THEN 'Paid Search' ELSE channel END AS channel
  FROM touchpoints WHERE sfdc_campaign_type IN ('Email', 'digital touch') OR channel = 'Email')"""


def _touchpoints(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderdate + INTERVAL 20 HOURS - make_dt_interval(CAST(o_orderkey % 2 AS INT)) AS visit_time",
        "'L' || CAST(o_custkey AS STRING) AS lead_id",
        "CASE o_orderkey % 6 WHEN 0 THEN 'type.community' WHEN 1 THEN 'tm.campaigns.w' ELSE 'w' || CAST(o_orderkey % 6 AS STRING) END AS campaign_name",
        "CASE WHEN o_orderkey % 4 <> 3 THEN 'src' || CAST(o_orderkey % 4 AS STRING) END AS source",
        "CASE o_orderkey % 2 WHEN 0 THEN 'Paid Media' ELSE 'Global Campaigns' END AS marketing_group",
        "CASE o_orderkey % 5 WHEN 0 THEN 'gmail' WHEN 1 THEN 'Search Engine Marketing' WHEN 2 THEN 'Email' WHEN 3 THEN 'Other'"
        " ELSE 'Partner referral' END AS channel",
        "CASE o_orderkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'referral' END AS medium",
        "'tactic ' || CAST(o_orderkey % 3 AS STRING) AS tactic",
        "CAST(o_orderkey % 2 AS INT) AS has_devx_content",
        "CASE WHEN o_orderkey % 7 = 6 THEN 'Training' ELSE 'digital touch' END AS sfdc_campaign_type",
    )


# The latest visit strictly before a touch; equal times are settled by the visit's own fields.
MATCHED = f"""{BUCKETED}, {TOUCHPOINTS}, keys AS (SELECT DISTINCT lead_or_contact_id, interaction_time FROM bucketed),
found AS (SELECT * FROM (SELECT k.lead_or_contact_id AS who, k.interaction_time AS at, v.*, date_sub('minute', v.visit_time, k.interaction_time) AS min_diff,
    row_number() OVER (PARTITION BY k.lead_or_contact_id, k.interaction_time ORDER BY v.visit_time DESC, v.campaign_name DESC, v.source DESC NULLS LAST,
      v.marketing_group DESC, v.channel DESC, v.medium DESC NULLS LAST, v.tactic DESC, v.has_devx_content DESC) AS rn
  FROM keys k JOIN visits v ON v.lead_id = k.lead_or_contact_id AND v.visit_time < k.interaction_time) WHERE rn = 1 AND min_diff <= 360),
matched AS (SELECT b.*, f.campaign_name AS web_channel_campaign, f.source AS web_channel_source, f.marketing_group AS web_channel_marketing_group,
    f.channel AS web_channel, f.medium AS web_channel_medium, f.tactic AS web_channel_tactic, f.has_devx_content AS web_channel_devx, f.min_diff
  FROM bucketed b LEFT JOIN found f ON f.who = b.lead_or_contact_id AND f.at = b.interaction_time),
filled AS (SELECT * EXCLUDE (channel), CASE WHEN channel <> 'Organic' THEN channel WHEN web_channel = 'Other' THEN web_channel_tactic
    ELSE coalesce(web_channel, 'Organic') END AS channel,
    CASE WHEN campaign_name LIKE '%enterprise-tal%' OR marketing_group = 'Global Campaigns' THEN 1 ELSE 0 END AS is_global_campaign FROM matched)"""


def _filled(spark, sf):
    visits = campaign.web_visits(_touchpoints(spark, sf))
    bucketed = stage(_bucketed(spark, sf), "bucketed")
    return campaign.backfill_organic(campaign.match_web_visit(bucketed, visits))


FILLED_COLUMNS = [
    "inquiry_id",
    "lead_or_contact_id",
    "interaction_time",
    "opportunity_id",
    "channel",
    "is_global_campaign",
    "web_channel_campaign",
    "web_channel_source",
    "web_channel",
    "web_channel_tactic",
    "min_diff",
]


@query("organic_backfill", with_("members", "campaigns", "leads", "contacts", "opportunities", then=MATCHED) + f"SELECT {', '.join(FILLED_COLUMNS)} FROM filled")
def organic_backfill(spark, sf):
    return _filled(spark, sf).select(*FILLED_COLUMNS)


TACTIC_FIELDS = {f: f for f in campaign.TACTIC_FIELDS}
FINAL = f"""{MATCHED}, early AS (SELECT * EXCLUDE (channel), lower(utm_campaign) AS campaign,
    CASE WHEN interaction_date < DATE '2020-04-01' THEN 'yes' ELSE 'no' END AS in_person_workshop FROM filled),
final AS (SELECT *, {rules_sql(rulesets.tactic_group_rules(), rulesets.TACTIC_GROUP_DEFAULT, TACTIC_FIELDS | {"campaign_team": "campaign_team"})} AS tactic_grouping,
    {rules_sql(rulesets.tactic_team_rules(), rulesets.TACTIC_TEAM_DEFAULT, TACTIC_FIELDS | {"campaign_team": "campaign_team"})} AS tactic_team,
    {rules_sql(rulesets.tactic_channel_rules(), rulesets.TACTIC_CHANNEL_DEFAULT, TACTIC_FIELDS)} AS channel_detail FROM early)"""


@query(
    "tactic_group",
    with_("campaigns")
    + f"""SELECT id, {rules_sql(rulesets.tactic_group_rules(), rulesets.TACTIC_GROUP_DEFAULT, {"tactic": "tactic", "campaign_team": "campaign_team"})} AS tactic_grouping,
  {rules_sql(rulesets.tactic_team_rules(), rulesets.TACTIC_TEAM_DEFAULT, {"tactic": "tactic", "campaign_team": "campaign_team"})} AS tactic_team FROM campaigns""",
)
def tactic_group(spark, sf):
    return campaign.group_tactics(rows(spark, sf, "campaigns").select("id", "tactic", "campaign_team")).select("id", "tactic_grouping", "tactic_team")


@query(
    "channel_rules_v2",
    with_("members", "campaigns", "leads", "contacts", "opportunities", then=FINAL)
    + """SELECT inquiry_id, lead_or_contact_id, interaction_time, opportunity_id, tactic_grouping, tactic_team, channel_detail,
  CASE WHEN channel_detail = 'Paid Gmail' THEN 'Display' WHEN channel_detail = 'No Referral' THEN 'No Referral'
       WHEN channel_detail LIKE '%Referral' THEN 'Referral' ELSE channel_detail END AS channel,
  CASE WHEN channel_detail LIKE '%Paid%' OR channel_detail = 'Display' THEN 'Paid Media' WHEN channel_detail LIKE 'Nurture%' THEN 'Nurture'
       WHEN channel_detail IN ('Organic Web', 'Direct', 'Email', 'Other Referral', 'Organic Social', 'Own website', 'DevX Referral', 'Partner Referral',
         'Organic Video') THEN 'Non Paid Web' ELSE channel_detail END AS channel_aggregate FROM final""",
)
def channel_rules_v2(spark, sf):
    out = campaign.campaign_attribution(
        _touches(spark, sf), rows(spark, sf, "campaigns"), _excluded(spark, sf), _touchpoints(spark, sf), VOCABULARY, stage
    )
    return out.select(
        "inquiry_id",
        "lead_or_contact_id",
        "interaction_time",
        "opportunity_id",
        "tactic_grouping",
        "tactic_team",
        "channel_detail",
        "channel",
        "channel_aggregate",
    )


TYPE = "CASE channel_detail WHEN 'Display' THEN 'display' WHEN 'Paid Gmail' THEN 'gmail' WHEN 'Paid Search' THEN 'sem' WHEN 'Paid Social' THEN channel_detail ELSE 'other' END"
CREDIT = f"""credit AS (SELECT {TYPE} AS mapping_channel_type,
    CASE WHEN channel_detail IN ('Display', 'Paid Gmail') THEN 'google' WHEN channel_detail IN ('Paid Search', 'Paid Social') THEN lower(utm_source)
      ELSE 'other' END AS mapping_channel, inquiry_date, web_campaign_name, sum(pg_new_arr_amount_credit) AS pg_new_arr_amount_credit,
    sum(pg_new_arr_oppty_credit) AS pg_new_arr_oppty_credit
  FROM paid_credits WHERE channel_aggregate = 'Paid Media' AND web_campaign_name IS NOT NULL AND inquiry_date >= DATE '2024-01-03' GROUP BY ALL)"""


def _credit(spark, sf):
    return paid_media.credit_by_day(rows(spark, sf, "paid_credits").withColumnRenamed("utm_source", "source"), SINCE)


@query(
    "paid_credit_day",
    with_("paid_credits", then=CREDIT)
    + "SELECT * REPLACE (round(pg_new_arr_amount_credit, 6) AS pg_new_arr_amount_credit, round(pg_new_arr_oppty_credit, 6) AS pg_new_arr_oppty_credit) FROM credit",
)
def paid_credit_day(spark, sf):
    sums = ("pg_new_arr_amount_credit", "pg_new_arr_oppty_credit")
    return _credit(spark, sf).withColumns({c: r6(c) for c in sums})


def _people(name: str, condition: str) -> str:
    return f"count(DISTINCT CASE WHEN {condition} THEN lead_or_contact_id END) AS {name}"


INBOUND_COUNTS = {
    "leads_or_contacts_touched": "TRUE",
    "net_new_leads": "is_net_new_lead",
    "sales_qualified_meetings": "is_sqm",
    "marketing_qualified_leads": "is_mql",
    "sales_qualified_leads": "is_sql",
    "high_score_leads": "score_at_create >= 90",
    "medium_score_leads": "score_at_create >= 62 AND score_at_create < 90",
    "low_score_leads": "score_at_create < 62",
    "missing_score_leads": "score_at_create IS NULL",
    "architect": "persona LIKE '%Arch%'",
    "developer": "persona LIKE '%Dev%'",
    "executive": "persona LIKE '%Exec%'",
    "operator": "persona = 'Operator'",
    "other_it_buyer": "persona = 'Other_IT_Buyer'",
    "other": "persona = 'Other'",
    "unknown": "persona IS NULL",
    "online_collateral": "campaign_type = 'Online Collateral'",
    "webinar_recorded": "campaign_type = 'Webinar - Recorded'",
    "webinar_live": "campaign_type = 'Webinar - Live'",
    "platform_download": "campaign_type = 'Platform Download'",
    "summit": "campaign_type = 'Annual Summit'",
    "contact_us": "campaign_type = 'Contact Us'",
}
INBOUND = f"""inbound AS (SELECT {TYPE} AS mapping_channel_type,
    CASE WHEN channel_detail = 'Paid Social' AND lower(utm_source) LIKE '%facebook%' THEN 'facebook'
      WHEN channel_detail = 'Paid Social' AND lower(utm_source) LIKE '%linkedin%' THEN 'linkedin'
      WHEN channel_detail = 'Paid Social' AND lower(utm_source) LIKE '%twitter%' THEN 'twitter'
      WHEN channel_detail IN ('Display', 'Paid Gmail') THEN 'google'
      WHEN channel_detail = 'Paid Search' AND lower(utm_source) LIKE '%bing%' THEN 'bing'
      WHEN channel_detail = 'Paid Search' AND lower(utm_source) LIKE '%google%' THEN 'google' ELSE 'other' END AS mapping_channel,
    inquiry_date, utm_campaign, count(DISTINCT campaign_member_id) AS inquiries,
    {", ".join(_people(n, c) for n, c in INBOUND_COUNTS.items())}
  FROM paid_funnel WHERE channel_aggregate = 'Paid Media' AND inquiry_date >= DATE '2024-01-03' GROUP BY ALL)"""


def _inbound(spark, sf):
    return paid_media.inbound_funnel(rows(spark, sf, "paid_funnel"), SINCE)


@query("inbound_wide", with_("paid_funnel", then=INBOUND) + "SELECT * FROM inbound")
def inbound_wide(spark, sf):
    return _inbound(spark, sf)


MILESTONES = """signups AS (SELECT CAST(a.signed_up_at AS DATE) AS sign_up_date,
    CASE channel WHEN 'Paid Social' THEN channel WHEN 'Paid Search' THEN 'sem' WHEN 'Paid Gmail' THEN 'gmail' WHEN 'Display' THEN 'display'
      ELSE 'other' END AS mapping_channel_type,
    CASE WHEN channel_detail IN ('Display', 'Paid Search') THEN 'Google' ELSE channel_detail END AS source, web_campaign_name AS utm_campaign,
    count(a.org_id) AS cloud_signups, count(email_verified_at) AS email_verified, count(cluster_created_at) AS cluster_created,
    count(usage_at) AS ob_activated, count(product_active_at) AS product_activated
  FROM paid_signups a LEFT JOIN milestones m ON m.org_id = a.org_id WHERE channel_aggregate = 'Paid Media' GROUP BY ALL)"""


def _signups(spark, sf):
    return paid_media.signup_milestones(rows(spark, sf, "paid_signups"), rows(spark, sf, "milestones"))


@query("signup_milestones", with_("paid_signups", "milestones", then=MILESTONES) + "SELECT * FROM signups")
def signup_milestones(spark, sf):
    return _signups(spark, sf)


@query(
    "paid_performance",
    with_("spend", "paid_credits", "paid_funnel", "paid_signups", "milestones", then=f"{CREDIT}, {INBOUND}, {MILESTONES}")
    + f"""SELECT s.* REPLACE (round(spend_usd, 6) AS spend_usd), CAST(date_trunc('quarter', s.day) AS DATE) AS quarter, n.name AS content_name, n.name AS content_type,
  r.r_name AS targeting_name, round(c.pg_new_arr_amount_credit, 6) AS pg_new_arr_amount_credit,
  round(c.pg_new_arr_oppty_credit, 6) AS pg_new_arr_oppty_credit, i.inquiries, {", ".join("i." + n for n in INBOUND_COUNTS)},
  u.cloud_signups, u.email_verified, u.cluster_created, u.ob_activated, u.product_activated
FROM spend s
LEFT JOIN credit c ON s.day = c.inquiry_date AND lower(s.channel_type) = lower(c.mapping_channel_type) AND lower(s.channel) = lower(c.mapping_channel)
  AND s.adgroup = c.web_campaign_name
LEFT JOIN inbound i ON s.day = i.inquiry_date AND lower(s.channel_type) = lower(i.mapping_channel_type) AND lower(s.channel) = lower(i.mapping_channel)
  AND s.adgroup = i.utm_campaign
LEFT JOIN signups u ON s.day = u.sign_up_date AND lower(s.channel_type) = lower(u.mapping_channel_type) AND lower(s.channel) = lower(u.source)
  AND s.adgroup = u.utm_campaign
LEFT JOIN (SELECT DISTINCT r_regionkey, r_name AS name FROM region) n ON n.r_regionkey = s.content
LEFT JOIN region r ON r.r_regionkey = s.targeting""",
)
def paid_performance(spark, sf):
    region = table(spark, sf, "region")
    contents = region.selectExpr("r_regionkey AS content_code", "r_name AS content_name", "r_name AS content_type")
    targetings = region.selectExpr("r_regionkey AS targeting_code", "r_name AS targeting_name")
    out = paid_media.paid_performance(
        rows(spark, sf, "spend"), _credit(spark, sf), _inbound(spark, sf), _signups(spark, sf), contents, targetings
    )
    doubles = [c for c, t in out.dtypes if t == "double"]
    return out.withColumns({c: r6(c) for c in doubles})


@query(
    "drilldown",
    with_("spend")
    + """SELECT channel, day, count(*) AS n, round(sum(spend_usd), 6) AS spend FROM spend
WHERE channel_type = 'SEM' AND day >= DATE '2024-01-14' AND day <= DATE '2024-01-20' GROUP BY ALL""",
)
def drilldown(spark, sf):
    return campaign.drill_down(
        rows(spark, sf, "spend"),
        [F.col("channel_type") == "SEM", campaign.in_week("day", dt.date(2024, 1, 14))],
        ["channel", "day"],
        {"n": F.count(F.lit(1)), "spend": r6(F.sum("spend_usd"))},
        [F.col("day").desc(), F.col("channel")],
    )


DRILL_LEVELS = (
    (),
    ("mapping_channel_type",),
    ("mapping_channel_type", "mapping_channel"),
    ("mapping_channel_type", "inquiry_date"),
    ("mapping_channel_type", "mapping_channel", "inquiry_date", "utm_campaign"),
)


def _drill_sql() -> str:
    """Each level counted again from the rows themselves."""
    inbound = INBOUND.removeprefix("inbound AS (").removesuffix(" GROUP BY ALL)")
    select, source = inbound.split("count(DISTINCT campaign_member_id) AS inquiries,")[0], inbound[inbound.index("FROM paid_funnel") :]
    parts = []
    for level in DRILL_LEVELS:
        shown = [k if k in level else f"NULL AS {k}" for k in paid_media.FUNNEL_KEYS]
        counts = [_people(n, c) for n, c in INBOUND_COUNTS.items()]
        grouped = f" GROUP BY {', '.join(level)}" if level else ""
        parts.append(f"SELECT {len(level)} AS dimensions, {', '.join(shown + counts)} FROM mapped{grouped}")
    columns = "lead_or_contact_id, is_net_new_lead, is_sqm, is_mql, is_sql, score_at_create, persona, campaign_type"
    return with_("paid_funnel", then=f"mapped AS ({select} {columns} {source})") + " UNION ALL ".join(parts)


@query("funnel_drilldown", _drill_sql())
def funnel_drilldown(spark, sf):
    states = stage(paid_media.funnel_states(rows(spark, sf, "paid_funnel"), SINCE, stage=stage), "funnel_states")
    levels = [
        distinct_roll_up(states, level, list(INBOUND_COUNTS)).select(
            F.lit(len(level)).alias("dimensions"),
            *[F.col(k) if k in level else F.lit(None).cast(states.schema[k].dataType).alias(k) for k in paid_media.FUNNEL_KEYS],
            *INBOUND_COUNTS,
        )
        for level in DRILL_LEVELS
    ]
    return reduce(DataFrame.unionByName, levels)


@query(
    "version_diff",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')""",
)
def version_diff(spark, sf):
    now = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")
    before = table(spark, sf, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.missing_keys(now, before, "o_orderkey")
