"""Signup attribution on the event table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from waymark.functions import times
from waymark.plans import identity, rulesets, signup, web
from waymark.queries.registry import query, r6, rules_sql
from waymark.queries.standins import rows, with_
from waymark.sources.sinks import stage

QUARTER = dt.date(2024, 1, 1)
SINCE = dt.date(2024, 1, 3)

COHORT = """cohort AS (
  SELECT o.id AS org_id, o.created_at, f.user_id AS first_user_id, f.email FROM orgs o
  LEFT JOIN (SELECT m.org_id, m.user_id, u.email, row_number() OVER (PARTITION BY m.org_id ORDER BY m.created_at, m.user_id) AS rn
    FROM memberships m JOIN users u ON u.id = m.user_id) f ON f.org_id = o.id AND f.rn = 1
  WHERE o.is_customer AND o.motion = 'Product-Led' AND o.created_at >= TIMESTAMP '2024-01-01' AND o.created_at < TIMESTAMP '2024-04-01')"""


def _cohort(spark, sf):
    return signup.org_cohort(rows(spark, sf, "orgs"), rows(spark, sf, "users"), rows(spark, sf, "memberships"), QUARTER)


@query("org_cohort", with_("orgs", "users", "memberships", then=COHORT) + "SELECT * FROM cohort")
def org_cohort(spark, sf):
    return _cohort(spark, sf)


@query(
    "in_list_semijoin",
    with_("orgs", "users", "memberships", "identifies", then=COHORT)
    + """SELECT DISTINCT email, anonymous_id, ga_cid, session_id, timestamp, utm_campaign, utm_medium, utm_source, referrer
FROM identifies WHERE email IN (SELECT email FROM cohort) AND timestamp >= TIMESTAMP '2024-01-03'""",
)
def in_list_semijoin(spark, sf):
    return signup.cohort_touches(rows(spark, sf, "identifies"), "email", _cohort(spark, sf), "email", SINCE)


def _nearest_sql(name: str, source: str, on: str, within: str) -> str:
    """Nearest touch per org by exact distance, the earlier one on a tie."""
    return f"""{name} AS (SELECT * FROM (SELECT c.org_id, t.*, row_number() OVER (PARTITION BY c.org_id
    ORDER BY abs(epoch_us(c.created_at) - epoch_us(t.timestamp)), t.timestamp) AS rn
  FROM cohort c JOIN {source} t ON {on}{within}) WHERE rn = 1)"""


WITHIN = " AND abs(date_sub('hour', t.timestamp, c.created_at)) <= 30"
NEAREST = ", ".join(
    [
        COHORT,
        _nearest_sql("ni", "identifies", "c.email = t.email", WITHIN),
        _nearest_sql("ns", "socials", "c.first_user_id = t.user_id", ""),
        _nearest_sql("nc", "cloud_pages", "c.first_user_id = t.user_id", WITHIN),
    ]
)


def _pick(f: str) -> str:
    return f"coalesce(ni.{f}, ns.{f}, nc.{f}) AS {f}"


TOUCHED = f"""touched AS (SELECT c.*, {_pick("anonymous_id")}, nc.anonymous_id AS cloud_anonymous_id,
  CASE WHEN ns.anonymous_id IS NOT NULL THEN 'social signup' WHEN ni.anonymous_id IS NOT NULL THEN 'direct' END AS flg_social_signup,
  ni.ga_cid, ni.session_id, coalesce(ni.timestamp, ns.timestamp) AS touch_at, nc.timestamp AS cloud_at,
  {_pick("utm_campaign")}, {_pick("utm_medium")}, {_pick("utm_source")}, {_pick("referrer")},
  date_sub('minute', coalesce(ni.timestamp, ns.timestamp), c.created_at) AS delta_signup_touch_min
FROM cohort c LEFT JOIN ni ON ni.org_id = c.org_id LEFT JOIN ns ON ns.org_id = c.org_id LEFT JOIN nc ON nc.org_id = c.org_id),
kept AS (SELECT * FROM touched WHERE coalesce(utm_campaign, utm_medium, utm_source, referrer) IS NOT NULL)"""
CHAIN = ("orgs", "users", "memberships", "identifies", "socials", "cloud_pages")


def _touch(spark, sf, hours_off=30):
    # 30 hours instead of two: the given events are sparse. The published limits are queries of their own.
    # The cohort is read four times.
    logs = [rows(spark, sf, name) for name in ("identifies", "socials", "cloud_pages")]
    return signup.signup_touch(stage(_cohort(spark, sf), "cohort"), *logs, hours_off=hours_off)


@query("cohort_touch_nearest", with_(*CHAIN, then=f"{NEAREST}, {TOUCHED}") + "SELECT * FROM kept")
def cohort_touch_nearest(spark, sf):
    return _touch(spark, sf)


PUBLISHED = f"{NEAREST}, {TOUCHED}".replace("<= 30", "<= 2")


@query("cohort_touch_within_2h", with_(*CHAIN, then=PUBLISHED) + "SELECT * FROM kept")
def cohort_touch_within_2h(spark, sf):
    return _touch(spark, sf, hours_off=2)


@query(
    "touch_coverage",
    with_("all_events")
    + """SELECT count(DISTINCT org_id) AS orgs,
  count(DISTINCT CASE WHEN coalesce(utm_campaign, utm_medium, utm_source,
    CASE WHEN referrer LIKE '%example.com%' THEN NULL ELSE referrer END) IS NOT NULL THEN org_id END) AS orgs_tag_or_usable_referrer,
  count(DISTINCT CASE WHEN coalesce(utm_campaign, utm_medium, utm_source, referrer) IS NOT NULL THEN org_id END) AS orgs_tag_or_referrer,
  count(DISTINCT CASE WHEN k % 7 <> 0 THEN org_id END) AS orgs_with_visitor
FROM (SELECT *, session_id AS org_id FROM all_events)""",
)
def coverage(spark, sf):
    events = rows(spark, sf, "all_events").withColumnRenamed("session_id", "org_id")
    return signup.touch_coverage(events.withColumn("anonymous_id", F.expr("CASE WHEN k % 7 <> 0 THEN 'a' END")))


LOOKBACK = """lookback AS (SELECT k.org_id, k.created_at, k.anonymous_id, k.cloud_at, k.utm_medium, k.utm_source, k.utm_campaign, k.referrer,
    p.timestamp AS page_at, p.url, p.session_id AS page_session_id,
    date_sub('day', p.timestamp, k.created_at) AS delta_signup_page_day, date_sub('hour', p.timestamp, k.created_at) AS delta_signup_page_hour,
    date_sub('second', p.timestamp, k.created_at) AS delta_signup_page_second, date_sub('hour', k.cloud_at, k.created_at) AS delta_signup_cloud_hour
  FROM kept k LEFT JOIN site_pages p ON p.anonymous_id = k.anonymous_id AND p.timestamp < k.created_at
  WHERE date_sub('day', p.timestamp, k.created_at) <= 10 OR date_sub('day', k.cloud_at, k.created_at) <= 10)"""
SIGNUP_COLUMNS = ["org_id", "created_at", "anonymous_id", "cloud_at", "utm_medium", "utm_source", "utm_campaign", "referrer"]


def _lookback(spark, sf, hours_off=30, days=10):
    # Ten days instead of thirty, so that older pages exist and are left out.
    # The signup touches are their own table, as they are read several times.
    touched = stage(_touch(spark, sf, hours_off).select(*SIGNUP_COLUMNS), "signup_touch")
    return signup.lookback_pages(touched, rows(spark, sf, "site_pages"), days=days)


@query(
    "lookback_30d",
    with_(*CHAIN, "site_pages", then=f"{NEAREST}, {TOUCHED}, {LOOKBACK}") + "SELECT * FROM lookback",
)
def lookback_30d(spark, sf):
    return _lookback(spark, sf)


LAST_PAGE = """last_page AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org_id
    ORDER BY delta_signup_page_second NULLS LAST, page_at DESC NULLS LAST, url NULLS FIRST) AS rn
  FROM lookback WHERE delta_signup_page_hour <= 12 OR delta_signup_cloud_hour <= 12) WHERE rn = 1)"""


@query(
    "last_page_before_signup",
    with_(*CHAIN, "site_pages", then=f"{NEAREST}, {TOUCHED}, {LOOKBACK}, {LAST_PAGE}") + "SELECT * EXCLUDE (rn) FROM last_page",
)
def last_page_before_signup(spark, sf):
    return signup.last_page_before_signup(_lookback(spark, sf), hours_back=12)


LOOKBACK_PUBLISHED = LOOKBACK.replace("<= 10", "<= 30")


@query("lookback_published", with_(*CHAIN, "site_pages", then=f"{PUBLISHED}, {LOOKBACK_PUBLISHED}") + "SELECT * FROM lookback")
def lookback_published(spark, sf):
    return _lookback(spark, sf, hours_off=2, days=30)


@query(
    "last_page_within_6h",
    with_(*CHAIN, "site_pages", then=f"{PUBLISHED}, {LOOKBACK_PUBLISHED}, {LAST_PAGE.replace('<= 12', '<= 6')}")
    + "SELECT * EXCLUDE (rn) FROM last_page",
)
def last_page_within_6h(spark, sf):
    return signup.last_page_before_signup(_lookback(spark, sf, hours_off=2, days=30))


TAG_SQL = {"medium": "utm_medium", "source": "utm_source", "campaign": "utm_campaign"}
LAST_TOUCH = """last_touch AS (
  SELECT c.event_id, c.user_id, c.ts AS converted_at, t.ts AS touched_at, t.event_id AS touch_id, lower(t.utm_medium) AS utm_medium,
    lower(t.utm_source) AS utm_source, lower(t.utm_campaign) AS utm_campaign
  FROM (SELECT * FROM all_events WHERE event_type = 'signup') c
  LEFT JOIN LATERAL (SELECT * FROM all_events t WHERE t.event_type IN ('view', 'click') AND t.user_id = c.user_id AND t.ts < c.ts
      AND date_sub('day', t.ts, c.ts) <= 30 ORDER BY t.ts DESC LIMIT 1) t ON TRUE)"""


def _last_touch(spark, sf):
    events = rows(spark, sf, "all_events")
    conversions = events.filter("event_type = 'signup'").selectExpr("event_id", "user_id", "ts AS converted_at")
    touches = events.filter("event_type IN ('view', 'click')").selectExpr(
        "event_id AS touch_id",
        "user_id",
        "ts AS touched_at",
        "lower(utm_medium) AS utm_medium",
        "lower(utm_source) AS utm_source",
        "lower(utm_campaign) AS utm_campaign",
    )
    found = signup.last_touch(conversions, touches, "user_id", 30, ["touch_id", "utm_medium", "utm_source", "utm_campaign"])
    return web.channel_detail(found, rulesets.web_channel_rules(), rulesets.WEB_DEFAULT, {k: v for k, v in TAG_SQL.items()})


@query(
    "last_touch_detail",
    with_("all_events", then=LAST_TOUCH)
    + f"SELECT *, {rules_sql(rulesets.web_channel_rules(), 'No Referral', TAG_SQL)} AS channel_detail FROM last_touch",
)
def last_touch_detail(spark, sf):
    return _last_touch(spark, sf)


@query(
    "last_touch",
    with_("all_events", then=LAST_TOUCH)
    + f"""SELECT {rules_sql(rulesets.web_channel_rules(), 'No Referral', TAG_SQL)} AS channel_detail, count(DISTINCT user_id) AS orgs
FROM last_touch GROUP BY 1""",
)
def last_touch(spark, sf):
    found = _last_touch(spark, sf).withColumnRenamed("user_id", "org_id")
    return signup.channel_mix(found)


BLEND_SQL = {"medium": "combined_medium", "source": "combined_source", "campaign": "combined_campaign", "referrer": "referrer", "anonymous_id": "anonymous_id"}
OWN = "'example.com', 'app.example.com', 'drift'"


def _known(f: str, nothing: str) -> str:
    return f"CASE WHEN lower({f}) NOT IN ({nothing}) THEN lower({f}) END"


BLENDED = f"""web AS (SELECT event_id AS org_id, ts AS seg_created_at, utm_medium AS seg_medium, {_known("utm_source", OWN)} AS seg_source,
    utm_campaign AS seg_campaign, referrer, CASE WHEN k % 5 <> 0 THEN 'a' || user_id END AS anonymous_id FROM all_events WHERE event_type IN ('view', 'signup')),
inq AS (SELECT event_id AS org_id, ts AS inquiry_org_created_at, ts AS inquiry_created_at,
    {_known("utm_medium", OWN + ", 'unknown', '(unknown)', 'webchat'")} AS inquiry_medium,
    {_known("utm_source", OWN + ", 'unknown', '(unknown)', 'webchat'")} AS inquiry_source, lower(utm_campaign) AS inquiry_campaign
  FROM (SELECT *  REPLACE (CASE WHEN k % 9 = 0 THEN 'WebChat' ELSE utm_source END AS utm_source) FROM all_events WHERE event_type IN ('signup', 'click'))),
ga AS (SELECT org_id, created_at AS ga_created_at, medium AS ga_medium, source AS ga_source, campaign AS ga_campaign FROM (
    SELECT event_id - event_id % 2 AS org_id, ts AS created_at, utm_medium AS medium, utm_source AS source, utm_campaign AS campaign,
      row_number() OVER (PARTITION BY event_id - event_id % 2 ORDER BY k * 60, CAST(event_id AS VARCHAR)) AS rn
    FROM all_events WHERE k // 10 <= 6) WHERE rn = 1),
blended AS (SELECT coalesce(i.org_id, w.org_id, g.org_id) AS org_id, lower(coalesce(seg_medium, inquiry_medium, ga_medium)) AS combined_medium,
    lower(coalesce(seg_source, inquiry_source, ga_source)) AS combined_source, lower(coalesce(seg_campaign, inquiry_campaign, ga_campaign)) AS combined_campaign,
    CASE WHEN referrer LIKE '%example.com%' THEN 'NA' ELSE referrer END AS referrer, anonymous_id,
    coalesce(inquiry_org_created_at, seg_created_at, ga_created_at) AS created_at
  FROM inq i FULL JOIN web w ON i.org_id = w.org_id FULL JOIN ga g ON coalesce(i.org_id, w.org_id) = g.org_id)"""


def _blended(spark, sf):
    events = rows(spark, sf, "all_events").withColumn("org_id", F.col("event_id")).withColumn("created_at", F.col("ts"))
    pages = events.filter("event_type IN ('view', 'signup')").withColumn(
        "anonymous_id", F.expr("CASE WHEN k % 5 <> 0 THEN 'a' || CAST(user_id AS STRING) END")
    )
    asked = events.filter("event_type IN ('signup', 'click')").withColumn("inquiry_created_at", F.col("ts"))
    asked = asked.withColumn("utm_source", F.expr("CASE WHEN k % 9 = 0 THEN 'WebChat' ELSE utm_source END"))
    sessions = rows(spark, sf, "all_events").selectExpr(
        "event_id - event_id % 2 AS org_id",
        "ts AS created_at",
        "utm_medium AS medium",
        "utm_source AS source",
        "utm_campaign AS campaign",
        "CAST(floor(k / 10) AS INT) AS delta_signup_session_hour",
        "k * 60 AS delta_signup_session_second",
        "user_id AS ga_client_id",
        "CAST(event_id AS STRING) AS session_id",
    )
    return signup.blend(signup.inquiry_touch(asked), signup.web_touch(pages), signup.analytics_touch(sessions))


BLEND_COLUMNS = ["org_id", "combined_medium", "combined_source", "combined_campaign", "referrer", "anonymous_id", "created_at"]


@query("blend_sources", with_("all_events", then=BLENDED) + "SELECT * FROM blended")
def blend_sources(spark, sf):
    return _blended(spark, sf).select(*BLEND_COLUMNS)


REPORT = f"""SELECT org_id, channel_detail,
  CASE WHEN channel_detail = 'Paid Gmail' THEN 'Display' WHEN channel_detail = 'No Referral' THEN 'No Referral'
       WHEN channel_detail LIKE '%Referral' THEN 'Referral' ELSE channel_detail END AS channel,
  CASE WHEN channel_detail LIKE '%Paid%' OR channel_detail = 'Display' THEN 'Paid Media' WHEN channel_detail LIKE 'Nurture%' THEN 'Nurture'
       WHEN channel_detail IN ('Direct', 'Email', 'Other Referral', 'Own website', 'DevX Referral', 'Partner Referral') THEN 'Non Paid Web'
       ELSE channel_detail END AS channel_aggregate
FROM (SELECT org_id, {rules_sql(rulesets.signup_channel_rules(), "No Referral", BLEND_SQL)} AS channel_detail FROM blended)"""


@query("channel_rules_v3", with_("all_events", then=BLENDED) + REPORT)
def channel_rules_v3(spark, sf):
    return signup.last_touch_report(_blended(spark, sf)).select("org_id", "channel_detail", "channel", "channel_aggregate")


# The whole chain: cohort, touches, look-back, last page, blending with inquiry and session, report.
CHAIN_BLEND = f"""web AS (SELECT org_id, created_at AS seg_created_at, utm_medium AS seg_medium, {_known("utm_source", OWN)} AS seg_source,
    utm_campaign AS seg_campaign, referrer, anonymous_id FROM last_page),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM all_events
    WHERE event_type = 'signup') WHERE rn = 1),
inq AS (SELECT user_id AS org_id, ts AS inquiry_org_created_at, ts AS inquiry_created_at,
    {_known("utm_medium", OWN + ", 'unknown', '(unknown)', 'webchat'")} AS inquiry_medium,
    {_known("utm_source", OWN + ", 'unknown', '(unknown)', 'webchat'")} AS inquiry_source, lower(utm_campaign) AS inquiry_campaign FROM firsts),
ga AS (SELECT org_id, created_at AS ga_created_at, medium AS ga_medium, source AS ga_source, campaign AS ga_campaign FROM (
    SELECT user_id AS org_id, ts AS created_at, utm_medium AS medium, utm_source AS source, utm_campaign AS campaign,
      row_number() OVER (PARTITION BY user_id ORDER BY k * 60, CAST(event_id AS VARCHAR)) AS rn
    FROM all_events WHERE event_type = 'view' AND k // 10 <= 6) WHERE rn = 1),
{BLENDED[BLENDED.index("blended AS"):]}"""


@query(
    "signup_chain",
    with_(*CHAIN, "site_pages", "all_events", then=f"{NEAREST}, {TOUCHED}, {LOOKBACK}, {LAST_PAGE}, {CHAIN_BLEND}") + REPORT,
)
def signup_chain(spark, sf):
    pages = signup.last_page_before_signup(_lookback(spark, sf), hours_back=12)
    events = rows(spark, sf, "all_events")
    tags = ["utm_medium", "utm_source", "utm_campaign"]
    first = events.filter("event_type = 'signup'").groupBy("user_id").agg(F.min(F.struct("ts", "event_id", *tags)).alias("f"))
    asked = first.select(F.col("user_id").alias("org_id"), F.col("f.ts").alias("created_at"), *[F.col(f"f.{t}").alias(t) for t in tags])
    sessions = events.filter("event_type = 'view'").selectExpr(
        "user_id AS org_id",
        "ts AS created_at",
        "utm_medium AS medium",
        "utm_source AS source",
        "utm_campaign AS campaign",
        "CAST(floor(k / 10) AS INT) AS delta_signup_session_hour",
        "k * 60 AS delta_signup_session_second",
        "user_id AS ga_client_id",
        "CAST(event_id AS STRING) AS session_id",
    )
    inquiries = signup.inquiry_touch(asked.withColumn("inquiry_created_at", F.col("created_at")))
    blended = signup.blend(inquiries, signup.web_touch(pages), signup.analytics_touch(sessions))
    return signup.last_touch_report(blended).select("org_id", "channel_detail", "channel", "channel_aggregate")


LINEAR = """touches AS (
  SELECT DISTINCT user_id AS org_id, CAST(ts AS DATE) AS created_at, 'd' || k % 6 AS channel_detail, 'c' || k % 3 AS channel,
    'a' || k % 2 AS channel_aggregate, '30d_web' AS attr_source, utm_source AS channel_source, utm_medium AS channel_medium,
    utm_campaign AS channel_campaign, session_id, 'g' || user_id AS ga_client_id, 'u' || k % 4 AS url, 'h' || k % 2 AS hostname
  FROM all_events WHERE event_type IN ('view', 'click') AND k // 10 > 6
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), 'd' || k % 6, 'c' || k % 3, 'a' || k % 2, 'signup_last_touch', utm_source, utm_medium, utm_campaign,
    'Null_session_id', 'Null_ga_client_id', 'Null_url', 'Null_hostname' FROM all_events WHERE event_type = 'signup'),
linear AS (SELECT *, count(*) OVER (PARTITION BY org_id) AS num_channel, 1.0 / count(*) OVER (PARTITION BY org_id) AS linear_credit FROM touches)"""


def _linear(spark, sf):
    touches = rows(spark, sf, "all_events").selectExpr(
        "event_type",
        "user_id AS org_id",
        "CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_at",
        "'d' || CAST(k % 6 AS STRING) AS channel_detail",
        "'c' || CAST(k % 3 AS STRING) AS channel",
        "'a' || CAST(k % 2 AS STRING) AS channel_aggregate",
        "utm_source AS channel_source",
        "utm_medium AS channel_medium",
        "utm_campaign AS channel_campaign",
        "session_id",
        "'g' || CAST(user_id AS STRING) AS ga_client_id",
        "'u' || CAST(k % 4 AS STRING) AS url",
        "'h' || CAST(k % 2 AS STRING) AS hostname",
        "CAST(floor(k / 10) AS INT) AS delta_signup_touch_hour",
    )
    return signup.linear_touches(touches.filter("event_type IN ('view', 'click')"), touches.filter("event_type = 'signup'"))


LINEAR_COLUMNS = ["org_id", "channel_detail", "attr_source", *signup.LINEAR_FIELDS, "num_channel"]


@query(
    "linear_credit",
    with_("all_events", then=LINEAR)
    + f"SELECT {', '.join(LINEAR_COLUMNS)}, round(linear_credit, 6) AS linear_credit FROM linear",
)
def linear_credit(spark, sf):
    return _linear(spark, sf).select(*LINEAR_COLUMNS, r6("linear_credit").alias("linear_credit"))


STAGES = """stages AS (SELECT org_id, signed_up_at,
    CASE WHEN CAST(usage_at AS DATE) - 7 <= CAST(signed_up_at AS DATE) THEN usage_at END AS onboarding_activated_7d,
    CASE WHEN CAST(product_active_at AS DATE) - 14 <= CAST(signed_up_at AS DATE) THEN product_active_at END AS production_activation_14d
  FROM (SELECT * FROM milestones UNION ALL SELECT -1 - event_id, ts, NULL, NULL, ts, NULL, NULL, NULL FROM all_events WHERE event_type = 'signup'))"""


def _funnel(spark, sf):
    # Signups without touches: one made from each signup event under an id no touch has.
    bare = rows(spark, sf, "all_events").filter("event_type = 'signup'").selectExpr(
        "-1 - event_id AS org_id", "ts AS signed_up_at", "ts AS usage_at", "CAST(NULL AS TIMESTAMP) AS product_active_at"
    )
    return rows(spark, sf, "milestones").select("org_id", "signed_up_at", "usage_at", "product_active_at").unionByName(bare)


@query(
    "credit_on_activation",
    with_("all_events", "milestones", then=f"{LINEAR}, {STAGES}")
    + """SELECT coalesce(l.org_id, s.org_id) AS org_id, coalesce(s.signed_up_at, CAST(l.created_at AS TIMESTAMP)) AS created_at,
  coalesce(channel_detail, 'No Referral') AS channel_detail, coalesce(channel, 'No Referral') AS channel, attr_source, session_id, url, hostname,
  round(coalesce(linear_credit, 1), 6) AS linear_credit, onboarding_activated_7d, production_activation_14d,
  round(CASE WHEN onboarding_activated_7d IS NOT NULL THEN coalesce(linear_credit, 1) END, 6) AS linear_credit_oa,
  round(CASE WHEN production_activation_14d IS NOT NULL THEN coalesce(linear_credit, 1) END, 6) AS linear_credit_pao
FROM linear l FULL JOIN stages s ON l.org_id = s.org_id""",
)
def credit_on_activation(spark, sf):
    out = signup.credit_on_activation(_linear(spark, sf), _funnel(spark, sf), stage=stage)
    return out.select(
        "org_id",
        "created_at",
        "channel_detail",
        "channel",
        "attr_source",
        "session_id",
        "url",
        "hostname",
        r6("linear_credit").alias("linear_credit"),
        "onboarding_activated_7d",
        "production_activation_14d",
        r6("linear_credit_oa").alias("linear_credit_oa"),
        r6("linear_credit_pao").alias("linear_credit_pao"),
    )


@query(
    "attribution_reconcile",
    with_("all_events", "milestones", then=f"{LINEAR}, {STAGES}")
    + """, ours AS (SELECT coalesce(l.org_id, s.org_id) AS org_id, ga_client_id, session_id, url, hostname,
    coalesce(channel_detail, 'No Referral') AS d, coalesce(linear_credit, 1) AS credit FROM linear l FULL JOIN stages s ON l.org_id = s.org_id),
theirs AS (SELECT DISTINCT user_id AS org_id, 'g' || user_id AS ga_client_id, session_id, 'u' || k % 4 AS url, 'h' || k % 2 AS hostname, 'e' || k % 5 AS e
    FROM all_events WHERE event_type = 'click')
SELECT coalesce(o.org_id, t.org_id) AS org_id, coalesce(o.session_id, t.session_id) AS session_id, coalesce(o.url, t.url) AS url,
  d AS channel_detail_lt, e AS channel_detail_ga, t.org_id AS org_id_ga, coalesce(d, e) AS channel_detail_grouped, round(credit, 6) AS linear_credit
FROM ours o FULL JOIN theirs t ON o.org_id = t.org_id AND o.ga_client_id = t.ga_client_id AND o.session_id = t.session_id AND o.url = t.url
  AND o.hostname = t.hostname""",
)
def attribution_reconcile(spark, sf):
    # Ours is what the credit job gives; theirs is made from the clicks.
    ours = signup.credit_on_activation(_linear(spark, sf), _funnel(spark, sf), stage=stage)
    theirs = rows(spark, sf, "all_events").filter("event_type = 'click'").selectExpr(
        "user_id AS org_id",
        "'g' || CAST(user_id AS STRING) AS ga_client_id",
        "session_id",
        "'u' || CAST(k % 4 AS STRING) AS url",
        "'h' || CAST(k % 2 AS STRING) AS hostname",
        "'e' || CAST(k % 5 AS STRING) AS channel_detail",
    )
    merged = signup.reconcile_attributions(ours, theirs)
    columns = ["org_id", "session_id", "url", "channel_detail_lt", "channel_detail_ga", "org_id_ga", "channel_detail_grouped"]
    return merged.select(*columns, r6("linear_credit").alias("linear_credit"))


@query(
    "channel_mix",
    with_("all_events", "orgs", "users", "memberships", then=COHORT)
    + """SELECT 'd' || k % 7 AS channel_detail, count(DISTINCT user_id) AS orgs FROM all_events
WHERE user_id IN (SELECT org_id FROM cohort) GROUP BY 1""",
)
def channel_mix(spark, sf):
    attributed = rows(spark, sf, "all_events").selectExpr("user_id AS org_id", "'d' || CAST(k % 7 AS STRING) AS channel_detail")
    return signup.channel_mix(attributed, _cohort(spark, sf))


ATTRIBUTION = """attribution AS (SELECT 'L' || user_id AS lead_or_contact_id, CASE WHEN k % 40 = 0 THEN 'No Referral' ELSE 'Paid' END AS channel_aggregate,
  ts AS signed_up_at FROM all_events WHERE event_type = 'signup')"""


def _attribution(spark, sf):
    return rows(spark, sf, "all_events").filter("event_type = 'signup'").selectExpr(
        "'L' || CAST(user_id AS STRING) AS lead_or_contact_id",
        "CASE WHEN k % 40 = 0 THEN 'No Referral' ELSE 'Paid' END AS channel_aggregate",
        "ts AS signed_up_at",
    )


@query(
    "unattributed_touches",
    with_("all_events", then=ATTRIBUTION)
    + """SELECT event_id, 'L' || user_id AS lead_or_contact_id, ts, utm_campaign, utm_medium, utm_source FROM all_events
WHERE event_type IN ('view', 'click') AND coalesce(utm_campaign, utm_medium, utm_source) IS NOT NULL
  AND 'L' || user_id IN (SELECT lead_or_contact_id FROM attribution WHERE channel_aggregate = 'No Referral' AND signed_up_at >= TIMESTAMP '2024-01-03')""",
)
def unattributed_touches(spark, sf):
    touches = rows(spark, sf, "all_events").filter("event_type IN ('view', 'click')").selectExpr(
        "event_id", "'L' || CAST(user_id AS STRING) AS lead_or_contact_id", "ts", "utm_campaign", "utm_medium", "utm_source"
    )
    return signup.unattributed_touches(touches, _attribution(spark, sf), SINCE, ["utm_campaign", "utm_medium", "utm_source"])


@query(
    "leads_with_web_visit",
    with_("all_events", "orgs", "users", "leads")
    + """SELECT DISTINCT l.id AS lead_or_contact_id FROM all_events w JOIN leads l ON l.id = 'L' || w.user_id
JOIN (SELECT u.email, o.created_at FROM orgs o JOIN users u ON u.id = o.id) s ON s.email = l.email
WHERE w.event_type = 'error' AND w.utm_medium IS NOT NULL AND date_sub('minute', w.ts, s.created_at) <= 360""",
)
def leads_with_web_visit(spark, sf):
    visits = rows(spark, sf, "all_events").filter("event_type = 'error'").selectExpr(
        "'L' || CAST(user_id AS STRING) AS lead_or_contact_id", "ts AS visit_time", "utm_medium AS medium"
    )
    signups = rows(spark, sf, "orgs").join(rows(spark, sf, "users").select("id", "email"), "id")
    return signup.leads_with_web_visit(visits, rows(spark, sf, "leads"), signups.withColumnRenamed("created_at", "signed_up_at"))


LOST = "lost AS (SELECT lead_or_contact_id FROM attribution WHERE channel_aggregate = 'No Referral' AND signed_up_at >= TIMESTAMP '2024-01-03')"
FORM_IDS = (5, 6, 17, 20, 35)


@query(
    "no_referral_evidence",
    with_("all_events", "identifies", "forms", "site_pages", "leads", then=f"{ATTRIBUTION}, {LOST}")
    + """, logs AS (
  SELECT 'identify' AS log, anonymous_id, session_id, timestamp AS visit_time, utm_campaign, utm_medium, utm_source FROM identifies
  UNION ALL SELECT 'form', 'a' || visitor_id, session_id, timestamp, NULL, NULL, NULL FROM forms WHERE form_id IN (5, 6, 17, 20, 35)
  UNION ALL SELECT 'page', anonymous_id, session_id, timestamp, utm_campaign, utm_medium, utm_source FROM site_pages
    WHERE utm_campaign IS NOT NULL OR utm_medium IS NOT NULL OR utm_source IS NOT NULL),
lead_map AS (SELECT DISTINCT i.anonymous_id, l.email, l.id AS lead_or_contact_id FROM leads l JOIN identifies i ON i.email = l.email)
SELECT log, anonymous_id, email, lead_or_contact_id, session_id, visit_time, utm_campaign, utm_medium, utm_source
FROM logs JOIN lead_map USING (anonymous_id) WHERE lead_or_contact_id IN (SELECT lead_or_contact_id FROM lost)""",
)
def no_referral_evidence(spark, sf):
    identifies = rows(spark, sf, "identifies")
    forms = rows(spark, sf, "forms").filter(F.col("form_id").isin(*FORM_IDS))
    forms = forms.withColumn("anonymous_id", F.concat(F.lit("a"), F.col("visitor_id").cast("string")))
    logs = {"identify": identifies, "form": forms, "page": rows(spark, sf, "site_pages")}
    lead_map = identity.lead_to_visitor(rows(spark, sf, "leads"), identifies, SINCE, "www.example.com")
    return signup.no_referral_evidence(logs, lead_map, _attribution(spark, sf), SINCE)


@query(
    "no_referral_members",
    with_("all_events", "members", "campaigns", then=f"{ATTRIBUTION}, {LOST}")
    + """SELECT m.id, campaign_id, campaign_name, lead_id, status, utm_campaign, utm_medium, utm_source
FROM members m JOIN campaigns c ON c.id = m.campaign_id
WHERE lead_id IN (SELECT lead_or_contact_id FROM lost) AND left(campaign_name, 1) = 's' AND campaign_name <> 'small ring'
  AND (utm_campaign IS NOT NULL OR utm_medium IS NOT NULL OR utm_source IS NOT NULL)""",
)
def no_referral_members(spark, sf):
    found = signup.no_referral_members(
        rows(spark, sf, "members"), rows(spark, sf, "campaigns"), _attribution(spark, sf), SINCE, "s", ["small ring"]
    )
    return found.select("id", "campaign_id", "campaign_name", "lead_id", "status", *signup.EVIDENCE_TAGS)


def _web_visits(spark, sf):
    return rows(spark, sf, "all_events").filter("event_type = 'error'").selectExpr(
        "event_id", "session_id", "'L' || CAST(user_id AS STRING) AS lead_or_contact_id", "ts AS visit_time", "utm_campaign AS campaign_name",
        "utm_source AS source", "utm_medium AS medium",
    )


def _org_signups(spark, sf):
    orgs = rows(spark, sf, "orgs").selectExpr("id AS org_id", "created_at AS signed_up_at")
    return orgs.join(rows(spark, sf, "users").selectExpr("id AS org_id", "email"), "org_id")


MATCHES = """matches AS (SELECT w.event_id, w.session_id, l.id AS lead_or_contact_id, w.ts AS visit_time, w.utm_campaign AS campaign_name,
    w.utm_source AS source, w.utm_medium AS medium, s.org_id, s.email, s.signed_up_at, date_sub('minute', w.ts, s.signed_up_at) AS min_diff
  FROM all_events w JOIN leads l ON l.id = 'L' || w.user_id
  JOIN (SELECT o.id AS org_id, u.email, o.created_at AS signed_up_at FROM orgs o JOIN users u ON u.id = o.id) s ON s.email = l.email
  WHERE w.event_type = 'error' AND w.utm_medium IS NOT NULL AND date_sub('minute', w.ts, s.signed_up_at) <= 360)"""


@query("web_visit_matches", with_("all_events", "orgs", "users", "leads", then=MATCHES) + "SELECT * FROM matches")
def web_visit_matches(spark, sf):
    return signup.web_visit_matches(_web_visits(spark, sf), rows(spark, sf, "leads"), _org_signups(spark, sf))


@query(
    "no_referral_web_visits",
    with_("all_events", "orgs", "users", "leads", then=f"{ATTRIBUTION}, {LOST}, {MATCHES}")
    + """SELECT DISTINCT lead_or_contact_id FROM matches
WHERE visit_time > TIMESTAMP '2024-01-03' AND lead_or_contact_id IN (SELECT lead_or_contact_id FROM lost)""",
)
def no_referral_web_visits(spark, sf):
    return signup.leads_with_web_visit(
        _web_visits(spark, sf), rows(spark, sf, "leads"), _org_signups(spark, sf), attribution=_attribution(spark, sf), since=SINCE
    )


@query(
    "signup_units",
    with_("orgs", "milestones")
    + """SELECT o.id AS org_id, date_sub('day', m.signed_up_at, o.created_at) AS days, date_sub('hour', m.signed_up_at, o.created_at) AS hours,
  date_sub('minute', o.created_at, m.signed_up_at) AS minutes_back, date_sub('second', m.signed_up_at, o.created_at) AS seconds,
  CAST(o.created_at AS DATE) - CAST(m.signed_up_at AS DATE) AS calendar_days
FROM orgs o JOIN milestones m ON m.org_id = o.id""",
)
def signup_units(spark, sf):
    joined = rows(spark, sf, "orgs").select(F.col("id").alias("org_id"), "created_at").join(
        rows(spark, sf, "milestones").select("org_id", "signed_up_at"), "org_id"
    )
    first, last = F.col("signed_up_at"), F.col("created_at")
    return joined.select(
        "org_id",
        times.whole_units("DAY", first, last).alias("days"),
        times.whole_units("HOUR", first, last).alias("hours"),
        times.whole_units("MINUTE", last, first).alias("minutes_back"),
        times.whole_units("SECOND", first, last).alias("seconds"),
        F.datediff(last, first).cast("bigint").alias("calendar_days"),
    )
