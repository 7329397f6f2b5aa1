"""Web behaviour on the event and page tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from waymark.functions import marketing, text, times
from waymark.operators import asof_neighbours
from waymark.plans import increments, rulesets, web
from waymark.queries.registry import query, rules_sql
from waymark.queries.standins import rows, table, with_
from waymark.session import shared_folder
from waymark.sources.layout import lay_out
from waymark.sources.sinks import stage

RUN_DATE = dt.date(2024, 1, 16)

SEQUENCED = """seq AS (
  SELECT *,
    lead(visit_start_time) OVER w AS visit_end_time,
    row_number() OVER w AS rank_from_start,
    row_number() OVER (PARTITION BY domain, visitor_id, session_id
                       ORDER BY visit_start_time DESC, page_visit_id DESC) AS rank_from_end
  FROM page_views
  WINDOW w AS (PARTITION BY domain, visitor_id, session_id ORDER BY visit_start_time, page_visit_id)
)"""
FLAGS = """
  CASE WHEN rank_from_start = 1 THEN 'True' ELSE 'False' END AS is_entrance,
  CASE WHEN rank_from_end = 1 THEN 'True' ELSE 'False' END AS is_exit,
  CASE WHEN rank_from_start = 1 AND rank_from_end = 1 THEN 'True' ELSE 'False' END AS is_bounce"""


@query(
    "page_sequence",
    with_("page_views", then=SEQUENCED)
    + f"""SELECT page_visit_id, domain, visitor_id, session_id, visit_start_time, visit_end_time,
  rank_from_start, rank_from_end, date_sub('second', visit_start_time, visit_end_time) AS visit_length, {FLAGS}
FROM seq""",
)
def page_sequence(spark, sf):
    pages = rows(spark, sf, "page_views").select("page_visit_id", "domain", "visitor_id", "session_id", "visit_start_time")
    return web.sequence_pages(pages, ["domain", "visitor_id", "session_id"]).withColumns(web.edge_flags())


@query(
    "daily_page_load",
    with_("page_views")
    + f""", day AS (
  SELECT *, lead(visit_start_time) OVER w AS visit_end_time, row_number() OVER w AS rank_from_start,
    row_number() OVER (PARTITION BY visitor_id, session_id ORDER BY visit_start_time DESC, page_visit_id DESC) AS rank_from_end
  FROM page_views WHERE CAST(visit_start_time AS DATE) = DATE '2024-01-16'
  WINDOW w AS (PARTITION BY visitor_id, session_id ORDER BY visit_start_time, page_visit_id))
SELECT page_visit_id, visitor_id, session_id, language, visit_start_time, visit_end_time, utm_campaign, utm_medium,
  utm_source, {FLAGS}, TIMESTAMP '2024-01-16 00:00:00' AS extract_date
FROM day""",
)
def daily_page_load(spark, sf):
    pages = rows(spark, sf, "page_views").select(
        "page_visit_id", "visitor_id", "session_id", "language", "visit_start_time", "utm_campaign", "utm_medium", "utm_source"
    )
    return web.daily_page_load(pages, RUN_DATE)


DELIVERIES = 4


@query(
    "pages_by_delivery",
    with_("page_views", then=SEQUENCED)
    + f""", first AS (SELECT visitor_id, min(visit_start_time) AS first_visit_time FROM page_views GROUP BY ALL)
SELECT page_visit_id, domain, seq.visitor_id, session_id, visit_start_time, visit_end_time, rank_from_start,
  CASE WHEN date_trunc('week', visit_start_time) = date_trunc('week', first_visit_time) THEN 'New' ELSE 'Returned' END AS flg_new_vs_returned,
  date_sub('second', visit_start_time, visit_end_time) AS visit_length, {FLAGS}
FROM seq LEFT JOIN first ON first.visitor_id = seq.visitor_id""",
)
def pages_by_delivery(spark, sf):
    # Every seventh event comes a delivery late and every fifth twice; the table must not show it.
    pages = rows(spark, sf, "page_views").select("page_visit_id", "domain", "visitor_id", "session_id", "visit_start_time")
    number, due = F.col("page_visit_id").cast("long"), F.floor((F.dayofmonth("visit_start_time") - 1) / 8)
    due = due + F.when(number % 7 == 0, 1).otherwise(0)
    path = f"{shared_folder(spark)}/waymark/{uuid.uuid4().hex}/page_state"
    for n in range(DELIVERIES + 1):
        arrives = (due == n) | ((number % 5 == 0) & (due + 1 == n))
        increments.load_pages(pages.filter(arrives), path, buckets=2)
    return increments.loaded_pages(spark, path, "week").drop("rank_from_end")


@query(
    "visitor_dim",
    with_("page_views")
    + """SELECT visitor_id, min(visit_start_time) AS first_visit_time, max(visit_start_time) AS most_recent_visit_time
FROM page_views GROUP BY ALL""",
)
def visitor_dim(spark, sf):
    return web.visitor_dimension(rows(spark, sf, "page_views"))


@query(
    "visitor_user_dim",
    with_("site_pages")
    + """SELECT anonymous_id AS visitor_id, user_id AS cloud_user_id, min(timestamp) AS first_visit_time,
  max(timestamp) AS most_recent_visit_time FROM site_pages GROUP BY ALL""",
)
def visitor_user_dim(spark, sf):
    pages = rows(spark, sf, "site_pages").withColumnsRenamed(
        {"anonymous_id": "visitor_id", "user_id": "cloud_user_id", "timestamp": "visit_start_time"}
    )
    return web.visitor_dimension(pages, ["visitor_id", "cloud_user_id"])


SESSIONS = """SELECT session_id, visitor_id, string_agg(DISTINCT language, ',' ORDER BY language) AS language,
  min(visit_start_time) AS visit_start_time, max(visit_start_time) AS visit_end_time,
  date_sub('minute', min(visit_start_time), max(visit_start_time)) AS tot_session_time_min,
  count(url) AS cnt_page_views, lower(string_agg(DISTINCT utm_source, ',' ORDER BY utm_source)) AS utm_source
FROM page_views GROUP BY session_id, visitor_id"""


@query("session_rollup", with_("page_views") + SESSIONS)
def session_rollup(spark, sf):
    return web.session_rollup(rows(spark, sf, "page_views"))


@query(
    "sessions_with_visitor",
    with_("page_views", then=f"sessions AS ({SESSIONS})")
    + """SELECT s.*, first_visit_time, most_recent_visit_time FROM sessions s LEFT JOIN (SELECT visitor_id, min(visit_start_time) AS first_visit_time,
  max(visit_start_time) AS most_recent_visit_time FROM page_views GROUP BY visitor_id) v ON v.visitor_id = s.visitor_id""",
)
def sessions_with_visitor(spark, sf):
    pages = rows(spark, sf, "page_views")
    return lay_out(pages, "page_views", ["visitor_id"], buckets=8, sort=["visit_start_time"]).apply(web.sessions_with_visitor)


@query(
    "session_conversions",
    with_("page_views", "forms", then=f"sessions AS ({SESSIONS})")
    + """, counts AS (
  SELECT session_id, visitor_id, count(*) AS cnt_inquiries,
    count(*) FILTER (WHERE form_id IN (3, 17, 40, 41)) AS cnt_cp_downloads,
    count(*) FILTER (WHERE form_id IN (5, 12, 60, 61, 62)) AS cnt_cloud_signup
  FROM forms GROUP BY ALL)
SELECT s.*, coalesce(cnt_inquiries, 0) AS cnt_inquiries, coalesce(cnt_cp_downloads, 0) AS cnt_cp_downloads,
  coalesce(cnt_cloud_signup, 0) AS cnt_cloud_signup
FROM sessions s LEFT JOIN counts c ON s.session_id = c.session_id AND s.visitor_id = c.visitor_id""",
)
def session_conversions(spark, sf):
    sessions = web.session_rollup(rows(spark, sf, "page_views"))
    return web.session_conversions(sessions, rows(spark, sf, "forms"), (5, 12, 60, 61, 62), (3, 17, 40, 41))


@query(
    "new_vs_returned",
    with_("page_views", "memberships")
    + """, visitors AS (SELECT org_id AS visitor_id, min(created_at) AS first_visit_time FROM memberships GROUP BY ALL)
SELECT page_visit_id, p.visitor_id, visit_start_time,
  CASE WHEN date_trunc('week', visit_start_time) = date_trunc('week', first_visit_time) THEN 'New'
       WHEN date_trunc('week', visit_start_time) > date_trunc('week', first_visit_time) THEN 'Returned'
       ELSE 'None' END AS flg_new_vs_returned
FROM page_views p LEFT JOIN visitors v ON p.visitor_id = v.visitor_id""",
)
def new_vs_returned(spark, sf):
    # Weeks, because the given events lie in one month.
    first = rows(spark, sf, "memberships").groupBy(F.col("org_id").alias("visitor_id")).agg(F.min("created_at").alias("first_visit_time"))
    pages = rows(spark, sf, "page_views").select("page_visit_id", "visitor_id", "visit_start_time")
    return web.new_or_returned(pages, first, "week")


CLEAN = "replace(CASE WHEN url LIKE '%?%' THEN replace(url, split(url, '?')[-1], '') ELSE url END, '?', '')"


def _section(i: int) -> str:
    piece = f"split(url_cleaned, '/')[{i + 2}]"
    fold = f"WHEN {piece} LIKE '%get-started%' OR {piece} LIKE '%download%' THEN '/get-started'" if i == 1 else ""
    return f"CASE WHEN coalesce({piece}, '') = '' OR {piece} LIKE '?%' THEN '/homepage' {fold} ELSE '/' || {piece} END AS url_section_{i}"


SECTIONS = ", ".join(_section(i) for i in (1, 2, 3))


@query(
    "url_clean_sections",
    f"""WITH cleaned AS (SELECT page_id, url, {CLEAN} AS url_cleaned FROM pages)
SELECT page_id, url, url_cleaned, split_part(url, '?', 1) AS url_no_query, {SECTIONS} FROM cleaned""",
)
def url_clean_sections(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return web.url_columns(pages).withColumn("url_no_query", text.url_without_query(F.col("url")))


@query(
    "url_sections_of_views",
    with_("page_views", then=f"cleaned AS (SELECT *, {CLEAN} AS url_cleaned FROM page_views)")
    + f"SELECT page_visit_id, url_cleaned, {SECTIONS} FROM cleaned",
)
def url_sections_of_views(spark, sf):
    pages = rows(spark, sf, "page_views").select("page_visit_id", "url")
    return web.url_columns(pages).drop("url")


# Invented spellings; the canonical value of each raw one.
SOURCE_SPELLINGS = [('["google","google"]', "google"), ("twitter.com", "twitter"), ("Facebook", "facebook")]
MEDIUM_SPELLINGS = [('["sem","sem"]', "sem"), ("e-mail", "email"), ("PaidSocial", "paidsocial")]


def _spellings(spark, pairs):
    return spark.createDataFrame(pairs, "raw string, canonical string")


def _values(pairs) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


def _canonical(column: str, pairs) -> str:
    return f"coalesce((SELECT c FROM (VALUES {_values(pairs)}) t(r, c) WHERE r = {column}), lower({column}))"


DERIVED = """CASE WHEN utm_campaign IS NULL AND (referrer LIKE '%www.google%' OR referrer LIKE '%www.bing%'
    OR referrer LIKE '%duckduckgo.com%' OR referrer LIKE '%baidu.com%') THEN 'organic_search'
  WHEN utm_campaign IS NULL AND referrer IS NULL THEN 'direct' ELSE lower(utm_medium) END"""
TAGGED = f"""tagged AS (
  SELECT page_visit_id, lower(utm_campaign) AS utm_campaign, referrer,
    {_canonical("utm_source", SOURCE_SPELLINGS)} AS utm_source, {_canonical("utm_medium", MEDIUM_SPELLINGS)} AS utm_medium
  FROM page_views)"""


@query(
    "utm_canonical",
    with_("page_views", then=TAGGED)
    + f"""SELECT page_visit_id, utm_campaign, utm_source, utm_medium,
  CASE WHEN utm_campaign IS NULL THEN 'null_value' ELSE 'not_null' END AS utm_campaign_status,
  {DERIVED} AS segment_utm_medium FROM tagged""",
)
def utm_canonical(spark, sf):
    pages = rows(spark, sf, "page_views").select("page_visit_id", "utm_campaign", "utm_source", "utm_medium", "referrer")
    pages = marketing.canonical_values(pages, "utm_source", _spellings(spark, SOURCE_SPELLINGS))
    pages = marketing.canonical_values(pages, "utm_medium", _spellings(spark, MEDIUM_SPELLINGS))
    return web.tag_columns(pages).drop("referrer")


LOWERED = "low AS (SELECT *, lower(utm_medium) AS m, lower(utm_source) AS s, lower(utm_campaign) AS c FROM all_events)"
TAG_SQL = {"medium": "m", "source": "s", "campaign": "c"}


@query(
    "channel_rules_v1",
    with_("all_events", then=LOWERED)
    + f"SELECT event_id, {rules_sql(rulesets.web_channel_rules(), 'No Referral', TAG_SQL)} AS channel_detail FROM low",
)
def channel_rules_v1(spark, sf):
    tagged = web.tag_columns(rows(spark, sf, "all_events"))
    out = web.channel_detail(tagged, rulesets.web_channel_rules(), rulesets.WEB_DEFAULT, web.TAG_FIELDS)
    return out.select("event_id", "channel_detail")


@query(
    "channel_rules_derived",
    with_("all_events", then=LOWERED + f", derived AS (SELECT * REPLACE ({DERIVED} AS m) FROM low)")
    + f"""SELECT event_id, {rules_sql(rulesets.web_channel_rules(direct_source="direct"), "No Referral", TAG_SQL)} AS channel_detail
FROM derived""",
)
def channel_rules_derived(spark, sf):
    tagged = web.tag_columns(rows(spark, sf, "all_events"))
    rules = rulesets.web_channel_rules(direct_source="direct")
    return web.channel_detail(tagged, rules, rulesets.WEB_DEFAULT, web.DERIVED_FIELDS).select("event_id", "channel_detail")


# Invented roll-up of some details; the rest are unmapped.
ROLL_UP = [
    ("Paid Social - Quora", "Paid Social", "Paid Media"),
    ("Display", "Display", "Paid Media"),
    ("Email", "Email", "Non Paid Web"),
    ("Other Referral", "Referral", "Non Paid Web"),
    ("Nurture - Lifecycle", "Nurture", "Nurture"),
]


@query(
    "channel_rollup",
    with_("all_events", then=LOWERED)
    + f""", detailed AS (SELECT event_id, {rules_sql(rulesets.web_channel_rules(), 'No Referral', TAG_SQL)} AS channel_detail FROM low)
SELECT event_id, channel_detail, coalesce(m.channel, channel_detail) AS channel,
  coalesce(m.channel_aggregate, channel_detail) AS channel_aggregate, coalesce(m.channel, 'channel_detail') AS published_channel
FROM detailed LEFT JOIN (VALUES {", ".join(str(r) for r in ROLL_UP)}) m(detail, channel, channel_aggregate) ON detail = channel_detail""",
)
def channel_rollup(spark, sf):
    detailed = channel_rules_v1(spark, sf)
    mapping = spark.createDataFrame(ROLL_UP, "detail string, channel string, channel_aggregate string")
    published = web.roll_up(detailed, mapping, parity=True)
    ours = web.roll_up(published.withColumnRenamed("channel", "published_channel").drop("channel_aggregate"), mapping)
    return ours.select("event_id", "channel_detail", "channel", "channel_aggregate", "published_channel")


def page_logs(spark, sf):
    pages = rows(spark, sf, "page_views")
    names = {c: c for c in pages.columns if c not in ("domain", "context_ip")}
    no_session = {k: v for k, v in names.items() if k != "session_id"}
    other = pages.withColumnsRenamed({"utm_campaign": "context_campaign_name", "utm_source": "context_campaign_source"})
    renamed = {**names, "utm_campaign": "context_campaign_name", "utm_source": "context_campaign_source"}
    return [
        web.PageLog(pages.filter("domain = 'www.example.com'"), names, "www.example.com"),
        web.PageLog(pages.filter("domain = 'docs.example.com'"), no_session, "docs.example.com"),
        web.PageLog(other.filter("domain = 'developer.example.com'"), renamed, "developer.example.com"),
    ]


@query(
    "source_union_dedupe",
    with_("page_views")
    + """, logs AS (SELECT * FROM page_views UNION ALL SELECT * FROM page_views WHERE domain = 'www.example.com')
SELECT DISTINCT page_visit_id, domain, visitor_id, CASE WHEN domain <> 'docs.example.com' THEN session_id END AS session_id,
  visit_start_time, url, utm_campaign FROM logs""",
)
def source_union_dedupe(spark, sf):
    logs = page_logs(spark, sf)
    twice = [*logs, logs[0]]
    harmonised = web.harmonise(twice).withColumn("loaded_at", F.rand())
    columns = ["page_visit_id", "domain", "visitor_id", "session_id", "visit_start_time", "url", "utm_campaign", "loaded_at"]
    return web.deduplicate(harmonised.select(*columns))


@query(
    "page_visit_fact",
    with_("page_views", then="pv2 AS (SELECT * REPLACE (CASE WHEN domain <> 'docs.example.com' THEN session_id END AS session_id) FROM page_views)")
    + f""", seq AS (
  SELECT *, lead(visit_start_time) OVER w AS visit_end_time, row_number() OVER w AS rank_from_start,
    row_number() OVER (PARTITION BY domain, visitor_id, session_id
                       ORDER BY visit_start_time DESC, page_visit_id DESC) AS rank_from_end,
    {CLEAN} AS url_cleaned, lower(utm_source) AS s, lower(utm_campaign) AS c, {DERIVED} AS m
  FROM pv2 WINDOW w AS (PARTITION BY domain, visitor_id, session_id ORDER BY visit_start_time, page_visit_id)),
detailed AS (SELECT *, {rules_sql(rulesets.web_channel_rules(direct_source="direct"), 'No Referral', TAG_SQL)} AS channel_detail FROM seq),
first AS (SELECT visitor_id, min(visit_start_time) AS first_visit_time FROM page_views GROUP BY ALL)
SELECT page_visit_id, domain, d.visitor_id, session_id, visit_start_time, visit_end_time,
  date_sub('second', visit_start_time, visit_end_time) AS visit_length, rank_from_start, url_cleaned, {SECTIONS},
  channel_detail,
  CASE WHEN channel_detail = 'Paid Gmail' THEN 'Display' WHEN channel_detail = 'No Referral' THEN 'No Referral'
       WHEN channel_detail LIKE '%Referral' THEN 'Referral' ELSE channel_detail END AS channel,
  CASE WHEN channel_detail LIKE '%Paid%' OR channel_detail = 'Display' THEN 'Paid Media'
       WHEN channel_detail LIKE 'Nurture%' THEN 'Nurture'
       WHEN channel_detail IN ('Direct', 'Email', 'Other Referral', 'Own website', 'DevX Referral', 'Partner Referral') THEN 'Non Paid Web'
       ELSE channel_detail END AS channel_aggregate,
  CASE WHEN date_trunc('week', visit_start_time) = date_trunc('week', first_visit_time) THEN 'New' ELSE 'Returned' END AS flg_new_vs_returned,
  {FLAGS}, TIMESTAMP '2024-01-16 00:00:00' AS extract_date
FROM detailed d LEFT JOIN first f ON d.visitor_id = f.visitor_id""",
)
def page_visit_fact(spark, sf):
    # The first log is loaded twice, which must not show.
    logs = page_logs(spark, sf)
    fact = web.page_visit_fact([*logs, logs[0]], web.visitor_dimension(web.harmonise(logs)), RUN_DATE, unit="week", stage=stage)
    return fact.select(
        "page_visit_id",
        "domain",
        "visitor_id",
        "session_id",
        "visit_start_time",
        "visit_end_time",
        "visit_length",
        "rank_from_start",
        "url_cleaned",
        "url_section_1",
        "url_section_2",
        "url_section_3",
        "channel_detail",
        "channel",
        "channel_aggregate",
        "flg_new_vs_returned",
        "is_entrance",
        "is_exit",
        "is_bounce",
        "extract_date",
    )


@query(
    "click_engagement",
    """SELECT CAST(user_id AS VARCHAR) || '-s' AS session_id, user_id AS visitor_id, user_id AS cloud_user_id, event_type AS component,
  event_type AS event, props AS event_text, event_id AS click_id, ts AS timestamp, 'https://x/' || user_id AS href_url,
  'top' AS location FROM events WHERE event_type = 'click'""",
)
def click_engagement(spark, sf):
    clicks = table(spark, sf, "events").filter("event_type = 'click'")
    raw = clicks.selectExpr(
        "CAST(user_id AS STRING) || '-s' AS s_id",
        "user_id AS anonymous_id",
        "user_id",
        "event_type AS component",
        "event_type AS event",
        "props AS event_text",
        "event_id AS id",
        "ts AS timestamp",
        "'https://x/' || CAST(user_id AS STRING) AS href_url",
        "'top' AS location",
        "value AS not_needed",
    )
    return web.click_engagement(raw)


@query(
    "experiment_exposure",
    """SELECT event_id AS experiment_id, event_type AS experiment_name, user_id AS anonymous_id, user_id AS campaign_id,
  event_type AS campaign_name, value > 10 AS is_in_campaign_holdback, event_id + 1 AS variation_id,
  props AS variation_name, ts AS timestamp FROM events WHERE event_type = 'view'""",
)
def experiment_exposure(spark, sf):
    raw = table(spark, sf, "events").filter("event_type = 'view'").selectExpr(
        "event_id AS experiment_id",
        "event_type AS experiment_name",
        "user_id AS anonymous_id",
        "user_id AS campaign_id",
        "event_type AS campaign_name",
        "value > 10 AS is_in_campaign_holdback",
        "event_id + 1 AS variation_id",
        "props AS variation_name",
        "ts AS timestamp",
        "value",
    )
    return web.experiment_exposure(raw)


def _abandoned_sql(minutes: int) -> str:
    return with_("all_events") + f"""SELECT f.event_id, f.user_id, f.ts, p.event_id AS page_visit_id
FROM (SELECT * FROM all_events WHERE event_type = 'error') f
LEFT JOIN (SELECT * FROM all_events WHERE event_type = 'view') p
  ON f.user_id = p.user_id AND f.session_id = p.session_id AND f.k % 2 = p.k % 2
 AND f.ts >= p.ts - INTERVAL {minutes} MINUTE AND f.ts <= p.ts + INTERVAL {minutes} MINUTE"""


def _abandoned(spark, sf, **limit):
    events = rows(spark, sf, "all_events").selectExpr("event_id", "user_id AS visitor_id", "session_id", "k % 2 AS url", "ts", "event_type")
    forms = events.filter("event_type = 'error'").drop("event_type").withColumnRenamed("ts", "timestamp")
    views = events.filter("event_type = 'view'").withColumnsRenamed({"ts": "visit_start_time", "event_id": "page_visit_id"})
    out = web.abandoned_form_pages(forms, views.drop("event_type"), **limit)
    return out.select("event_id", F.col("visitor_id").alias("user_id"), F.col("timestamp").alias("ts"), "page_visit_id")


@query("near_event_join", _abandoned_sql(240))
def near_event_join(spark, sf):
    # Four hours instead of two minutes: the given events are sparse.
    return _abandoned(spark, sf, minutes=240)


@query("abandoned_form_published", _abandoned_sql(2))
def abandoned_form_published(spark, sf):
    return _abandoned(spark, sf)


CTA = f"""cleaned AS (SELECT *, {CLEAN} AS url_cleaned FROM page_views),
prev AS (SELECT *, lag(url_cleaned) OVER (PARTITION BY visitor_id, session_id, context_ip
                                          ORDER BY visit_start_time, page_visit_id) AS previous_url FROM cleaned),
cta AS (
  SELECT url_cleaned FROM cleaned WHERE regexp_matches(url_cleaned, '/resources|/thank-you|/online-talk|/ebook|/white-paper|/demo|/report/')
  UNION SELECT previous_url FROM prev WHERE url_cleaned LIKE '%/thank-you%'),
listed AS (SELECT url_cleaned FROM cta WHERE url_cleaned IS NOT NULL AND url_cleaned NOT LIKE '%/thank-you%')"""


def _cleaned(spark, sf):
    # Both jobs read the written page table, and read it several times.
    pages = web.url_columns(rows(spark, sf, "page_views"))
    return stage(pages.select("page_visit_id", "visitor_id", "session_id", "context_ip", "visit_start_time", "url_cleaned"), "pages")


@query("cta_pages", with_("page_views", then=CTA) + "SELECT url_cleaned FROM listed")
def cta_pages(spark, sf):
    return web.cta_pages(_cleaned(spark, sf))


@query(
    "cta_flags",
    with_("page_views", then=CTA)
    + """SELECT page_visit_id, url_cleaned, url_cleaned LIKE '%/thank-you%' AS flg_page_thank_you,
  url_cleaned IN (SELECT url_cleaned FROM listed) AS flg_page_cta FROM cleaned""",
)
def cta_flags(spark, sf):
    pages = _cleaned(spark, sf)
    flagged = web.cta_flags(pages, web.cta_pages(pages))
    return flagged.select("page_visit_id", "url_cleaned", "flg_page_thank_you", "flg_page_cta")


@query(
    "locale_split",
    """SELECT doc_id, lang || '-' || upper(source) AS context_locale, substr(lang || '-' || upper(source), 1, 2) AS country,
  substr(lang || '-' || upper(source), 4, 5) AS language FROM documents""",
)
def locale_split(spark, sf):
    docs = table(spark, sf, "documents").selectExpr("doc_id", "lang || '-' || upper(source) AS context_locale")
    return docs.withColumns(text.locale_parts(F.col("context_locale")))


@query(
    "calendar_columns",
    with_("page_views")
    + """SELECT page_visit_id, CAST(date_trunc('week', CAST(visit_start_time AS DATE) + 1) AS DATE) - 1 AS visit_week,
  CAST(date_trunc('month', visit_start_time) AS DATE) AS visit_month, last_day(visit_start_time) AS visit_month_end,
  CAST(date_trunc('quarter', visit_start_time) AS DATE) AS visit_quarter FROM page_views""",
)
def calendar_columns(spark, sf):
    pages = rows(spark, sf, "page_views").select("page_visit_id", "visit_start_time")
    out = pages.withColumns(times.calendar(F.col("visit_start_time")))
    return out.withColumn("visit_quarter", times.quarter_start(F.col("visit_start_time"))).drop("visit_start_time")


@query(
    "nearest_events",
    with_("all_events")
    + """SELECT s.event_id, (SELECT max(v.ts) FROM all_events v WHERE v.user_id = s.user_id AND v.event_type = 'view' AND v.ts <= s.ts) AS previous_view,
  (SELECT min(v.ts) FROM all_events v WHERE v.user_id = s.user_id AND v.event_type = 'view' AND v.ts > s.ts) AS next_view
FROM all_events s WHERE s.event_type = 'signup'""",
)
def nearest_events(spark, sf):
    events = rows(spark, sf, "all_events").select("event_id", "user_id", "ts", "event_type")
    found = asof_neighbours(
        events.filter("event_type = 'signup'"),
        events.filter("event_type = 'view'"),
        ["user_id"],
        F.col("ts"),
        F.col("ts"),
        ["event_id"],
    )
    return found.select("event_id", F.col("prev.at").alias("previous_view"), F.col("next.at").alias("next_view"))
