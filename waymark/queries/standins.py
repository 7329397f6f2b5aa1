"""The given tables seen as page views, leads, campaigns and so on.

Each stand-in is a projection of one whole table, written once in SQL text that both
Spark and the checking engine read. Marketing fields are derived from the number in
``events.props`` so that every rule, including those for missing values, is met.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.sources.tables import read_table

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"

SESSION = "CASE WHEN k % 25 <> 24 THEN CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) END AS session_id"
URL = (
    "CASE WHEN k % 3 = 0 THEN 'www.example.com/go/' ELSE 'https://www.example.com/' END"
    " || CASE k % 9 WHEN 0 THEN 'resources/ebook/streams' WHEN 1 THEN 'thank-you' WHEN 2 THEN 'get-started'"
    " WHEN 3 THEN 'download/now' WHEN 4 THEN '' WHEN 5 THEN 'demo/intro/a/b' WHEN 6 THEN 'get-started-today/x'"
    " WHEN 7 THEN 'blog/post-' || CAST(k % 5 AS STRING) ELSE 'pricing/' END"
    " || CASE k % 4 WHEN 0 THEN '?utm=x&k=' || CAST(k AS STRING) WHEN 1 THEN '?a=1?b=' || CAST(k % 3 AS STRING)"
    " ELSE '' END AS url"
)
MEDIUM = (
    "CASE k % 11 WHEN 0 THEN 'PaidSocial' WHEN 1 THEN 'sem' WHEN 2 THEN 'display' WHEN 3 THEN 'ppc'"
    " WHEN 4 THEN 'nurtureemail' WHEN 5 THEN 'e-mail' WHEN 6 THEN 'gmail' WHEN 7 THEN 'partner-referral'"
    " WHEN 8 THEN 'referral' WHEN 9 THEN '[\"sem\",\"sem\"]' END AS utm_medium"
)
SOURCE = (
    "CASE k % 13 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'twitter.com' WHEN 2 THEN 'linkedin' WHEN 3 THEN 'google'"
    " WHEN 4 THEN 'Bing' WHEN 5 THEN '(direct)' WHEN 6 THEN 'aws' WHEN 7 THEN 'webiste' WHEN 8 THEN 'baidu'"
    " WHEN 9 THEN 'partner-x' WHEN 10 THEN '[\"google\",\"google\"]' WHEN 11 THEN 'ch.sem_\"x' END AS utm_source"
)
CAMPAIGN = (
    "CASE k % 8 WHEN 0 THEN 'ch.display_x' WHEN 1 THEN 'ch.quora.q1' WHEN 2 THEN 'tm.lifecycle.a'"
    " WHEN 3 THEN 'tm.campaigns.b' WHEN 4 THEN 'x.Type.Community' WHEN 5 THEN 'reduce-your-tco-2'"
    " WHEN 6 THEN 'spring' END AS utm_campaign"
)
REFERRER = (
    "CASE k % 7 WHEN 0 THEN 'https://www.google.com/' WHEN 1 THEN 'https://www.bing.com/'"
    " WHEN 2 THEN 'https://duckduckgo.com/?q=x' WHEN 3 THEN 'https://news.example.org/'"
    " WHEN 4 THEN 'https://docs.example.com/a' WHEN 5 THEN 'https://www.reddit.com/r/x' END AS referrer"
)
LOCALE = "CASE k % 4 WHEN 0 THEN 'en-US' WHEN 1 THEN 'de-DE' WHEN 2 THEN 'fr-FR' END AS language"
EMAIL = "'u' || CAST(user_id AS STRING) || '@mail.example.org' AS email"
ANONYMOUS = "'a' || CAST(user_id AS STRING) AS anonymous_id"
LEAD = "CASE WHEN k % 6 <> 5 THEN 'L' || CAST(user_id AS STRING) END AS lead_or_contact_id"
TAGS = [CAMPAIGN, MEDIUM, SOURCE, REFERRER]
CAMPAIGN_TYPE = (
    "CASE k % 9 WHEN 0 THEN 'Cloud Sign-Up' WHEN 1 THEN 'Platform Download' WHEN 2 THEN 'Online Collateral'"
    " WHEN 3 THEN 'Webinar - Recorded' WHEN 4 THEN 'Webinar - Live' WHEN 5 THEN 'Contact Us'"
    " WHEN 6 THEN 'Annual Summit' WHEN 7 THEN 'Community Download' END AS campaign_type"
)
CHANNEL_DETAIL = (
    "CASE k % 6 WHEN 0 THEN 'Display' WHEN 1 THEN 'Paid Gmail' WHEN 2 THEN 'Paid Search'"
    " WHEN 3 THEN 'Paid Social' WHEN 4 THEN 'Paid Video' ELSE 'Direct' END AS channel_detail"
)
CHANNEL_AGGREGATE = "CASE WHEN k % 6 = 5 THEN 'Non Paid Web' ELSE 'Paid Media' END AS channel_aggregate"


def later(days: str) -> str:
    """Midnight some days after the event, the same text for both engines."""
    return f"CAST(CAST(ts AS DATE) + CAST({days} AS INT) AS TIMESTAMP)"


@dataclass(frozen=True)
class StandIn:
    base: str
    select: tuple[str, ...]
    where: str | None = None
    group_by: str | None = None


STANDINS: dict[str, StandIn] = {
    "page_views": StandIn(
        "ev",
        (
            "CAST(event_id AS STRING) AS page_visit_id",
            "user_id AS visitor_id",
            SESSION,
            "ts AS visit_start_time",
            URL,
            LOCALE,
            *TAGS,
            "'10.0.0.' || CAST(user_id % 20 AS STRING) AS context_ip",
            "CASE event_type WHEN 'view' THEN 'www.example.com' WHEN 'click' THEN 'docs.example.com'"
            " ELSE 'developer.example.com' END AS domain",
        ),
        "event_type IN ('view', 'click', 'error')",
    ),
    "all_events": StandIn("ev", ("event_id", "ts", "user_id", "event_type", "value", "k", SESSION, *TAGS)),
    "identifies": StandIn(
        "ev",
        (EMAIL, ANONYMOUS, "'g' || CAST(user_id % 50 AS STRING) AS ga_cid", SESSION, "ts AS timestamp", *TAGS),
        "event_type = 'click'",
    ),
    "forms": StandIn(
        "ev",
        ("user_id AS visitor_id", SESSION, "k AS form_id", "ts AS timestamp", URL, "event_id"),
        "event_type = 'purchase'",
    ),
    "socials": StandIn("ev", ("user_id", ANONYMOUS, "ts AS timestamp", *TAGS), "event_type = 'error'"),
    "cloud_pages": StandIn("ev", ("user_id", ANONYMOUS, "ts AS timestamp", *TAGS), "event_type = 'view'"),
    "site_pages": StandIn(
        "ev", ("user_id", ANONYMOUS, "ts AS timestamp", URL, SESSION, *TAGS), "event_type IN ('view', 'click')"
    ),
    "users": StandIn(
        "customer",
        (
            "c_custkey AS id",
            "'u' || CAST(c_custkey AS STRING) || CASE WHEN c_mktsegment = 'MACHINERY' THEN '@service.example.com'"
            " ELSE '@mail.example.org' END AS email",
            "CASE WHEN c_nationkey % 3 <> 2 THEN CAST(DATE '2024-01-01' + CAST(c_custkey % 20 AS INT) AS TIMESTAMP) END"
            " AS created_at",
        ),
    ),
    "memberships": StandIn(
        "ev", ("user_id AS org_id", "user_id + k % 3 AS user_id", "ts AS created_at"), "event_type = 'signup'"
    ),
    "orgs": StandIn(
        "ev",
        (
            "user_id AS id",
            "max(ts) AS created_at",
            "min(k) < 20 AS is_customer",
            "CASE WHEN user_id % 7 = 6 THEN 'Sales-Led' ELSE 'Product-Led' END AS motion",
            "CASE WHEN user_id % 11 = 10 THEN max(ts) END AS deactivated_at",
        ),
        "event_type = 'signup'",
        "user_id",
    ),
    "milestones": StandIn(
        "ev",
        (
            "user_id AS org_id",
            "min(ts) AS signed_up_at",
            "min(CASE WHEN k % 3 = 0 THEN ts END) AS email_verified_at",
            "min(CASE WHEN k % 5 = 0 THEN ts END) AS cluster_created_at",
            "min(CASE WHEN k % 7 = 0 THEN ts END) AS usage_at",
            "min(CASE WHEN k % 11 = 0 THEN ts END) AS product_active_at",
            "min(CASE WHEN k % 13 = 0 THEN ts END) AS stage2_active_at",
            "min(CASE WHEN k % 9 = 0 THEN ts END) AS first_throughput_at",
        ),
        "event_type = 'signup'",
        "user_id",
    ),
    "leads": StandIn(
        "customer",
        (
            "'L' || CAST(c_custkey AS STRING) AS id",
            "'u' || CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING) || '@mail.example.org' AS email",
            "CASE WHEN c_nationkey % 10 = 9 THEN TRUE WHEN c_nationkey % 10 <> 8 THEN FALSE END AS is_deleted",
            "CAST(DATE '2023-12-01' + CAST(c_custkey % 60 AS INT) AS TIMESTAMP) AS created_at",
            "CASE WHEN c_custkey % 3 = 0 THEN 'C' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) * 2 AS STRING) END"
            " AS converted_contact_id",
            "c_name AS name",
            "c_mktsegment AS company",
            "CASE WHEN c_nationkey % 4 <> 3 THEN CAST(DATE '2023-12-05' + CAST(c_custkey % 9 AS INT) AS TIMESTAMP) END"
            " AS first_routed_at",
            "c_acctbal AS lsm_score",
            "CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS matched_acct_id",
            "CASE WHEN c_nationkey % 3 = 0 THEN c_nationkey END AS converted_acct_id",
            "c_mktsegment AS theater",
            "c_mktsegment AS area",
            "'lead region' AS region",
        ),
    ),
    "contacts": StandIn(
        "supplier",
        (
            "'C' || CAST(s_suppkey AS STRING) AS id",
            "'u' || CAST(s_suppkey AS STRING) || '@mail.example.org' AS email",
            "CASE WHEN s_nationkey % 10 = 9 THEN TRUE WHEN s_nationkey % 10 <> 8 THEN FALSE END AS is_deleted",
            "CAST(DATE '2023-11-01' + CAST(s_suppkey % 60 AS INT) AS TIMESTAMP) AS created_at",
            "s_nationkey AS account_id",
            "'contact theater' AS account_theater",
            "'contact area' AS area",
            "'contact region' AS region",
        ),
    ),
    "inquiries": StandIn(
        "ev",
        (
            "'M' || CAST(event_id AS STRING) AS campaign_member_id",
            LEAD,
            "ts AS inquiry_created_ts",
            CAMPAIGN_TYPE,
            CAMPAIGN,
            MEDIUM,
            SOURCE,
            "k",
        ),
        "event_type = 'purchase'",
    ),
    "funnel": StandIn(
        "ev",
        (
            "'M' || CAST(event_id AS STRING) AS campaign_member_id",
            LEAD,
            "ts AS inquiry_date_time",
            CAMPAIGN_TYPE,
            f"CASE WHEN k % 2 = 0 THEN {later('k % 12')} END AS mql_date_time",
            f"CASE WHEN k % 3 = 0 THEN {later('k % 20')} END AS sqm_date_time",
            f"CASE WHEN k % 5 = 0 THEN {later('k % 90')} END AS sao_date_time",
        ),
        "event_type = 'purchase'",
    ),
    "typed_inquiries": StandIn(
        "ev",
        ("'M' || CAST(event_id AS STRING) AS campaign_member_id", LEAD, "ts AS inquiry_date_time", CAMPAIGN_TYPE),
        "event_type IN ('purchase', 'signup')",
    ),
    "paid_funnel": StandIn(
        "ev",
        (
            "event_id AS campaign_member_id",
            "CASE WHEN k % 17 <> 16 THEN user_id END AS lead_or_contact_id",
            "CAST(ts AS DATE) AS inquiry_date",
            CHANNEL_DETAIL,
            CHANNEL_AGGREGATE,
            SOURCE,
            "CASE WHEN k % 4 <> 3 THEN 'camp-' || CAST(k % 4 AS STRING) END AS utm_campaign",
            "k % 2 = 0 AS is_net_new_lead",
            "k % 3 = 0 AS is_sqm",
            "CASE WHEN k % 10 <> 9 THEN k % 5 = 0 END AS is_mql",
            "k % 7 = 0 AS is_sql",
            "CASE WHEN k % 8 <> 7 THEN value END AS score_at_create",
            "CASE k % 7 WHEN 0 THEN 'Data Architect' WHEN 1 THEN 'Developer' WHEN 2 THEN 'Executive' WHEN 3 THEN 'Operator'"
            " WHEN 4 THEN 'Other_IT_Buyer' WHEN 5 THEN 'Other' END AS persona",
            CAMPAIGN_TYPE,
        ),
    ),
    "paid_credits": StandIn(
        "ev",
        (
            CHANNEL_DETAIL,
            CHANNEL_AGGREGATE,
            SOURCE,
            "CASE WHEN k % 4 <> 3 THEN 'camp-' || CAST(k % 4 AS STRING) END AS web_campaign_name",
            "CAST(ts AS DATE) AS inquiry_date",
            "value AS pg_new_arr_amount_credit",
            "value / 2 AS pg_new_arr_oppty_credit",
        ),
    ),
    "paid_signups": StandIn(
        "ev",
        (
            "user_id AS org_id",
            "ts AS signed_up_at",
            "CASE k % 5 WHEN 0 THEN 'Display' WHEN 1 THEN 'Paid Gmail' WHEN 2 THEN 'Paid Search' WHEN 3 THEN 'Paid Social'"
            " ELSE 'Other' END AS channel",
            CHANNEL_DETAIL,
            CHANNEL_AGGREGATE,
            "CASE WHEN k % 4 <> 3 THEN 'camp-' || CAST(k % 4 AS STRING) END AS web_campaign_name",
        ),
        "event_type = 'signup'",
    ),
    "spend": StandIn(
        "ev",
        (
            "event_id AS spend_id",
            "CAST(ts AS DATE) AS day",
            "CASE k % 4 WHEN 0 THEN 'SEM' WHEN 1 THEN 'Display' WHEN 2 THEN 'paid social' ELSE 'gmail' END AS channel_type",
            "CASE k % 3 WHEN 0 THEN 'Google' WHEN 1 THEN 'Facebook' ELSE 'Bing' END AS channel",
            "'camp-' || CAST(k % 4 AS STRING) AS adgroup",
            "k % 5 AS content",
            "k % 6 AS targeting",
            "value AS spend_usd",
        ),
        "event_type = 'click'",
    ),
    "tasks": StandIn(
        "ev",
        (
            "event_id",
            "CASE k % 4 WHEN 0 THEN 'Weekly [Call] back' WHEN 1 THEN 'Re: [Email] [In] hello' WHEN 2 THEN 'note' END AS subject",
            "CASE WHEN k % 2 = 0 THEN 'L' ELSE 'C' END || CAST(user_id AS STRING) AS who_id",
            "user_id AS owner_id",
            "ts AS activity_at",
            "CASE WHEN k % 3 = 0 THEN 'Inbound' ELSE 'Outbound' END AS tool_direction",
            "CASE WHEN k % 2 = 0 THEN 'Received Email' ELSE 'Sent Email' END AS tool_type",
        ),
        "event_type IN ('click', 'error')",
    ),
    "activities": StandIn(
        "ev",
        (
            "'L' || CAST(user_id AS STRING) AS lead_id",
            "CAST(NULL AS STRING) AS contact_id",
            "CASE k % 3 WHEN 0 THEN 'x [Call] y' WHEN 1 THEN 'Email received' ELSE 'note' END AS subject",
            "ts AS activity_at",
            "event_id AS owner_id",
            "'user ' || CAST(k % 10 AS STRING) AS user_name",
            "'manager ' || CAST(k % 3 AS STRING) AS manager_name",
            "CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS is_csdr",
        ),
        "event_type IN ('click', 'view')",
    ),
    "signup_leads": StandIn(
        "ev",
        ("user_id AS org_id", "'L' || CAST(user_id AS STRING) AS lead_or_contact_id", "max(ts) AS signed_up_at"),
        "event_type = 'signup'",
        "user_id",
    ),
    "promos": StandIn(
        "ev",
        (
            "event_id AS creator_id",
            "user_id AS org_id",
            "'P' || CAST(k % 20 AS STRING) AS promo_code",
            "CAST(k AS STRING) AS promo_code_id",
            "CASE WHEN k % 2 = 0 THEN 'Claimed' ELSE 'Open' END AS status",
            "ts AS promo_created_at",
        ),
        "event_type = 'error'",
    ),
    "promo_snapshots": StandIn(
        "ev",
        (
            "event_id AS id",
            "CAST(ts AS DATE) AS day",
            "'user ' || CAST(k AS STRING) AS name",
            "CASE k % 5 WHEN 0 THEN 'Inbound SDR' WHEN 2 THEN 'cSDR' WHEN 4 THEN 'Outbound SDR' ELSE 'Other' END AS role",
            "event_id + 1 AS manager_id",
        ),
    ),
    "campaigns": StandIn(
        "part",
        (
            "p_partkey AS id",
            "p_size AS parent_id",
            "CASE WHEN p_size % 9 = 0 THEN 'FCI ' ELSE '' END || p_name AS campaign_name",
            "CASE p_size % 8 WHEN 0 THEN 'Partner' WHEN 1 THEN 'Global Campaigns' WHEN 2 THEN 'Strategic Events'"
            " WHEN 3 THEN 'Field Marketing' WHEN 4 THEN 'Growth - Lifecycle' WHEN 5 THEN 'Growth - Digital'"
            " WHEN 6 THEN 'Corporate' END AS campaign_team",
            "CASE p_size % 12 WHEN 0 THEN 'Online Collateral' WHEN 1 THEN 'Webinar - Live' WHEN 2 THEN 'Tradeshow'"
            " WHEN 3 THEN 'Paid Search' WHEN 4 THEN 'Email Nurture' WHEN 5 THEN 'Digital ABM' WHEN 6 THEN 'Annual Summit'"
            " WHEN 7 THEN 'Cloud Sign-Up' WHEN 8 THEN 'Training' WHEN 9 THEN 'PG Prospecting Days'"
            " WHEN 10 THEN 'Content email' ELSE 'Contact Us' END AS campaign_type",
            "CASE p_size % 4 WHEN 0 THEN 'Virtual' WHEN 1 THEN 'In Person' WHEN 2 THEN 'Hybrid' END AS campaign_format",
            "CASE p_size % 10 WHEN 0 THEN 'Webinar' WHEN 1 THEN 'Cloud Sign-Up' WHEN 2 THEN 'Tradeshow' WHEN 3 THEN 'Forum'"
            " WHEN 4 THEN 'Paid Media' WHEN 5 THEN 'Online Collateral' WHEN 6 THEN 'Annual Summit' WHEN 7 THEN 'Workshop'"
            " WHEN 8 THEN 'Tech Talk' ELSE 'Other' END AS tactic",
            "CASE p_size % 6 WHEN 0 THEN 'Digital' WHEN 1 THEN 'Event' WHEN 2 THEN 'Field' WHEN 3 THEN 'Partner'"
            " ELSE 'Brand' END AS campaign_function",
            "DATE '2023-01-01' + CAST(p_size AS INT) AS start_date",
            "CASE p_size % 3 WHEN 0 THEN 'Americas' WHEN 1 THEN 'EMEA' END AS campaign_theater",
            "'region ' || CAST(p_size % 7 AS STRING) AS campaign_region",
            "p_retailprice AS actual_cost",
        ),
    ),
    "members": StandIn(
        "lineitem",
        (
            "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS id",
            "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-'"
            " || CAST(l_suppkey AS STRING) AS row_id",
            "l_partkey AS campaign_id",
            "CASE WHEN l_linenumber % 2 = 0 THEN 'L' || CAST(l_suppkey AS STRING) END AS lead_id",
            "CASE WHEN l_linenumber % 3 <> 0 THEN 'C' || CAST(l_suppkey AS STRING) END AS contact_id",
            "l_shipdate AS created_ts",
            "CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) % 4 AS TIMESTAMP) AS associated_ts",
            "CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN 'United States' WHEN 1 THEN 'South Korea' WHEN 2 THEN 'NATION_3'"
            " WHEN 3 THEN 'Elsewhere' END AS country",
            "CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 'APAC' WHEN 1 THEN 'EMEA' WHEN 2 THEN 'North America' END AS geo",
            "l_returnflag = 'A' AS priority_account",
            "l_returnflag AS status",
            "CASE CAST(floor(l_extendedprice) AS INT) % 6 WHEN 0 THEN 'sem' WHEN 1 THEN 'paidsocial' WHEN 2 THEN 'nurtureemail'"
            " WHEN 3 THEN 'email' WHEN 4 THEN 'gmail' END AS utm_medium",
            "CASE CAST(floor(l_extendedprice) AS INT) % 5 WHEN 0 THEN 'tm.lifecycle.a' WHEN 1 THEN 'tm.campaigns.b'"
            " WHEN 2 THEN 'Reduce-your-tco-x' WHEN 3 THEN 'ch.gmail.z' END AS utm_campaign",
            "CASE CAST(floor(l_extendedprice) AS INT) % 7 WHEN 0 THEN 'aws' WHEN 1 THEN 'webiste' WHEN 2 THEN 'google' END"
            " AS utm_source",
            "CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) % 3 AS TIMESTAMP) AS inquiry_date_time",
            "CASE WHEN l_linenumber % 4 <> 3 THEN 'match ' || CAST(l_linenumber AS STRING) END AS region_match",
            "l_returnflag = 'R' AS focus_account",
        ),
    ),
    "opportunities": StandIn(
        "nation",
        ("'OS' || CAST(n_nationkey AS STRING) AS id", "'A' || CAST(n_regionkey AS STRING) AS account_id"),
        "n_nationkey % 5 <> 4",
    ),
}


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up once; the tables are read-only."""
    found = read_table(spark, folder, name, _SCHEMAS.get((folder, name)))
    _SCHEMAS.setdefault((folder, name), found.schema)
    return found


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr("*", K)


def rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stand-in as a DataFrame."""
    s = STANDINS[name]
    df = ev(spark, folder) if s.base == "ev" else table(spark, folder, s.base)
    if s.where:
        df = df.filter(s.where)
    if s.group_by:
        return df.groupBy(s.group_by).agg(*[F.expr(e) for e in s.select]).drop(s.group_by)
    return df.selectExpr(*s.select)


def with_(*names: str, then: str = "") -> str:
    """``WITH`` clause that defines the named stand-ins for the checking SQL."""
    parts = [f"ev AS (SELECT *, {K} FROM events)"]
    for n in names:
        s = STANDINS[n]
        where = f" WHERE {s.where}" if s.where else ""
        group = f" GROUP BY {s.group_by}" if s.group_by else ""
        parts.append(f"{n} AS (SELECT {', '.join(s.select)} FROM {s.base}{where}{group})")
    return "WITH " + ",\n".join(parts) + (",\n" + then if then else "") + "\n"
