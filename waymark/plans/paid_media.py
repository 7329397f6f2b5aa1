"""Paid-media performance: spend with pipeline credit, inbound funnel and signups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.operators import broadcast_if_small, conditional_distinct_counts, distinct_states, full_merge, lookup_join
from waymark.plans.rulesets import DEFAULT, Vocabulary
from waymark.sources.sinks import Stage, unstaged

# Channel names of the spend table, score bands and personas.
CHANNEL_TYPES = {"Display": "display", "Paid Gmail": "gmail", "Paid Search": "sem", "Paid Social": "Paid Social"}
GOOGLE_CHANNELS = ("Display", "Paid Gmail")
SOCIAL_SITES = ("facebook", "linkedin", "twitter")
SEARCH_SITES = ("bing", "google")
HIGH_SCORE = 90
MEDIUM_SCORE = 62
PERSONA_PARTS = {"architect": "Arch", "developer": "Dev", "executive": "Exec"}
PERSONAS = {"operator": "Operator", "other_it_buyer": "Other_IT_Buyer", "other": "Other"}
PAID = "Paid Media"


def _mapped(column: Column, names: Mapping[str, str], default: str) -> Column:
    out = F
    for raw, name in names.items():
        out = out.when(column == raw, name)
    return out.otherwise(default)


def credit_by_day(credits: DataFrame, since: dt.date) -> DataFrame:
    """Pipeline credit per paid channel, campaign and inquiry day."""
    detail = F.col("channel_detail")
    kept = credits.filter(
        (F.col("channel_aggregate") == PAID)
        & F.col("web_campaign_name").isNotNull()
        & (F.col("inquiry_date") >= F.lit(since))
    )
    channel = (
        F.when(detail.isin(*GOOGLE_CHANNELS), "google")
        .when(detail.isin("Paid Search", "Paid Social"), F.lower("source"))
        .otherwise("other")
    )
    return kept.groupBy(
        _mapped(detail, CHANNEL_TYPES, "other").alias("mapping_channel_type"),
        channel.alias("mapping_channel"),
        "inquiry_date",
        "web_campaign_name",
    ).agg(
        F.sum("pg_new_arr_amount_credit").alias("pg_new_arr_amount_credit"),
        F.sum("pg_new_arr_oppty_credit").alias("pg_new_arr_oppty_credit"),
    )


def funnel_conditions(v: Vocabulary = DEFAULT) -> dict[str, Column]:
    """The conditions under which a person counts in each column of the inbound funnel."""
    score, persona, kind = F.col("score_at_create"), F.col("persona"), F.col("campaign_type")
    types = {
        "online_collateral": "Online Collateral",
        "webinar_recorded": "Webinar - Recorded",
        "webinar_live": "Webinar - Live",
        "platform_download": v.platform_download,
        "summit": v.summit,
        "contact_us": "Contact Us",
    }
    return {
        "leads_or_contacts_touched": F.lit(True),
        "net_new_leads": F.col("is_net_new_lead"),
        "sales_qualified_meetings": F.col("is_sqm"),
        "marketing_qualified_leads": F.col("is_mql"),
        "sales_qualified_leads": F.col("is_sql"),
        "high_score_leads": score >= HIGH_SCORE,
        "medium_score_leads": (score >= MEDIUM_SCORE) & (score < HIGH_SCORE),
        "low_score_leads": score < MEDIUM_SCORE,
        "missing_score_leads": score.isNull(),
        **{name: persona.contains(part) for name, part in PERSONA_PARTS.items()},
        **{name: persona == value for name, value in PERSONAS.items()},
        "unknown": persona.isNull(),
        **{name: kind == value for name, value in types.items()},
    }


FUNNEL_KEYS = ["mapping_channel_type", "mapping_channel", "inquiry_date", "utm_campaign"]


def funnel_rows(funnel: DataFrame, since: dt.date) -> DataFrame:
    """Rows of the paid funnel from ``since`` on, with the channel names of spend."""
    detail, source = F.col("channel_detail"), F.lower("utm_source")
    channel = F
    for site in SOCIAL_SITES:
        channel = channel.when((detail == "Paid Social") & source.contains(site), site)
    channel = channel.when(detail.isin(*GOOGLE_CHANNELS), "google")
    for site in SEARCH_SITES:
        channel = channel.when((detail == "Paid Search") & source.contains(site), site)
    kept = funnel.filter((F.col("channel_aggregate") == PAID) & (F.col("inquiry_date") >= F.lit(since)))
    return kept.withColumns(
        {"mapping_channel_type": _mapped(detail, CHANNEL_TYPES, "other"), "mapping_channel": channel.otherwise("other")}
    )


def funnel_states(funnel: DataFrame, since: dt.date, v: Vocabulary = DEFAULT, stage: Stage = unstaged) -> DataFrame:
    """The people behind each count of the funnel as bitmaps, for :func:`distinct_roll_up` to any dimensions."""
    return distinct_states(funnel_rows(funnel, since), FUNNEL_KEYS, "lead_or_contact_id", funnel_conditions(v), stage)


def inbound_funnel(funnel: DataFrame, since: dt.date, v: Vocabulary = DEFAULT) -> DataFrame:
    """23 distinct counts per paid channel, campaign and inquiry day.

    All but one count the same person id, so they come from two plain aggregations;
    inquiries count another id and get their own.
    """
    kept = funnel_rows(funnel, since)
    people = conditional_distinct_counts(kept, FUNNEL_KEYS, "lead_or_contact_id", funnel_conditions(v))
    inquiries = (
        kept.select(*FUNNEL_KEYS, "campaign_member_id")
        .distinct()
        .groupBy(*FUNNEL_KEYS)
        .agg(F.count("campaign_member_id").alias("inquiries"))
    )
    # Both sides are grouped by the same keys; utm_campaign may be null in both.
    right = inquiries.withColumnsRenamed({k: f"__{k}" for k in FUNNEL_KEYS})
    on = F.lit(True)
    for k in FUNNEL_KEYS:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return people.join(right, on).drop(*[f"__{k}" for k in FUNNEL_KEYS])


def signup_milestones(attribution: DataFrame, funnel: DataFrame) -> DataFrame:
    """Paid signups and how many reached each product milestone, per channel, campaign and day."""
    channel, detail = F.col("channel"), F.col("channel_detail")
    stages = {
        "email_verified": "email_verified_at",
        "cluster_created": "cluster_created_at",
        "ob_activated": "usage_at",
        "product_activated": "product_active_at",
    }
    joined = attribution.filter(F.col("channel_aggregate") == PAID).join(
        funnel.select("org_id", *stages.values()), "org_id", "left"
    )
    return joined.groupBy(
        F.to_date("signed_up_at").alias("sign_up_date"),
        _mapped(channel, CHANNEL_TYPES, "other").alias("mapping_channel_type"),
        F.when(detail.isin("Display", "Paid Search"), "Google").otherwise(detail).alias("source"),
        F.col("web_campaign_name").alias("utm_campaign"),
    ).agg(
        F.count("org_id").alias("cloud_signups"),
        *[F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).alias(n) for n, c in stages.items()],
    )


def _keyed(df: DataFrame, kind: str, channel: str, day: str, campaign: str) -> DataFrame:
    return df.select(
        F.lower(kind).alias("__type"),
        F.lower(channel).alias("__channel"),
        F.col(day).alias("day"),
        F.col(campaign).alias("adgroup"),
        *[c for c in df.columns if c not in (kind, channel, day, campaign)],
    )


def paid_performance(
    spend: DataFrame,
    credit: DataFrame,
    inbound: DataFrame,
    signups: DataFrame,
    contents: DataFrame,
    targetings: DataFrame,
) -> DataFrame:
    """Daily spend with credit, funnel, signups and names; channels match in any case.

    The three aggregates share their keys and are merged first, so the spend rows are
    shuffled once, with keys of very many rows spread.
    """
    keys = ["__type", "__channel", "day", "adgroup"]
    results = _keyed(credit, "mapping_channel_type", "mapping_channel", "inquiry_date", "web_campaign_name")
    for other in (
        _keyed(inbound, "mapping_channel_type", "mapping_channel", "inquiry_date", "utm_campaign"),
        _keyed(signups, "mapping_channel_type", "source", "sign_up_date", "utm_campaign"),
    ):
        results = full_merge(results, other, keys)
    named = contents.select(F.col("content_code").alias("content"), "content_name", "content_type").distinct()
    targeted = targetings.select(F.col("targeting_code").alias("targeting"), "targeting_name").distinct()
    spent = spend.withColumns({"__type": F.lower("channel_type"), "__channel": F.lower("channel")})
    return (
        lookup_join(spent, results, keys)
        .join(broadcast_if_small(named), "content", "left")
        .join(broadcast_if_small(targeted), "targeting", "left")
        .withColumn("quarter", F.date_trunc("quarter", "day").cast("date"))
        .drop("__type", "__channel")
    )
