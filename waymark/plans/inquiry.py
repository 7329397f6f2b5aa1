"""Campaign members and the inquiry fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.functions.text import distinct_list
from waymark.operators import broadcast_if_small, interval_join, keep_first, lookup_join
from waymark.sources.sinks import Stage, stamp, unstaged

# Buckets of campaign functions and teams, and theatres by geography.
FUNCTIONS = ("Digital", "Event", "Field", "Partner")
STRATEGIC_TEAMS = ("Corporate", "Strategic Events")
TEAMS = (
    "Growth - Digital",
    "Field Marketing",
    "Partner",
    "Growth - Lifecycle",
    "Global Campaigns",
    "Revenue Marketing Cloud Partner",
)
AMERICAN_GEOS = ("North America", "Latin America & Caribbean")
NOT_MEMBER_TYPES = ("Email Nurture", "Ungated Content")


def member_base(
    members: DataFrame,
    campaigns: DataFrame,
    leads: DataFrame,
    contacts: DataFrame,
    theaters: DataFrame,
    excluded_prefix: str = "FCI",
    excluded_text: str = "Professional Active Users",
    stage: Stage = unstaged,
) -> DataFrame:
    """Campaign members with campaign and theatre, without deleted people and excluded campaigns.

    One row per member id. Members are moved by id only where ids repeat, and lists of
    deleted people and theatres are joined without moving members while they are short.
    The list of repeated ids is read several times: ``stage`` it.
    """
    function, team = F.col("campaign_function"), F.col("campaign_team")
    wanted = campaigns.filter(
        ~F.col("campaign_name").startswith(excluded_prefix)
        & ~F.col("campaign_name").contains(excluded_text)
        & ~F.col("campaign_type").isin(*NOT_MEMBER_TYPES)
    ).select(
        F.col("id").alias("campaign_id"),
        "campaign_name",
        "campaign_type",
        F.col("start_date").alias("campaign_start_date"),
        "campaign_theater",
        "campaign_region",
        "campaign_format",
        "tactic",
        "actual_cost",
        F.when(function.isin(*FUNCTIONS), function).otherwise("Other").alias("campaign_function"),
        F.when(team.isin(*STRATEGIC_TEAMS), "Strategic Events")
        .when(team.isin(*TEAMS), team)
        .otherwise("Other")
        .alias("campaign_team"),
    )
    # One row per campaign id, so that a member meets one; the same one that its own order would choose.
    wanted = keep_first(wanted, ["campaign_id"], [c for c in wanted.columns if c != "campaign_id"])

    def deleted(df: DataFrame, key: str) -> DataFrame:
        """Ids with deleted rows only; a missing flag is not deleted."""
        gone = df.groupBy(F.col("id").alias(key)).agg(F.bool_and(F.coalesce("is_deleted", F.lit(False))).alias("__gone"))
        return broadcast_if_small(gone.filter("__gone").select(key))

    # Of a country's theatres the first by name counts, and a missing one leaves it to the geography.
    per_country = theaters.groupBy("country").agg(
        F.min("theater").alias("__theater"), F.max(F.col("theater").isNull()).alias("__open")
    )
    mapped = F.col("__theater")
    by_geo = (
        F.when(F.col("geo").isin("APAC", "EMEA"), F.col("geo"))
        .when(F.col("geo").isin(*AMERICAN_GEOS), "Americas")
        .otherwise("Other")
    )
    theater = (
        F.when(F.col("country") == "United States", "Americas")
        .when(F.col("country").contains("Korea"), "APAC")
        .when(F.col("__open"), F.least(mapped, by_geo))
        .when(mapped.isNotNull(), mapped)
        .otherwise(by_geo)
    )
    known = (
        members.join(deleted(leads, "lead_id"), "lead_id", "left_anti")
        .join(deleted(contacts, "contact_id"), "contact_id", "left_anti")
        .join(broadcast_if_small(per_country), "country", "left")
        .select(
            F.col("id").alias("campaign_member_id"),
            "campaign_id",
            F.coalesce("lead_id", "contact_id").alias("lead_or_contact_id"),
            "lead_id",
            "contact_id",
            "created_ts",
            "inquiry_date_time",
            "country",
            "region_match",
            theater.alias("theater"),
            F.col("focus_account").alias("focused_account_lead"),
            F.when(F.col("priority_account"), 1).otherwise(0).alias("priority_account_lead"),
            "utm_medium",
            "utm_campaign",
            "utm_source",
        )
    )
    # Digests of member ids: two ids with one digest are ranked each for itself below.
    digests = members.groupBy(F.xxhash64("id").alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = broadcast_if_small(stage(digests.filter("__n > 1").select("__digest"), "repeated_members"))
    marked = known.withColumn("__digest", F.xxhash64("campaign_member_id"))
    often = marked.join(repeated, "__digest", "left_semi").join(wanted.select("campaign_id"), "campaign_id", "left_semi")
    order = ["created_ts", "campaign_id", "theater"]
    first = keep_first(often, ["campaign_member_id"], order + [c for c in known.columns if c not in order])
    once = marked.join(repeated, "__digest", "left_anti")
    return once.unionByName(first).join(wanted, "campaign_id").select(
        "campaign_member_id",
        "campaign_id",
        "campaign_name",
        "campaign_type",
        "campaign_start_date",
        "campaign_theater",
        "campaign_region",
        "campaign_format",
        "tactic",
        "actual_cost",
        "lead_or_contact_id",
        "lead_id",
        "contact_id",
        "created_ts",
        "inquiry_date_time",
        "country",
        "region_match",
        "theater",
        "campaign_function",
        "campaign_team",
        "focused_account_lead",
        "priority_account_lead",
        "utm_medium",
        "utm_campaign",
        "utm_source",
    )


def inquiries_of_day(inquiries: DataFrame, members: DataFrame, run_date: dt.date) -> DataFrame:
    """Inquiries created on ``run_date`` with the opportunity of their campaign member."""
    links = members.select(
        F.col("id").alias("campaign_member_id"),
        "opportunity_id",
        F.to_date("created_ts").alias("inquiry_created_date_utc"),
    )
    return inquiries.filter(times.on_day("inquiry_created_ts", run_date)).join(links, "campaign_member_id")


def latest_channel(attribution: DataFrame) -> DataFrame:
    """The most recent channel of each inquiry."""
    columns = ["inquiry_id", "channel", "action", "sfdc_campaign_type", "channel_aggregate", "channel_detail"]
    order = [F.col("interaction_date").desc_nulls_last(), *[F.col(c) for c in columns[1:]]]
    return keep_first(attribution, ["inquiry_id"], order).select(*columns)


def lead_scores(leads: DataFrame, parity: bool = False) -> DataFrame:
    """Score and whether the lead was routed.

    The published rule says Yes when the routing time is missing; ``parity`` keeps that.
    """
    routed = F.col("first_routed_at").isNull() if parity else F.col("first_routed_at").isNotNull()
    return leads.select(
        F.col("id").alias("lead_or_contact_id"),
        F.col("lsm_score").alias("lead_score"),
        F.col("first_routed_at").alias("lead_first_routed_at"),
        F.when(routed, "Yes").otherwise("No").alias("lead_routed"),
    )


def with_pipeline(inquiries: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Pipeline credit of the same inquiry, person and opportunity."""
    credit = pipeline.select(
        F.col("inquiry_id").alias("campaign_member_id"),
        F.coalesce("lead_id", "contact_id").alias("lead_or_contact_id"),
        "opportunity_id",
        F.col("pg_new_arr_amount_credit").alias("pg"),
        F.when(F.col("opp_new_arr") > 0, "Yes").otherwise("No").alias("pg_attributed_inquiry"),
    ).distinct()
    return inquiries.join(credit, ["campaign_member_id", "lead_or_contact_id", "opportunity_id"], "left")


def inquiry_sessions(inquiries: DataFrame, lead_map: DataFrame, identifies: DataFrame, minutes: int = 1440, day: dt.date | None = None) -> DataFrame:
    """Visitors and sessions seen within ``minutes`` of each inquiry, as ordered distinct lists.

    With ``day`` only that day's identifies are read, as the daily run does: one just past
    midnight is not matched, however near it is.
    """
    if day is not None:
        identifies = identifies.filter(times.on_day("timestamp", day))
    asked = inquiries.select("campaign_member_id", "lead_or_contact_id", "inquiry_created_ts")
    known = asked.join(lead_map.select("lead_or_contact_id", "anonymous_id").distinct(), "lead_or_contact_id")
    visitors = known.select("anonymous_id").distinct()
    seen = identifies.select("anonymous_id", "session_id", F.col("timestamp").alias("seen_at")).distinct()
    seen = seen.join(visitors, "anonymous_id", "left_semi")
    # A whole-minute distance of n admits up to just under n + 1 minutes.
    reach = (minutes + 1) * 60
    pairs = interval_join(
        seen,
        known,
        ["anonymous_id"],
        "seen_at",
        "inquiry_created_ts",
        before=reach,
        after=reach,
        matches=lambda seen_at, asked_at: F.abs(times.whole_units("MINUTE", seen_at, asked_at)) <= minutes,
    )
    ids = pairs.select("campaign_member_id", "anonymous_id", "session_id").distinct()
    return ids.groupBy("campaign_member_id").agg(
        distinct_list("anonymous_id").alias("anonymous_id"),
        distinct_list("session_id").alias("session_id"),
    )


def inquiry_fact(
    inquiries: DataFrame,
    members: DataFrame,
    attribution: DataFrame,
    leads: DataFrame,
    pipeline: DataFrame,
    lead_map: DataFrame,
    identifies: DataFrame,
    lead_orgs: DataFrame,
    milestones: DataFrame,
    run_date: dt.date,
    *,
    minutes: int = 1440,
    parity: bool = False,
) -> DataFrame:
    """One row per inquiry of the day with channel, score, credit, sessions, org and milestones.

    ``lead_orgs`` is the earliest org per lead; ``milestones`` has ``org_id``,
    ``first_throughput_at``, ``email_verified_at`` and ``product_active_at``.
    """
    day = inquiries_of_day(inquiries, members, run_date)
    ids = day.select(F.col("campaign_member_id").alias("inquiry_id")).distinct()
    # Ranked and made distinct for the day's inquiries only.
    channels = latest_channel(attribution.join(ids, "inquiry_id", "left_semi"))
    channels = channels.withColumnRenamed("inquiry_id", "campaign_member_id").drop("action")
    stages = milestones.select(
        "org_id", F.col("first_throughput_at").alias("oa_status"), "email_verified_at", "product_active_at"
    )
    fact = (
        with_pipeline(day, pipeline.join(ids, "inquiry_id", "left_semi"))
        .join(channels, "campaign_member_id", "left")
        .join(lead_scores(leads, parity), "lead_or_contact_id", "left")
        .join(inquiry_sessions(day, lead_map, identifies, minutes, run_date), "campaign_member_id", "left")
    )
    with_org = lookup_join(fact, lead_orgs, ["lead_or_contact_id"], row_id=["campaign_member_id"], hot_from=day)
    return stamp(with_org.join(stages, "org_id", "left"), run_date)
