"""Campaign touches: who is attributed, channel buckets, matched web visit, final channel."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.operators import asof_neighbours, first_match
from waymark.plans import rulesets
from waymark.plans.rulesets import DEFAULT, Vocabulary
from waymark.plans.web import channel_detail, roll_up
from waymark.sources.sinks import Stage, unstaged

PROSPECTING_DAYS = "PG Prospecting Days"


def child_campaigns(campaigns: DataFrame, parent_id) -> DataFrame:
    """Campaigns under one parent, the parent itself left out."""
    return campaigns.filter((F.col("parent_id") == F.lit(parent_id)) & (F.col("id") != F.lit(parent_id))).select("id").distinct()


def attributed_members(
    members: DataFrame, campaigns: DataFrame, leads: DataFrame, lead_bridge: DataFrame, excluded: DataFrame
) -> DataFrame:
    """Members already attributed through a lead: their own, or the one their contact came from."""
    kept = members.join(campaigns.select(F.col("id").alias("campaign_id")), "campaign_id").join(
        excluded.select(F.col("id").alias("campaign_id")), "campaign_id", "left_anti"
    )
    bridge = lead_bridge.select("lead_id").distinct()
    converted = (
        leads.dropna(subset=["converted_contact_id"])
        .select(F.col("converted_contact_id").alias("contact_id"), F.col("id").alias("lead_id"))
        .join(bridge, "lead_id", "left_semi")
        .select("contact_id")
        .distinct()
    )
    own = kept.filter("lead_id is not null").join(bridge, "lead_id", "left_semi")
    through = kept.filter("lead_id is null").join(converted, "contact_id", "left_semi")
    return own.select("id").unionByName(through.select("id")).distinct()


def interaction_time(created: Column, associated: Column, campaign_type: Column) -> Column:
    """The associated time when it is over a day off, or for prospecting days; else the creation time."""
    use_associated = (F.abs(F.datediff(created, associated)) > 1) | (campaign_type == PROSPECTING_DAYS)
    return F.date_trunc("minute", F.when(use_associated, associated).otherwise(created))


TOUCH_COLUMNS = [
    "campaign_id",
    "inquiry_id",
    "utm_campaign",
    "utm_medium",
    "utm_source",
    "campaign_name",
    "campaign_team",
    "campaign_theater",
    "interaction_time",
    "interaction_date",
    "lead_or_contact_id",
    "lead_created_date",
    "opportunity_id",
    "account_id",
    "action",
    "sfdc_campaign_type",
    "sfdc_campaign_function",
    "lead",
    "opp",
    "origin",
]


def touch_set(
    lead_touches: DataFrame,
    leads: DataFrame,
    opportunity_roles: DataFrame,
    members: DataFrame,
    campaigns: DataFrame,
    attributed: DataFrame,
    excluded: DataFrame,
    opportunities: DataFrame,
    contacts: DataFrame,
) -> DataFrame:
    """Touches of leads without an opportunity, of leads with one, and of pure contacts.

    ``lead_touches`` already has the touch columns. A lead without an opportunity takes
    those of the contact it became. A pure contact counts only with a role in an existing
    opportunity, whose account it takes; its creation date is null where the contact is unknown.
    """
    shared = [c for c in TOUCH_COLUMNS if c not in ("opportunity_id", "opp", "origin", "lead_or_contact_id")]
    roles = opportunity_roles.select("contact_id", F.col("opportunity_id").alias("__opportunity"))
    became = leads.select(F.col("id").alias("lead_id"), F.col("converted_contact_id").alias("contact_id"))
    without = (
        lead_touches.filter("opportunity_id is null")
        .drop("opportunity_id", "contact_id")
        .join(became, "lead_id", "left")
        .join(roles, "contact_id", "left")
        .select(
            *shared,
            F.col("lead_id").alias("lead_or_contact_id"),
            F.col("__opportunity").alias("opportunity_id"),
            F.when(F.col("__opportunity").isNotNull(), 1).otherwise(0).alias("opp"),
            F.lit("lead").alias("origin"),
        )
    )
    with_opportunity = lead_touches.filter("opportunity_id is not null").select(
        *shared, F.col("lead_id").alias("lead_or_contact_id"), "opportunity_id", "opp", F.lit("lead").alias("origin")
    )
    described = campaigns.select(
        F.col("id").alias("campaign_id"),
        "campaign_name",
        "campaign_team",
        "campaign_theater",
        F.col("campaign_type").alias("sfdc_campaign_type"),
        F.col("campaign_function").alias("sfdc_campaign_function"),
    )
    existing = opportunities.select(F.col("id").alias("__opportunity"), "account_id")
    known = contacts.select(F.col("id").alias("contact_id"), F.col("created_at").alias("lead_created_date"))
    # Roles are small beside members: their opportunity and contact are looked up before the log is joined.
    contact_roles = roles.join(existing, "__opportunity").join(known, "contact_id", "left")
    pure = (
        members.filter("contact_id is not null")
        .join(attributed.select("id"), "id", "left_anti")
        .join(excluded.select(F.col("id").alias("campaign_id")), "campaign_id", "left_anti")
        .join(described, "campaign_id")
        .join(contact_roles, "contact_id")
    )
    when = interaction_time(F.col("created_ts"), F.col("associated_ts"), F.col("sfdc_campaign_type"))
    contact_touches = pure.select(
        "campaign_id",
        F.col("id").alias("inquiry_id"),
        "utm_campaign",
        "utm_medium",
        "utm_source",
        "campaign_name",
        "campaign_team",
        "campaign_theater",
        when.alias("interaction_time"),
        when.cast("date").alias("interaction_date"),
        F.col("contact_id").alias("lead_or_contact_id"),
        "lead_created_date",
        F.col("__opportunity").alias("opportunity_id"),
        "account_id",
        F.col("status").alias("action"),
        "sfdc_campaign_type",
        "sfdc_campaign_function",
        F.lit(0).alias("lead"),
        F.lit(1).alias("opp"),
        F.lit("contact").alias("origin"),
    ).distinct()
    parts = [without, with_opportunity, contact_touches]
    return parts[0].select(*TOUCH_COLUMNS).unionByName(parts[1].select(*TOUCH_COLUMNS)).unionByName(parts[2])


def bucket_touches(touches: DataFrame, campaigns: DataFrame, excluded: DataFrame, v: Vocabulary = DEFAULT) -> DataFrame:
    """Channel, marketing group, web type and content of each touch; types never attributed are left out.

    ``campaigns`` adds ``campaign_format`` and ``tactic``.
    """
    described = campaigns.select(
        F.col("id").alias("campaign_id"), "campaign_type", F.lower("campaign_type").alias("campaign_type_lower"), "campaign_format", "tactic"
    )
    kept = touches.filter(
        ~F.col("sfdc_campaign_type").isin(*rulesets.TYPES_NOT_ATTRIBUTED)
        & ~F.col("campaign_name").startswith(v.excluded_name_prefix)
    ).join(excluded.select(F.col("id").alias("campaign_id")), "campaign_id", "left_anti")
    joined = kept.join(described, "campaign_id", "left").withColumn("campaign", F.lower("utm_campaign"))
    devx = F.col("campaign_name").isin(*v.devx_campaign_names)
    return joined.withColumns(
        {
            "channel": first_match(rulesets.campaign_channel_rules(v), "Organic"),
            "marketing_group": first_match(rulesets.marketing_group_rules(v), "Other Marketing Sourced"),
            "web_type": first_match(rulesets.web_type_rules(v), "Other"),
            "has_devx_content": F.when(devx, 1).otherwise(0),
            "web_content": F.when(devx, F.col("campaign_name")),
        }
    ).drop("campaign", "campaign_type_lower", "campaign_format", "campaign_type")


WEB_VISIT_FIELDS = {
    "campaign_name": "web_channel_campaign",
    "source": "web_channel_source",
    "marketing_group": "web_channel_marketing_group",
    "channel": "web_channel",
    "medium": "web_channel_medium",
    "tactic": "web_channel_tactic",
    "has_devx_content": "web_channel_devx",
}


def web_visits(touchpoints: DataFrame) -> DataFrame:
    """Touchpoints that count as a web visit, with their channel renamed where paid."""
    kept = touchpoints.filter(F.col("sfdc_campaign_type").isin("Email", "digital touch") | (F.col("channel") == "Email"))
    channel = (
        F.when((F.col("channel") == "gmail") & (F.col("marketing_group") == "Paid Media"), "Paid Email")
        .when(F.col("channel") == "Search Engine Marketing", "Paid Search")
        .otherwise(F.col("channel"))
    )
    return kept.withColumn("channel", channel)


def match_web_visit(touches: DataFrame, visits: DataFrame, minutes: int = 360) -> DataFrame:
    """The latest web visit of the same person strictly before each touch, within ``minutes``."""
    # The log holds everyone's visits: only those of touched people are sorted.
    theirs = visits.withColumnRenamed("lead_id", "lead_or_contact_id").join(
        touches.select("lead_or_contact_id").distinct(), "lead_or_contact_id", "left_semi"
    )
    found = asof_neighbours(
        touches,
        theirs,
        ["lead_or_contact_id"],
        F.col("interaction_time"),
        F.col("visit_time"),
        list(WEB_VISIT_FIELDS),
        right_order=list(WEB_VISIT_FIELDS),
        equal_is_before=False,
    )
    prev = F.col("prev")
    off = times.whole_units("MINUTE", prev.getField("at"), F.col("interaction_time"))
    near = off <= minutes
    return found.select(
        *touches.columns,
        *[F.when(near, prev.getField(src)).alias(name) for src, name in WEB_VISIT_FIELDS.items()],
        F.when(near, off).alias("min_diff"),
    )


def backfill_organic(matched: DataFrame) -> DataFrame:
    """Organic touches take the channel of their web visit, or its tactic when that is Other."""
    organic = F.col("channel") == "Organic"
    web = F.col("web_channel")
    channel = (
        F.when(~organic, F.col("channel"))
        .when(organic & (web == "Other"), F.col("web_channel_tactic"))
        .when(organic & web.isNotNull(), web)
        .when(organic, F.lit("Organic"))
        .otherwise(F.lit("Other"))
    )
    is_global = F.col("campaign_name").contains("enterprise-tal") | (F.col("marketing_group") == "Global Campaigns")
    return matched.withColumns({"channel": channel, "is_global_campaign": F.when(is_global, 1).otherwise(0)})


def group_tactics(df: DataFrame, v: Vocabulary = DEFAULT) -> DataFrame:
    """Tactic group and owning team."""
    return df.withColumns(
        {
            "tactic_grouping": first_match(rulesets.tactic_group_rules(v), rulesets.TACTIC_GROUP_DEFAULT),
            "tactic_team": first_match(rulesets.tactic_team_rules(v), rulesets.TACTIC_TEAM_DEFAULT),
        }
    )


TACTIC_FIELDS = {
    c: c
    for c in (
        "tactic",
        "campaign_name",
        "in_person_workshop",
        "utm_medium",
        "utm_source",
        "utm_campaign",
        "campaign",
        "web_channel",
        "web_channel_campaign",
        "web_channel_medium",
        "web_channel_source",
    )
}


def tactic_channels(df: DataFrame, v: Vocabulary = DEFAULT) -> DataFrame:
    """Final channel detail of a touch and its roll-up."""
    early = F.col("interaction_date") < F.lit(rulesets.IN_PERSON_WORKSHOP_BEFORE).cast("date")
    fields = df.drop("channel").withColumns(
        {"in_person_workshop": F.when(early, "yes").otherwise("no"), "campaign": F.lower("utm_campaign")}
    )
    detailed = channel_detail(fields, rulesets.tactic_channel_rules(v), rulesets.TACTIC_CHANNEL_DEFAULT, TACTIC_FIELDS)
    return roll_up(detailed.drop("in_person_workshop", "campaign"))


def campaign_attribution(
    touches: DataFrame,
    campaigns: DataFrame,
    excluded: DataFrame,
    touchpoints: DataFrame,
    v: Vocabulary = DEFAULT,
    stage: Stage = unstaged,
) -> DataFrame:
    """From touch set to final channel. Matching reads the bucketed touches twice; ``stage`` them."""
    bucketed = stage(bucket_touches(touches, campaigns, excluded, v), "bucketed")
    matched = match_web_visit(bucketed, web_visits(touchpoints))
    return tactic_channels(group_tactics(backfill_organic(matched), v), v)


def drill_down(
    report: DataFrame,
    filters: Sequence[Column],
    dimensions: Sequence[str],
    measures: dict[str, Column],
    order: Sequence[Column] = (),
) -> DataFrame:
    """A filtered report summed over chosen dimensions, in order."""
    df = report
    for f in filters:
        df = df.filter(f)
    return df.groupBy(*dimensions).agg(*[m.alias(n) for n, m in measures.items()]).orderBy(*(order or dimensions))


def in_week(day: str, sunday: dt.date) -> Column:
    """Rows of the week that starts on ``sunday``."""
    return (F.col(day) >= F.lit(sunday)) & (F.col(day) < F.lit(sunday + dt.timedelta(days=7)))
