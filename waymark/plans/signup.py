"""Signup attribution: cohort, touches, last and linear touch, blending and diagnosis."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.functions.marketing import any_present
from waymark.functions.text import contains_any
from waymark.operators import asof_neighbours, full_merge, interval_join, keep_first, lookup_join, sequence
from waymark.plans import rulesets
from waymark.plans.identity import first_user_per_org
from waymark.plans.web import channel_detail, roll_up
from waymark.sources.sinks import Stage, unstaged

# Sources that are the company's own pages or say nothing.
UNKNOWN_FIELDS = ("unknown", "(unknown)", "webchat")
TOUCH_FIELDS = ["utm_campaign", "utm_medium", "utm_source", "referrer"]
NO_TOUCH = "No Referral"


def org_cohort(orgs: DataFrame, users: DataFrame, memberships: DataFrame, quarter: dt.date) -> DataFrame:
    """Product-led customer orgs created in one quarter, with their first user."""
    end = dt.date(quarter.year + (quarter.month > 9), (quarter.month + 2) % 12 + 1, 1)
    created = F.col("created_at")
    led = orgs.filter(
        F.col("is_customer")
        & (F.col("motion") == "Product-Led")
        & (created >= F.lit(quarter).cast("timestamp"))
        & (created < F.lit(end).cast("timestamp"))
    ).select(F.col("id").alias("org_id"), "created_at")
    first = first_user_per_org(users, memberships.join(led.select("org_id"), "org_id", "left_semi")).select(
        "org_id", F.col("user_id").alias("first_user_id"), "email"
    )
    return led.join(first, "org_id", "left")


def cohort_touches(touches: DataFrame, key: str, cohort: DataFrame, cohort_key: str, since: dt.date) -> DataFrame:
    """Touches of cohort members after a date."""
    members = cohort.select(F.col(cohort_key).alias(key)).distinct()
    return touches.filter(F.col("timestamp") >= F.lit(since).cast("timestamp")).join(members, key, "left_semi").distinct()


def _within(at: str, events: DataFrame, event_at: str, hours_before: int, hours_after: int) -> Column:
    """Whether ``at`` lies so many hours around the time from the first to the last of ``events``."""
    first, last = (events.agg(f(event_at)).scalar() for f in (F.min, F.max))
    return (F.col(at) >= first - F.make_dt_interval(hours=F.lit(hours_before))) & (
        F.col(at) <= last + F.make_dt_interval(hours=F.lit(hours_after))
    )


def _nearest(cohort: DataFrame, touches: DataFrame, key: str, hours_off: int | None, out: str, payload: list[str]) -> DataFrame:
    """Per org a struct ``out``: the touch nearest to ``created_at``, within ``hours_off`` whole hours if given."""
    people = cohort.select("org_id", "created_at", F.col("first_user_id").alias("user_id"), "email").dropna(subset=[key])
    if hours_off is not None:
        # A touch further from every signup than the limit is nobody's nearest; this reaches the scan.
        touches = touches.filter(_within("timestamp", people, "created_at", hours_off + 1, hours_off + 1))
    # The logs hold everyone's touches: only the cohort's are sorted, and only the columns picked later.
    theirs = touches.select(key, "timestamp", *payload).join(people.select(key).distinct(), key, "left_semi")
    found = asof_neighbours(
        people.select("org_id", "created_at", key),
        theirs,
        [key],
        F.col("created_at"),
        F.col("timestamp"),
        payload,
        right_order=payload,
    )

    def usable(touch: str) -> Column:
        at = F.col(touch).getField("at")
        if hours_off is None:
            return at.isNotNull()
        return F.abs(times.whole_units("HOUR", at, F.col("created_at"))) <= hours_off

    def micros(touch: str) -> Column:
        return F.abs(F.unix_micros("created_at") - F.unix_micros(F.col(touch).getField("at")))

    prev_ok, next_ok = F.coalesce(usable("prev"), F.lit(False)), F.coalesce(usable("next"), F.lit(False))
    nearer = F.when(prev_ok & (~next_ok | (micros("prev") <= micros("next"))), F.col("prev")).when(next_ok, F.col("next"))
    return found.select("org_id", nearer.alias(out))


def signup_touch(
    cohort: DataFrame,
    identifies: DataFrame,
    socials: DataFrame,
    cloud_pages: DataFrame,
    *,
    hours_off: int = 2,
    eligible_first: bool = False,
) -> DataFrame:
    """The nearest touch of each cohort org, its fields taken by source precedence.

    Identify events (by e-mail) and cloud pages (by user) count within ``hours_off`` hours
    of the signup, social signups (by user) at any time. Each source contributes its
    nearest touch; the product of all touches of an org is never formed. An org whose
    nearest touch has no marketing field is dropped; with ``eligible_first`` touches
    without such fields are left out before.
    """
    def eligible(df: DataFrame) -> DataFrame:
        return df.filter(any_present(*TOUCH_FIELDS)) if eligible_first else df

    fields = [*TOUCH_FIELDS, "anonymous_id"]
    found = cohort
    for source in (
        _nearest(cohort, eligible(identifies), "email", hours_off, "i", [*fields, "ga_cid", "session_id"]),
        _nearest(cohort, eligible(socials), "user_id", None, "s", fields),
        _nearest(cohort, eligible(cloud_pages), "user_id", hours_off, "c", fields),
    ):
        found = found.join(source, "org_id", "left")

    def pick(field: str) -> Column:
        return F.coalesce(*[F.col(s).getField(field) for s in ("i", "s", "c")])

    touch_at = F.coalesce(F.col("i").getField("at"), F.col("s").getField("at"))
    return found.select(
        *cohort.columns,
        pick("anonymous_id").alias("anonymous_id"),
        F.col("c").getField("anonymous_id").alias("cloud_anonymous_id"),
        F.when(F.col("s").getField("anonymous_id").isNotNull(), "social signup")
        .when(F.col("i").getField("anonymous_id").isNotNull(), "direct")
        .alias("flg_social_signup"),
        F.col("i").getField("ga_cid").alias("ga_cid"),
        F.col("i").getField("session_id").alias("session_id"),
        touch_at.alias("touch_at"),
        F.col("c").getField("at").alias("cloud_at"),
        *[pick(f).alias(f) for f in TOUCH_FIELDS],
        times.whole_units("MINUTE", touch_at, F.col("created_at")).alias("delta_signup_touch_min"),
    ).filter(any_present(*TOUCH_FIELDS))


def touch_coverage(touches: DataFrame, own_sites: tuple[str, ...] = rulesets.DEFAULT.own_sites) -> DataFrame:
    """Distinct orgs, and how many have tags or a usable referrer, tags or any referrer, and a visitor id."""
    usable = F.when(~contains_any(F.col("referrer"), list(own_sites)), F.col("referrer"))
    tags = [F.col(f) for f in TOUCH_FIELDS[:3]]
    conditions = {
        "orgs": F.lit(True),
        "orgs_tag_or_usable_referrer": F.coalesce(*tags, usable).isNotNull(),
        "orgs_tag_or_referrer": F.coalesce(*tags, F.col("referrer")).isNotNull(),
        "orgs_with_visitor": F.col("anonymous_id").isNotNull(),
    }
    flags = touches.dropna(subset=["org_id"]).groupBy("org_id").agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()]
    )
    return flags.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in conditions])


def lookback_pages(signups: DataFrame, pages: DataFrame, days: int = 30) -> DataFrame:
    """Pages a signup's visitor saw before it, at most ``days`` whole days back.

    Signups carry ``org_id``, ``created_at``, ``anonymous_id`` and ``cloud_at``. A signup
    whose cloud page lies within the limit keeps its earlier pages of any age, and one row
    without a page if there are none.
    """
    views = pages.select("anonymous_id", F.col("timestamp").alias("page_at"), "url", F.col("session_id").alias("page_session_id"))
    created, page_at = F.col("created_at"), F.col("page_at")
    by_cloud = F.coalesce(times.whole_units("DAY", F.col("cloud_at"), created) <= days, F.lit(False))
    recent = interval_join(
        views.join(signups.select("anonymous_id").distinct(), "anonymous_id", "left_semi"),
        signups.filter(~by_cloud),
        ["anonymous_id"],
        "page_at",
        "created_at",
        before=0,
        after=(days + 1) * 86400,
        matches=lambda page, signup: (page < signup) & (times.whole_units("DAY", page, signup) <= days),
    )
    clouded = signups.filter(by_cloud)
    seen = views.join(clouded.select("anonymous_id").distinct(), "anonymous_id", "left_semi")
    any_age = lookup_join(seen, clouded, ["anonymous_id"], "inner").filter(page_at < created)
    names = [*signups.columns, "page_at", "url", "page_session_id"]
    matched = recent.select(*names).unionByName(any_age.select(*names))
    first_seen = seen.groupBy("anonymous_id").agg(F.min("page_at").alias("first_page_at"))
    earliest = clouded.select("org_id", "anonymous_id", "created_at").join(first_seen, "anonymous_id").filter("first_page_at < created_at")
    bare = clouded.join(earliest.select("org_id").distinct(), "org_id", "left_anti")
    every = matched.unionByName(bare, allowMissingColumns=True)
    return every.withColumns(
        {
            "delta_signup_page_day": times.whole_units("DAY", page_at, created),
            "delta_signup_page_hour": times.whole_units("HOUR", page_at, created),
            "delta_signup_page_second": times.whole_units("SECOND", page_at, created),
            "delta_signup_cloud_hour": times.whole_units("HOUR", F.col("cloud_at"), created),
        }
    )


def last_page_before_signup(lookback: DataFrame, hours_back: int = 6) -> DataFrame:
    """Of the look-back pages, the latest within ``hours_back`` hours, one per org."""
    recent = (F.col("delta_signup_page_hour") <= hours_back) | (F.col("delta_signup_cloud_hour") <= hours_back)
    order = [F.col("delta_signup_page_second").asc_nulls_last(), F.col("page_at").desc_nulls_last(), F.col("url")]
    return keep_first(lookback.filter(recent), ["org_id"], order)


def last_touch(conversions: DataFrame, touches: DataFrame, key: str, days: int, payload: list[str]) -> DataFrame:
    """The latest touch strictly before each conversion, at most ``days`` whole days back.

    An as-of lookup: linear in both tables, with no pair of conversion and touch formed.
    """
    # Only touches of converting keys can be the last one, and only so long before the first conversion.
    recent_enough = touches.filter(_within("touched_at", conversions, "converted_at", (days + 1) * 24, 0))
    theirs = recent_enough.join(conversions.select(key).distinct(), key, "left_semi")
    found = asof_neighbours(
        conversions,
        theirs,
        [key],
        F.col("converted_at"),
        F.col("touched_at"),
        payload,
        right_order=[payload[0]],
        equal_is_before=False,
    )
    at = F.col("prev").getField("at")
    recent = times.whole_units("DAY", at, F.col("converted_at")) <= days
    return found.select(
        *conversions.columns,
        F.when(recent, at).alias("touched_at"),
        *[F.when(recent, F.col("prev").getField(c)).alias(c) for c in payload],
    )


def _known(column: str, nothing: tuple[str, ...]) -> Column:
    low = F.lower(column)
    return F.when(~low.isin(*nothing), low)


def web_touch(last_pages: DataFrame, v: rulesets.Vocabulary = rulesets.DEFAULT) -> DataFrame:
    """Tags of the last web touch; the main site, the product and the chat count as none."""
    return last_pages.select(
        "org_id",
        F.col("created_at").alias("seg_created_at"),
        F.col("utm_medium").alias("seg_medium"),
        _known("utm_source", v.no_touch_sources).alias("seg_source"),
        F.col("utm_campaign").alias("seg_campaign"),
        "referrer",
        "anonymous_id",
    )


def inquiry_touch(inquiries: DataFrame, v: rulesets.Vocabulary = rulesets.DEFAULT) -> DataFrame:
    """Tags of the signup inquiry; own and unknown values count as none."""
    nothing = v.no_touch_sources + UNKNOWN_FIELDS
    return inquiries.select(
        "org_id",
        F.col("created_at").alias("inquiry_org_created_at"),
        "inquiry_created_at",
        _known("utm_medium", nothing).alias("inquiry_medium"),
        _known("utm_source", nothing).alias("inquiry_source"),
        F.lower("utm_campaign").alias("inquiry_campaign"),
    )


def analytics_touch(sessions: DataFrame, hours_back: int = 6) -> DataFrame:
    """The latest analytics session of each org within ``hours_back`` hours of the signup."""
    recent = sessions.filter(F.col("delta_signup_session_hour") <= hours_back)
    latest = keep_first(recent, ["org_id"], [F.col("delta_signup_session_second").asc_nulls_last(), "session_id"])
    return latest.select(
        "org_id",
        F.col("created_at").alias("ga_created_at"),
        F.col("medium").alias("ga_medium"),
        F.col("source").alias("ga_source"),
        F.col("campaign").alias("ga_campaign"),
        "ga_client_id",
        F.col("session_id").alias("ga_session_id"),
    )


def blend(inquiry: DataFrame, web: DataFrame, analytics: DataFrame, v: rulesets.Vocabulary = rulesets.DEFAULT) -> DataFrame:
    """One row per org from all three sources, fields by precedence web, inquiry, analytics."""
    joined = full_merge(full_merge(inquiry, web, ["org_id"]), analytics, ["org_id"])
    combined = {
        f"combined_{f}": F.lower(F.coalesce(f"seg_{f}", f"inquiry_{f}", f"ga_{f}")) for f in ("medium", "source", "campaign")
    }
    own = contains_any(F.col("referrer"), list(v.own_sites))
    return joined.withColumns(
        {
            **combined,
            "referrer": F.when(own, F.lit(rulesets.NA_REFERRER)).otherwise(F.col("referrer")),
            "created_at": F.coalesce("inquiry_org_created_at", "seg_created_at", "ga_created_at"),
        }
    )


BLEND_FIELDS = {
    "medium": "combined_medium",
    "source": "combined_source",
    "campaign": "combined_campaign",
    "referrer": "referrer",
    "anonymous_id": "anonymous_id",
}


def last_touch_report(blended: DataFrame, mapping: DataFrame | None = None, v: rulesets.Vocabulary = rulesets.DEFAULT) -> DataFrame:
    """Blended touches with channel detail, channel and channel aggregate."""
    return roll_up(channel_detail(blended, rulesets.signup_channel_rules(v), NO_TOUCH, BLEND_FIELDS), mapping)


CHANNEL_COLUMNS = ["channel_detail", "channel", "channel_aggregate"]


LINEAR_FIELDS = ["channel_source", "channel_medium", "channel_campaign", "session_id", "ga_client_id", "url", "hostname"]
NULL_FIELDS = ("session_id", "ga_client_id", "url", "hostname")


def linear_touches(web_touches: DataFrame, last_touches: DataFrame, hours_before: int = 6) -> DataFrame:
    """Web touches before the signup and the last touch, each with an equal share of one credit.

    Only web touches more than ``hours_before`` whole hours before the signup
    (``delta_signup_touch_hour``) take part; later ones are the last touch's. A touch is a
    client, session and page with its channel, however often it was seen. The number of
    touches comes from :func:`sequence`, so an org with very many touches is not gathered
    in one task.
    """
    shared = ["org_id", "created_at", *CHANNEL_COLUMNS]
    earlier = web_touches.filter(F.col("delta_signup_touch_hour") > hours_before)
    web = earlier.select(*shared, F.lit("30d_web").alias("attr_source"), *LINEAR_FIELDS).distinct()
    last = last_touches.select(
        *shared,
        F.lit("signup_last_touch").alias("attr_source"),
        "channel_source",
        "channel_medium",
        "channel_campaign",
        *[F.lit(f"Null_{c}").alias(c) for c in NULL_FIELDS],
    )
    # Touches have no order of their own; a hash gives them one.
    every = web.unionByName(last).withColumn("__part", F.xxhash64("attr_source", *CHANNEL_COLUMNS, *LINEAR_FIELDS))
    counted = sequence(every, ["org_id"], ["__part"], rank="__rank", total="num_channel").drop("__rank", "__part")
    return counted.withColumn("linear_credit", F.lit(1.0) / F.col("num_channel"))


def credit_on_activation(touches: DataFrame, funnel: DataFrame, *, stage: Stage = unstaged) -> DataFrame:
    """Linear credit of every signup, and the same credit only for orgs that became active.

    A signup without touches has one row with full credit and no referral. ``touches`` are
    read three times: pass a ``stage`` where they come from a long plan.
    """
    touches = stage(touches, "touches")
    signed = F.col("signed_up_at")
    stages = funnel.filter(signed.isNotNull()).select(
        "org_id",
        "signed_up_at",
        F.when(times.within_days_of(F.col("usage_at"), signed, 7), F.col("usage_at")).alias("onboarding_activated_7d"),
        F.when(times.within_days_of(F.col("product_active_at"), signed, 14), F.col("product_active_at")).alias(
            "production_activation_14d"
        ),
    )
    # A full join with a skewed side, in two parts: touches with their org, orgs without touches.
    with_org = lookup_join(touches, stages, ["org_id"])
    without = stages.join(touches.select("org_id").distinct(), "org_id", "left_anti")
    every = with_org.unionByName(without, allowMissingColumns=True)
    credit = F.coalesce("linear_credit", F.lit(1.0))
    return every.withColumns(
        {
            "created_at": F.coalesce("signed_up_at", "created_at"),
            **{c: F.coalesce(c, F.lit(NO_TOUCH)) for c in CHANNEL_COLUMNS},
            "linear_credit": credit,
            "linear_credit_oa": F.when(F.col("onboarding_activated_7d").isNotNull(), credit),
            "linear_credit_pao": F.when(F.col("production_activation_14d").isNotNull(), credit),
        }
    ).drop("signed_up_at")


RECONCILE_KEYS = ["org_id", "ga_client_id", "session_id", "url", "hostname"]


def reconcile_attributions(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Two attributions side by side on five keys, the channel from the first that has one."""
    theirs = theirs.withColumnRenamed("channel_detail", "channel_detail_ga")
    other = theirs.select(*RECONCILE_KEYS, "channel_detail_ga").distinct()
    other = other.withColumn("org_id_ga", F.col("org_id"))
    mine = ours.withColumnRenamed("channel_detail", "channel_detail_lt")
    merged = full_merge(mine, other, RECONCILE_KEYS)
    return merged.withColumn("channel_detail_grouped", F.coalesce("channel_detail_lt", "channel_detail_ga"))


def channel_mix(attribution: DataFrame, cohort: DataFrame | None = None) -> DataFrame:
    """Distinct orgs, of the cohort if one is given, per channel, most frequent first."""
    named = attribution.select("org_id", "channel_detail").distinct()
    if cohort is not None:
        named = named.join(cohort.select("org_id").distinct(), "org_id", "left_semi")
    return (
        named.groupBy("channel_detail")
        .agg(F.count("org_id").alias("orgs"))
        .orderBy(F.col("orgs").desc(), F.col("channel_detail").asc_nulls_first())
    )


def no_referral_leads(attribution: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Leads that ended up without a referral, of signups on or after ``since`` if given."""
    lost = attribution.filter(F.col("channel_aggregate") == NO_TOUCH)
    if since is not None:
        lost = lost.filter(F.col("signed_up_at") >= F.lit(since).cast("timestamp"))
    return lost.select("lead_or_contact_id").distinct()


def unattributed_touches(touches: DataFrame, attribution: DataFrame, since: dt.date, fields: list[str]) -> DataFrame:
    """Touches that do carry tags, of leads that ended up without a referral."""
    leads = no_referral_leads(attribution, since)
    return touches.filter(any_present(*fields)).join(leads, "lead_or_contact_id", "left_semi")


EVIDENCE_TAGS = ["utm_campaign", "utm_medium", "utm_source"]


def no_referral_evidence(
    logs: Mapping[str, DataFrame],
    lead_map: DataFrame,
    attribution: DataFrame,
    since: dt.date,
    tagged: Sequence[str] = ("page",),
) -> DataFrame:
    """What the visitors of leads without a referral left in the logs, one row per entry and lead.

    ``logs`` are entries by name (anonymous_id, session_id, timestamp, tags; a missing column
    is null), ``lead_map`` gives the leads and e-mails of a visitor. Of the logs in ``tagged``
    only entries with a tag count. Entries without a visitor match nothing.
    """
    wanted = (
        lead_map.join(no_referral_leads(attribution, since), "lead_or_contact_id", "left_semi")
        .select("anonymous_id", "email", "lead_or_contact_id")
        .dropna(subset=["anonymous_id"])
        .distinct()
    )
    parts = []
    for name, log in logs.items():
        have = [F.col(c) if c in log.columns else F.lit(None).cast("string").alias(c) for c in ("session_id", *EVIDENCE_TAGS)]
        part = log.select(F.lit(name).alias("log"), "anonymous_id", F.col("timestamp").alias("visit_time"), *have)
        parts.append(part.filter(any_present(*EVIDENCE_TAGS)) if name in tagged else part)
    return reduce(DataFrame.unionByName, parts).join(wanted, "anonymous_id")


def no_referral_members(
    members: DataFrame, campaigns: DataFrame, attribution: DataFrame, since: dt.date, prefix: str, but: Sequence[str] = ()
) -> DataFrame:
    """Tagged members of campaigns whose name starts with ``prefix``, of leads without a referral."""
    named = campaigns.filter(F.col("campaign_name").startswith(prefix) & ~F.col("campaign_name").isin(*but))
    theirs = members.filter(F.col("lead_id").isNotNull() & any_present(*EVIDENCE_TAGS))
    lost = no_referral_leads(attribution, since).withColumnRenamed("lead_or_contact_id", "lead_id")
    return theirs.join(lost, "lead_id", "left_semi").join(
        named.select(F.col("id").alias("campaign_id"), "campaign_name"), "campaign_id"
    )


def _visits_of_lost(visits: DataFrame, attribution: DataFrame | None, since: dt.date | None) -> DataFrame:
    """Tagged visits, after ``since`` and of leads without a referral where these are given."""
    kept = visits.filter(F.col("medium").isNotNull())
    if since is not None:
        kept = kept.filter(F.col("visit_time") > F.lit(since).cast("timestamp"))
    if attribution is not None:
        kept = kept.join(no_referral_leads(attribution, since), "lead_or_contact_id", "left_semi")
    return kept


def web_visit_matches(
    visits: DataFrame,
    people: DataFrame,
    signups: DataFrame,
    minutes: int = 360,
    attribution: DataFrame | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Each tagged visit with each signup of its lead's e-mail at most ``minutes`` whole minutes after it.

    A visit after the signup counts too (``min_diff`` is negative). ``attribution`` keeps leads
    without a referral, ``since`` later visits and signups only.
    """
    named = people.select(F.col("id").alias("lead_or_contact_id"), "email").dropna().distinct()
    off = times.whole_units("MINUTE", F.col("visit_time"), F.col("signed_up_at"))
    pairs = _visits_of_lost(visits, attribution, since).join(named, "lead_or_contact_id")
    pairs = pairs.join(signups.select("org_id", "email", "signed_up_at"), "email")
    return pairs.withColumn("min_diff", off).filter(F.col("min_diff") <= minutes)


def leads_with_web_visit(
    visits: DataFrame,
    people: DataFrame,
    signups: DataFrame,
    minutes: int = 360,
    attribution: DataFrame | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """The leads of :func:`web_visit_matches`, without forming its rows.

    As a later visit counts too, comparing with the earliest signup per e-mail decides it.
    """
    earliest = signups.dropna(subset=["email"]).groupBy("email").agg(F.min("signed_up_at").alias("first_signed_up_at"))
    named = people.select(F.col("id").alias("lead_or_contact_id"), "email").join(earliest, "email")
    named = named.groupBy("lead_or_contact_id").agg(F.min("first_signed_up_at").alias("first_signed_up_at"))
    kept = _visits_of_lost(visits, attribution, since)
    seen = kept.groupBy("lead_or_contact_id").agg(F.max("visit_time").alias("last_visit"))
    off = times.whole_units("MINUTE", F.col("last_visit"), F.col("first_signed_up_at"))
    return seen.join(named, "lead_or_contact_id").filter(off <= minutes).select("lead_or_contact_id")
