"""Sales-assist credit: tasks, activities, promo codes and assisted signups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.operators import interval_join, keep_first, lookup_join, sequence
from waymark.plans.identity import as_of_day, with_manager

# Task subjects, roles and day limits.
INBOUND_MAIL = "[Email] [In]"
CALL = "[Call]"
CAPTURED_MAIL = "Received Email"
ROLES = ("Inbound SDR", "Outbound SDR", "cSDR")
CLOUD_ROLE = "cSDR"
MAIL_DAYS = 30
CALL_DAYS = 15


def task_log(tasks: DataFrame, since: dt.date) -> DataFrame:
    """Inbound mails and calls logged by hand, and inbound mails captured by the mail tool."""
    recent = tasks.filter(F.col("activity_at") >= F.lit(since).cast("timestamp"))
    columns = ["who_id", "owner_id", "activity_at"]
    logged = recent.filter(F.col("subject").contains(INBOUND_MAIL) | F.col("subject").contains(CALL))
    captured = recent.filter((F.col("tool_direction") == "Inbound") & (F.col("tool_type") == CAPTURED_MAIL))
    return logged.select("subject", *columns).unionByName(captured.select(F.col("tool_type").alias("subject"), *columns))


def _named(known: DataFrame, managers: DataFrame | None) -> DataFrame:
    return known if managers is None else with_manager(known.drop("manager_name"), managers)


def enrich_activities(
    tasks: DataFrame,
    snapshots: DataFrame,
    leads: DataFrame,
    contacts: DataFrame,
    people: DataFrame,
    cloud_owners: Collection = (),
    cloud_from: dt.date = dt.date(1970, 1, 1),
    cloud_until: dt.date = dt.date(9999, 12, 31),
    managers: DataFrame | None = None,
) -> DataFrame:
    """Tasks of eligible roles with owner, manager, lead or contact, and geography.

    ``managers`` (``sdr_name``, ``manager_name``) is a fixed list that names the managers
    instead of the snapshot.

    The role is that of the owner on the day of the task; ``cloud_owners`` count as cloud
    representatives between two dates. ``who_id`` may name a lead, a contact, or a
    contact that came from a lead.
    """
    known = _named(as_of_day(tasks, snapshots, "owner_id", "activity_at"), managers)
    role = F.col("role")
    if cloud_owners:
        overridden = F.to_date("activity_at").between(F.lit(cloud_from), F.lit(cloud_until)) & F.col("owner_id").isin(*cloud_owners)
        role = F.when(overridden, CLOUD_ROLE).otherwise(role)
    eligible = known.filter(F.col("role").isin(*ROLES)).withColumn("task_owner_role", role).drop("role")
    as_lead = leads.select(F.col("id").alias("who_id"), F.col("id").alias("__lead"))
    from_lead = leads.dropna(subset=["converted_contact_id"]).select(
        F.col("converted_contact_id").alias("who_id"), F.col("id").alias("__origin"), "converted_contact_id"
    )
    as_contact = contacts.select(F.col("id").alias("who_id"), F.col("id").alias("contact_id"))
    places = people.select(F.col("id").alias("who_id"), "theater", "region", "subregion")
    # Everything known of a person is put together first, so the tasks are joined once, and a
    # person with very many tasks, or a missing one, is spread over sub-keys.
    sides = (as_lead, from_lead, as_contact, places)
    persons = reduce(lambda a, b: a.unionByName(b), [side.select("who_id") for side in sides]).dropna().distinct()
    for side in sides:
        persons = persons.join(side, "who_id", "left")
    joined = lookup_join(eligible, persons, ["who_id"], hot_from=tasks)
    return joined.select(
        "subject",
        F.coalesce("__lead", "__origin").alias("lead_id"),
        "converted_contact_id",
        "contact_id",
        "who_id",
        "activity_at",
        "owner_id",
        "task_owner_role",
        "user_name",
        "manager_name",
        "theater",
        "region",
        "subregion",
        F.when(F.col("task_owner_role") == CLOUD_ROLE, 1).otherwise(0).alias("is_csdr"),
    )


def org_signups(orgs: DataFrame, users: DataFrame, memberships: DataFrame) -> DataFrame:
    """Customer orgs with every user who joined them; without a user's signup time the org's creation counts.

    An org without users has one row, without user and e-mail.
    """
    joined = memberships.select("org_id", "user_id").join(
        users.select(F.col("id").alias("user_id"), "email", F.col("created_at").alias("__signed_up")), "user_id"
    )
    led = orgs.filter("is_customer").select(F.col("id").alias("org_id"), F.col("created_at").alias("__created"))
    signed = F.coalesce("__signed_up", "__created").alias("signed_up_at")
    return led.join(joined, "org_id", "left").select("org_id", "user_id", "email", signed).distinct()


def signup_leads(signups: DataFrame, people: DataFrame) -> DataFrame:
    """Signups with the leads of their (merged) e-mail created at most a day after; one per org and lead.

    The day difference is cut toward zero, so a lead up to just under two days later counts.
    """
    named = people.withColumnRenamed("id", "__person").withColumnRenamed("email", "merged_email")
    joined = signups.join(named, "merged_email").withColumn(
        "lead_or_contact_id", F.coalesce("master_lead_id", "__person")
    )
    early = times.whole_units("DAY", F.col("lead_create_ts"), F.col("signed_up_at")) >= -1
    order = ["signed_up_at", "lead_create_ts", "__person", "signup_email", "origin"]
    return keep_first(joined.filter(early), ["org_id", "lead_or_contact_id"], order).drop("__person")


def qualifying_pairs(signups: DataFrame, activities: DataFrame, call_days: int = CALL_DAYS, mail_days: int = MAIL_DAYS) -> DataFrame:
    """Signups with the mails and calls to their lead in the days before."""
    acted = activities.withColumn("lead_or_contact_id", F.coalesce("lead_id", "contact_id")).select(
        "lead_or_contact_id", "subject", "activity_at", "owner_id", "user_name", "manager_name", "is_csdr"
    )
    def matches(at: Column, signed: Column) -> Column:
        days = F.datediff(signed, at)
        mail = F.lower("subject").contains("email") & (days <= mail_days)
        call = F.col("subject").contains(CALL) & (days <= call_days)
        return (at < signed) & (mail | call)

    return interval_join(
        acted,
        signups,
        ["lead_or_contact_id"],
        "activity_at",
        "signed_up_at",
        before=0,
        after=(max(call_days, mail_days) + 1) * 86400,
        matches=matches,
    )


def first_activity(pairs: DataFrame) -> DataFrame:
    """The first qualifying activity per org."""
    return keep_first(pairs, ["org_id"], ["activity_at", "owner_id", "lead_or_contact_id", "subject"])


def first_promo(
    promos: DataFrame,
    snapshots: DataFrame,
    excluded_ids: Sequence[str] = (),
    excluded_codes: Sequence[str] = (),
    managers: DataFrame | None = None,
) -> DataFrame:
    """The first claimed promo code per org that an eligible representative created.

    ``managers`` as in :func:`enrich_activities`.
    """
    claimed = promos.filter(F.col("status") == "Claimed")
    if excluded_ids:
        claimed = claimed.filter(~F.col("promo_code_id").isin(*excluded_ids))
    if excluded_codes:
        claimed = claimed.filter(~F.col("promo_code").isin(*excluded_codes))
    named = _named(as_of_day(claimed, snapshots, "creator_id", "promo_created_at"), managers)
    owned = named.filter(F.col("role").isin(*ROLES))
    return keep_first(owned, ["org_id"], ["promo_created_at", "creator_id", "promo_code"]).select(
        "org_id",
        "promo_code",
        "promo_created_at",
        F.col("creator_id").alias("promo_owner"),
        F.col("user_name").alias("promo_user"),
        F.col("manager_name").alias("promo_manager"),
    )


def _resolve(null_safe: bool) -> dict[str, Column]:
    promo, act = F.to_date("promo_created_at"), F.to_date("activity_at")
    by_promo = promo <= act
    if null_safe:
        by_promo = by_promo | (promo.isNotNull() & act.isNull())

    def pick(a: Column, b: Column) -> Column:
        return F.when(by_promo, a).otherwise(b)

    has_activity = F.when(F.col("activity_at").isNotNull(), F.lit("activity"))
    return {
        "first_act_date": pick(promo, act),
        "assist_user": pick(F.col("promo_user"), F.col("user_name")),
        "assist_manager": pick(F.col("promo_manager"), F.col("manager_name")),
        "assist_owner": pick(F.col("promo_owner"), F.col("owner_id")),
        "assisted_orig": pick(F.lit("promo_code"), has_activity),
    }


RESOLVED = ["first_act_date", "assist_user", "assist_manager", "assist_owner", "assisted_orig"]
ACTIVITY = ["org_id", "activity_at", "owner_id", "user_name", "manager_name", "is_csdr"]


def earliest_assist(signups: DataFrame, promos: DataFrame, activities: DataFrame, null_safe: bool = False) -> DataFrame:
    """Each org's first signup with the earlier of its first promo and first activity.

    As published, an org with a promo but no activity gets no assist; ``null_safe`` gives
    it to the promo.
    """
    first = keep_first(signups, ["org_id"], ["signed_up_at", "lead_or_contact_id"])
    joined = first.join(promos, "org_id", "left").join(activities.select(*ACTIVITY), "org_id", "left")
    return joined.withColumns(_resolve(null_safe)).select(
        "org_id", "lead_or_contact_id", F.col("signed_up_at").alias("first_org_signup_at"), "is_csdr", *RESOLVED
    )


def all_assists(signups: DataFrame, promos: DataFrame, pairs: DataFrame, null_safe: bool = False) -> DataFrame:
    """As :func:`earliest_assist`, but one row per org, lead and qualifying activity."""
    acts = pairs.select(*ACTIVITY, "lead_or_contact_id")
    joined = lookup_join(signups, promos, ["org_id"], row_id=["lead_or_contact_id"]).join(
        acts, ["org_id", "lead_or_contact_id"], "left"
    )
    return (
        joined.withColumns(_resolve(null_safe))
        .select(
            "org_id",
            "lead_or_contact_id",
            F.col("signed_up_at").alias("first_org_signup_at"),
            "activity_at",
            "is_csdr",
            *RESOLVED,
        )
        .distinct()
    )


def signup_order(
    assists: DataFrame,
    cutoff: Column,
    at: str = "first_org_signup_at",
    unique_id: str = "org_id",
) -> DataFrame:
    """Place of each assisted signup after a cut-off among all of them.

    A global order without a single sorting task: see :func:`waymark.operators.sequence`.
    """
    counted = assists.filter((F.col(at) >= cutoff) & F.col("assist_owner").isNotNull() & (F.col("is_csdr") != 1))
    return sequence(counted, [], [at, unique_id], rank="signup_rnk")


def finish_report(
    assists: DataFrame,
    order: DataFrame,
    regions: DataFrame,
    run_date: dt.date,
    manager_overrides: Mapping = {},
    lag_days: int = 10,
) -> DataFrame:
    """Assists with place, region, current-quarter flag and overridden manager."""
    placed = assists.join(order.select("org_id", "signup_rnk"), "org_id", "left").join(regions.distinct(), "org_id", "left")
    now = F.lit(run_date - dt.timedelta(days=lag_days))
    manager = F.col("assist_manager")
    for owner, name in manager_overrides.items():
        manager = F.when(F.col("assist_owner") == owner, F.lit(name)).otherwise(manager)
    current = times.same_quarter(now, F.col("first_org_signup_at"))
    return placed.withColumns(
        {"is_signup_current_quarter": F.when(current, 1).otherwise(0), "manager_name_adj": manager}
    )
