"""Identity resolution and geography."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import external_email
from waymark.operators import (
    asof_neighbours,
    broadcast_if_small,
    keep_first,
    keep_first_ties,
    lookup_join,
    sequence,
)
from waymark.sources.sinks import Stage, stage, stamp


def lead_to_visitor(leads: DataFrame, identifies: DataFrame, run_date: dt.date, source: str) -> DataFrame:
    """Lead and anonymous visitor sharing an e-mail, with the visitor's first appearance."""
    people = leads.select(F.col("id").alias("lead_or_contact_id"), "email").dropna(subset=["email"]).distinct()
    seen = (
        identifies.dropna(subset=["email"])
        .groupBy("anonymous_id", "email")
        .agg(F.min("timestamp").alias("first_appearance_at"))
    )
    return stamp(people.join(seen, "email").withColumn("source", F.lit(source)), run_date)


def lead_to_client(
    leads: DataFrame,
    sessions: DataFrame,
    identifies: DataFrame,
    client_bridge: DataFrame,
    lead_bridge: DataFrame,
) -> DataFrame:
    """Lead and analytics client id through two bridge maps; analytics beats identify as source.

    ``client_bridge`` maps ``ga_client_id`` to ``bridge_id``, ``lead_bridge`` maps
    ``bridge_id`` to ``lead_id``. Sessions without hits do not count.
    """
    from_sessions = sessions.filter(F.size("hits") > 0).select(F.col("client_id").alias("ga_cid"), F.lit("GA").alias("source"))
    from_identifies = identifies.select("ga_cid", F.lit("Segment").alias("source"))
    clients = from_sessions.unionByName(from_identifies).dropna(subset=["ga_cid"]).distinct()
    clients = keep_first_ties(clients, ["ga_cid"], ["source"])
    # Both id columns must be present in the result, so the outer joins reduce to inner ones.
    bridged = clients.join(
        client_bridge.select(F.col("ga_client_id").cast("string").alias("ga_cid"), F.col("bridge_id").cast("string")),
        "ga_cid",
    )
    linked = lead_bridge.select(
        F.col("lead_id").cast("string").alias("sfdc_lead_or_contact_id"), F.col("bridge_id").cast("string")
    )
    first_seen = leads.select(
        F.col("id").cast("string").alias("sfdc_lead_or_contact_id"), F.col("created_at").alias("first_appearance_at")
    ).distinct()
    return (
        first_seen.join(linked, "sfdc_lead_or_contact_id")
        .join(bridged, "bridge_id")
        .select("sfdc_lead_or_contact_id", F.col("ga_cid").alias("ga_client_id"), "source", "first_appearance_at")
        .distinct()
    )


def unify_people(
    leads: DataFrame,
    contacts: DataFrame,
    *,
    precedence: str = "lead",
    accounts: DataFrame | None = None,
    keep_null_deleted: bool = False,
) -> DataFrame:
    """Leads and contacts as one list of people.

    A contact converted from a lead takes the lead's id and creation time with
    ``precedence="lead"``, and keeps its own with ``"contact"``. With ``accounts`` the
    result also has ``theater``, ``area``, ``region`` and ``subregion``: of a lead from its
    matched, then its converted account, then its own; of a contact from its account.
    """
    def alive(flag: str) -> Column:
        known = ~F.col(flag)
        return F.col(flag).isNull() | known if keep_null_deleted else known

    lead_side = leads.filter(alive("is_deleted"))
    lead_cols = [F.col("id"), F.col("email"), F.lit("lead").alias("origin"), F.col("created_at").alias("lead_create_ts")]
    origin_lead = leads.select(
        F.col("converted_contact_id"),
        F.col("id").alias("__lead_id"),
        F.col("created_at").alias("__lead_created"),
        *([F.col("theater").alias("__lead_theater")] if accounts is not None else []),
    ).dropna(subset=["converted_contact_id"])
    contact_side = contacts.filter(alive("is_deleted")).join(
        origin_lead, F.col("id") == F.col("converted_contact_id"), "left"
    )
    by_lead = precedence == "lead"
    id_order = ("__lead_id", "id") if by_lead else ("id", "__lead_id")
    ts_order = ("__lead_created", "created_at") if by_lead else ("created_at", "__lead_created")
    origin = F.when(F.col("__lead_id").isNull(), "contact").otherwise("lead") if by_lead else F.lit("contact")
    contact_cols = [
        F.coalesce(*id_order).alias("id"),
        F.col("email"),
        origin.alias("origin"),
        F.coalesce(*ts_order).alias("lead_create_ts"),
    ]
    if accounts is not None:
        def account(prefix: str) -> DataFrame:
            return accounts.select(*[F.col(c).alias(f"__{prefix}_{c}") for c in ("id", "area", "region", "subregion")])

        lead_side = lead_side.join(account("m"), F.col("matched_acct_id") == F.col("__m_id"), "left").join(
            account("c"), F.col("converted_acct_id") == F.col("__c_id"), "left"
        )
        lead_cols += [
            F.col("theater"),
            F.coalesce("__m_area", "__c_area", "area").alias("area"),
            F.coalesce("__m_region", "__c_region", "region").alias("region"),
            F.coalesce("__m_subregion", "__c_subregion").alias("subregion"),
        ]
        contact_side = contact_side.join(account("a"), F.col("account_id") == F.col("__a_id"), "left")
        contact_cols += [
            F.coalesce("__lead_theater", "account_theater").alias("theater"),
            F.coalesce("__a_area", "area").alias("area"),
            F.coalesce("__a_region", "region").alias("region"),
            F.col("__a_subregion").alias("subregion"),
        ]
    return lead_side.select(*lead_cols).unionByName(contact_side.select(*contact_cols)).distinct()


def merged_leads(leads: DataFrame, history: DataFrame) -> DataFrame:
    """Deleted leads with the lead that survived their merge, where the e-mail changed.

    The merge record names the deleted lead only by name and company, at the time the
    deleted lead was last modified.
    """
    gone = leads.filter("is_deleted").select(
        F.concat("name", F.lit(", "), "company").alias("merged_name"),
        F.col("last_modified_at").alias("merged_at"),
        F.col("id").alias("deleted_lead_id"),
        F.col("email").alias("deleted_email"),
    )
    merges = history.filter("field = 'leadMerged'").select(
        F.col("old_value").alias("merged_name"), F.col("created_at").alias("merged_at"), F.col("lead_id").alias("master_lead_id")
    )
    masters = leads.select(F.col("id").alias("master_lead_id"), F.col("email").alias("master_email"))
    return (
        gone.join(merges, ["merged_name", "merged_at"])
        .join(masters, "master_lead_id")
        .filter("master_email <> deleted_email")
        .select("deleted_lead_id", "deleted_email", "master_lead_id", "master_email", "merged_at")
    )


def last_survivors(merges: DataFrame, stage: Stage = stage) -> DataFrame:
    """``merges`` with the lead that survived in the end, where a survivor was itself merged later.

    A deleted lead counts with its last merge. Only later merges are followed, so chains
    have an end even where records name each other in a circle. Steps are doubled each
    round: a chain of n merges takes about log2(n) rounds, each written by ``stage``.
    """
    one = keep_first(merges, ["deleted_lead_id"], [F.desc("merged_at"), "master_lead_id", "master_email", "deleted_email"])
    steps = one.select(
        F.col("deleted_lead_id").alias("lead"), F.col("master_lead_id").alias("to"), F.col("merged_at").alias("at"), "master_email"
    )
    # A step goes on from a lead only if that lead was merged later than the step.
    onward = steps.select(F.col("lead").alias("from"), F.col("at").alias("later"))
    met = steps.join(onward, (F.col("to") == F.col("from")) & (F.col("at") < F.col("later")), "left")
    reached = stage(met.select("lead", "to", "master_email", F.col("from").isNotNull().alias("open")), "merge_steps")
    while not reached.filter("open").isEmpty():
        further = reached.select(
            F.col("lead").alias("from"), F.col("to").alias("to2"), F.col("master_email").alias("email2"), F.col("open").alias("open2")
        )
        joined = reached.join(further, F.col("open") & (F.col("to") == F.col("from")), "left")
        goes_on = F.col("from").isNotNull()
        reached = stage(
            joined.select(
                "lead",
                F.when(goes_on, F.col("to2")).otherwise(F.col("to")).alias("to"),
                F.when(goes_on, F.col("email2")).otherwise(F.col("master_email")).alias("master_email"),
                F.coalesce("open2", F.lit(False)).alias("open"),
            ),
            "merge_steps",
        )
    ends = reached.select(F.col("lead").alias("deleted_lead_id"), F.col("to").alias("master_lead_id"), "master_email")
    return one.drop("master_lead_id", "master_email").join(ends, "deleted_lead_id").select(*merges.columns)


def apply_merges(signups: DataFrame, merges: DataFrame) -> DataFrame:
    """Signups with the e-mail of the surviving lead where theirs was merged away."""
    survivors = merges.select(F.col("deleted_email").alias("email"), "master_email", "master_lead_id")
    return (
        signups.join(survivors, "email", "left")
        .withColumn("merged_email", F.coalesce("master_email", "email"))
        .withColumnRenamed("email", "signup_email")
        .distinct()
    )


def signup_users(users: DataFrame, memberships: DataFrame) -> DataFrame:
    """Users with the orgs they joined."""
    joined = memberships.select("org_id", "user_id", F.col("created_at").alias("joined_at"))
    people = users.select(F.col("id").alias("user_id"), "email", F.col("created_at").alias("user_created_at"))
    return joined.join(people, "user_id")


def first_user_per_org(users: DataFrame, memberships: DataFrame) -> DataFrame:
    """The user who joined each org first, among members that have a user row.

    Only ids are matched before the first membership is kept; users are joined to that.
    """
    known = memberships.join(users.select(F.col("id").alias("user_id")).distinct(), "user_id", "left_semi")
    first = keep_first(known.select("org_id", "user_id", "created_at"), ["org_id"], ["created_at", "user_id"])
    return signup_users(users, first)


def org_to_person(users: DataFrame, memberships: DataFrame, people: DataFrame) -> DataFrame:
    """First signup per org, person and e-mail."""
    signups = signup_users(users, memberships).withColumn("signed_up_at", F.coalesce("user_created_at", "joined_at"))
    named = people.withColumnRenamed("id", "lead_or_contact_id")
    joined = signups.join(named, "email", "left")
    return keep_first(
        joined, ["org_id", "lead_or_contact_id", "email"], ["signed_up_at", "lead_create_ts", "user_id", "origin"]
    ).select("org_id", "lead_or_contact_id", "user_id", "email", "signed_up_at", "origin", "lead_create_ts")


def org_to_person_product_led(
    users: DataFrame, memberships: DataFrame, orgs: DataFrame, people: DataFrame, service_accounts: str
) -> DataFrame:
    """Org to person for product-led customer orgs, without service accounts.

    Keeps the first row per org, user, e-mail and person, and the row's place among all
    signups of its org.
    """
    led = orgs.filter("is_customer and motion = 'Product-Led'").select(F.col("id").alias("org_id"), "deactivated_at", "is_customer")
    outside = users.filter(external_email(F.col("email"), service_accounts, keep_null=False))
    signups = signup_users(outside, memberships).withColumn("signed_up_at", F.coalesce("user_created_at", "joined_at"))
    joined = signups.join(led, "org_id").join(people.withColumnRenamed("id", "lead_or_contact_id"), "email", "left")
    order = ["signed_up_at", "lead_create_ts", "user_id", "lead_or_contact_id", "origin"]
    # The order must tell all rows of an org apart.
    strict = [*order, "email", "joined_at"]
    placed = sequence(joined.distinct(), ["org_id"], strict, rank="rnk_is_first_signup")
    return keep_first(placed, ["org_id", "user_id", "email", "lead_or_contact_id"], order).select(
        "org_id",
        "lead_or_contact_id",
        "user_id",
        "email",
        "signed_up_at",
        "origin",
        "lead_create_ts",
        "deactivated_at",
        "is_customer",
        "rnk_is_first_signup",
    )


def earliest_org_per_lead(signups: DataFrame) -> DataFrame:
    """Org (or orgs, on a tie) each lead signed up for first."""
    known = signups.dropna(subset=["lead_or_contact_id"])
    return keep_first_ties(known, ["lead_or_contact_id"], ["signed_up_at"]).select("org_id", "lead_or_contact_id").distinct()


def as_of_day(activities: DataFrame, snapshots: DataFrame, user: str, at: str) -> DataFrame:
    """Name, role and manager of a user on the day of an activity, from a daily snapshot.

    Snapshot rows carry ``id``, ``day``, ``name``, ``role`` and ``manager_id``; the manager's
    name comes from the same day's snapshot.
    """
    managers = snapshots.select(F.col("id").alias("manager_id"), "day", F.col("name").alias("manager_name"))
    full = snapshots.join(managers, ["manager_id", "day"], "left").select(
        F.col("id").alias(user), F.col("day").alias("__day"), F.col("name").alias("user_name"), "role", "manager_name"
    )
    return activities.withColumn("__day", F.to_date(at)).join(full, [user, "__day"], "left").drop("__day")


def with_manager(df: DataFrame, managers: DataFrame, name: str = "user_name") -> DataFrame:
    """Manager from a fixed list of names instead of the snapshot."""
    listed = managers.select(F.col("sdr_name").alias(name), "manager_name")
    return df.join(broadcast_if_small(listed), name, "left")


def country_of_visit(visits: DataFrame, ip_history: DataFrame, fallback: bool = True) -> DataFrame:
    """Country of the visiting address from its latest snapshot dated on or before the visit day.

    With ``fallback``, a visit without such a country takes the address's earliest
    snapshot. Days are compared, so a snapshot later on the visit day counts. All visits
    of an address on one day share their answer: it is looked up once per address and
    day, against one snapshot per address and day, and then joined to the visits.
    """
    fields = ["execution_ts", "country", "country_name"]
    day = F.to_date("visit_start_time").alias("__day")
    days = visits.select("context_ip", day).dropna().distinct()
    snapshot = F.struct(*fields)
    daily = ip_history.groupBy(F.col("ip").alias("context_ip"), F.to_date("execution_ts").alias("__at")).agg(
        F.max(snapshot).alias("__last"), F.min(snapshot).alias("__first")
    )
    found = asof_neighbours(
        days, daily, ["context_ip"], F.col("__day"), F.col("__at"), ["__last", "__first"]
    )
    latest, first = F.col("prev").getField("__last"), F.col("earliest").getField("__first")
    answers = found.select("context_ip", "__day", latest.alias("__latest"), first.alias("__earliest"))
    joined = lookup_join(visits.select("*", day), answers, ["context_ip", "__day"])

    def pick(field: str) -> Column:
        known = F.col("__latest").getField(field)
        if not fallback:
            return known
        missing = F.col("__latest").getField("country").isNull()
        return F.coalesce(known, F.when(missing, F.col("__earliest").getField(field)))

    return joined.select(
        *visits.columns,
        pick("country").alias("country"),
        pick("country_name").alias("country_name"),
        pick("execution_ts").alias("ip_snapshot_ts"),
    )


def with_theater(df: DataFrame, touchpoints: DataFrame, country: str = "country_name") -> DataFrame:
    """Sales theatre of a country."""
    known = touchpoints.select(F.col("country").alias(country), "theater").distinct()
    return df.join(broadcast_if_small(known), country, "left")


def without_internal(df: DataFrame, pattern: str, keep_null: bool = True, email: str = "email") -> DataFrame:
    """Drop internal or service accounts by e-mail pattern."""
    return df.filter(external_email(F.col(email), pattern, keep_null))


def unnest(df: DataFrame, column: str, keep: Sequence[str], out: str) -> DataFrame:
    """One row per element of a repeated column."""
    return df.select(*keep, F.explode(column).alias(out))
