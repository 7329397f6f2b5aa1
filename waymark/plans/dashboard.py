"""The web dashboard report and the monthly conversion figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.operators import Span, interval_join, lookup_join, merge_matches, window_sums
from waymark.operators.intervals import PLACE
from waymark.operators.merge import LEFT, RIGHT
from waymark.plans.rulesets import DEFAULT, Vocabulary
from waymark.sources.sinks import Stage, stamp, unstaged

# Placeholders that let missing keys meet in the merge, and windows in days.
NO_KEY = "Null "
NO_LEAD = "Null"
VISIT_DAYS = 7
PAGE_KEYS = ["domain", "session_id", "visit_start_time", "page_visit_id", "lead_or_contact_id"]
# Visits of a lead and time bucket above which they are spread: each may have many inquiries.
HOT_VISITS = 100_000


def pages_with_leads(pages: DataFrame, lead_map: DataFrame, by_source: bool = True) -> DataFrame:
    """Page visits with the leads known for their visitor, per domain when ``by_source``."""
    columns = {"visitor_id": "anonymous_id", "lead_or_contact_id": "lead_or_contact_id"}
    if by_source:
        columns["domain"] = "source"
    known = lead_map.select(*[F.col(src).alias(name) for name, src in columns.items()]).distinct()
    keys = ["visitor_id", "domain"] if by_source else ["visitor_id"]
    return lookup_join(pages, known, keys, row_id=["page_visit_id"]).withColumn("visit_month", times.month(F.col("visit_start_time")))


def _around_visits(visits: DataFrame, inquiries: DataFrame, at: str, how: str, **options) -> DataFrame:
    # A whole-day distance of n admits up to just under n + 1 days.
    reach = (VISIT_DAYS + 1) * 86400

    def near(visit, inquiry):
        return times.whole_units("DAY", visit, inquiry).between(-VISIT_DAYS, VISIT_DAYS)

    return interval_join(
        visits,
        inquiries,
        ["lead_or_contact_id"],
        "visit_start_time",
        at,
        before=reach,
        after=reach,
        matches=near,
        how=how,
        row_id=["page_visit_id"],
        **options,
    )


def _stage_distances() -> dict[str, Column]:
    inquiry = F.col("inquiry_date_time")
    return {
        "delta_inqcreation_visit": times.whole_units("DAY", F.col("visit_start_time"), inquiry),
        "delta_mql_inq": times.whole_units("DAY", inquiry, F.col("mql_date_time")),
        "delta_sqm_inq": times.whole_units("DAY", inquiry, F.col("sqm_date_time")),
        "delta_sao_inq": times.whole_units("DAY", inquiry, F.col("sao_date_time")),
    }


def visit_inquiries(visits: DataFrame, funnel: DataFrame) -> DataFrame:
    """Visits with the inquiries of their lead within a week either way, and stage distances."""
    return _around_visits(visits, funnel, "inquiry_date_time", "left").withColumns(_stage_distances())


def funnel_flags(df: DataFrame) -> DataFrame:
    """1/0 flags; each later stage also requires the earlier ones."""
    delta = F.col("delta_inqcreation_visit")
    one_day = delta.between(0, 1)
    mql = one_day & (F.col("delta_mql_inq") <= 7)
    sqm = mql & (F.col("delta_sqm_inq") <= 14)
    sao = sqm & (F.col("delta_sao_inq") <= 60)
    flags = {
        "flg_1d_inq": one_day,
        "flg_7d_inq": delta.between(0, 7),
        "flg_7d_mql": mql,
        "flg_14d_sqm": sqm,
        "num_60d_sqm": sao,
    }
    return df.withColumns({name: F.when(cond, 1).otherwise(0) for name, cond in flags.items()})


def visit_flag_counts(visits: DataFrame, funnel: DataFrame) -> DataFrame:
    """Visits with the number of their lead's inquiries behind each of the :func:`funnel_flags`.

    No pair of visit and inquiry is formed, so a lead with very many of both is no burden.
    Visits must differ in some column.
    """
    asked = F.col("inquiry_date_time")

    def soon(stage_at: str, days: int) -> Column:
        return F.coalesce(times.whole_units("DAY", asked, F.col(stage_at)) <= days, F.lit(False))

    mql = soon("mql_date_time", 7)
    sqm = mql & soon("sqm_date_time", 14)
    sao = sqm & soon("sao_date_time", 60)
    day = 86400
    # Whole days are cut toward zero: 0 to n days are all times from under a day before to under n + 1 after.
    spans = {"day": Span(-day, 2 * day, closed=False), "week": Span(-day, (VISIT_DAYS + 1) * day, closed=False)}
    sums = {
        "n_1d_inq": ("day", F.lit(1)),
        "n_7d_inq": ("week", F.lit(1)),
        "n_7d_mql": ("day", mql.cast("int")),
        "n_14d_sqm": ("day", sqm.cast("int")),
        "n_60d_sao": ("day", sao.cast("int")),
    }
    return window_sums(visits, funnel, ["lead_or_contact_id"], "visit_start_time", "inquiry_date_time", spans, sums)


def _type_flags(v: Vocabulary) -> dict[str, Column]:
    return {
        "flg_cloud_signup": F.when(F.col("campaign_type") == v.cloud_signup, 1).otherwise(0),
        "flg_cp_download": F.when(F.col("campaign_type") == v.platform_download, 1).otherwise(0),
    }


def inquiry_type_flags(visits: DataFrame, inquiries: DataFrame, v: Vocabulary = DEFAULT, how: str = "inner") -> DataFrame:
    """Visits with near inquiries, flagged as signup or download."""
    return _around_visits(visits, inquiries, "inquiry_date_time", how).withColumns(_type_flags(v))


def web_dashboard(
    pages: DataFrame,
    lead_map: DataFrame,
    funnel: DataFrame,
    inquiries: DataFrame,
    run_date: dt.date,
    *,
    domains: Sequence[str],
    by_source: bool = True,
    vocabulary: Vocabulary = DEFAULT,
    stage: Stage = unstaged,
) -> DataFrame:
    """Page visits with their leads, inquiries and funnel stages, one row per visit, lead and member.

    ``funnel`` and ``inquiries`` are two views on inquiries that need not agree; a visit
    appears with those of both. The visits are read several times: pass
    :func:`waymark.sources.sinks.stage` to compute them once.
    """
    start = times.previous_quarter_start(run_date)
    since = F.lit(start).cast("timestamp")
    scanned = pages.filter(times.rolling_window("visit_start_time", run_date) & F.col("domain").isin(*domains))
    visits = stage(pages_with_leads(scanned, lead_map, by_source), "visits")
    # Distinct before the semi joins: one lead may have very many visits.
    leads = visits.select("lead_or_contact_id").dropna().distinct()
    in_funnel = funnel.filter(F.col("inquiry_date_time") >= since).distinct().join(leads, "lead_or_contact_id", "left_semi")
    asked = (
        inquiries.filter(F.col("inquiry_date_time") >= since - F.expr("INTERVAL 7 DAYS"))
        .distinct()
        .join(leads, "lead_or_contact_id", "left_semi")
    )

    # Both views meet the visits in one join, and the merge works where that left them: the
    # result, several rows a visit and all its columns wide, is never shuffled.
    typed = asked.withColumns(_type_flags(vocabulary))
    inquired = in_funnel.withColumn("__side", F.lit(LEFT)).unionByName(
        typed.withColumn("__side", F.lit(RIGHT)), allowMissingColumns=True
    )
    named = visits.withColumns({c: F.coalesce(c, F.lit(NO_KEY)) for c in ("session_id", "page_visit_id")})
    lead = "lead_or_contact_id"
    near = _around_visits(named, inquired, "inquiry_date_time", "left", hot_rows=HOT_VISITS, keep_place=True)
    merged = merge_matches(
        near,
        "__side",
        [lead, "visit_start_time"],
        [*PAGE_KEYS, "campaign_member_id"],
        visits.columns,
        [c for c in in_funnel.columns if c != lead],
        [c for c in typed.columns if c != lead],
        place=PLACE,
    )
    # Distances and flags are of the funnel's part alone; without one they stay missing.
    known = funnel_flags(merged.withColumns(_stage_distances()))
    of_funnel = [c for c in known.columns if c not in merged.columns]
    known = known.withColumns({c: F.when(F.col("__side").isNotNull(), F.col(c)) for c in of_funnel})
    order = [c for c in merged.columns if c in visits.columns or c in in_funnel.columns]
    order += [*of_funnel, *[c for c in merged.columns if c not in order and c != "__side"]]
    out = known.select(*order).withColumn(lead, F.coalesce(lead, F.lit(NO_LEAD)))
    return stamp(out.withColumns(times.calendar(F.col("visit_start_time"))), run_date)


def dashboard_milestones(report: DataFrame, lead_orgs: DataFrame, milestones: DataFrame) -> DataFrame:
    """Product milestones of the lead's org added to the report, a table that is read twice."""
    orgs = lead_orgs.select("org_id", "lead_or_contact_id").distinct()
    stages = milestones.select(
        "org_id", "signed_up_at", "email_verified_at", "cluster_created_at", "usage_at", "product_active_at", "stage2_active_at"
    )
    joined = lookup_join(report, orgs, ["lead_or_contact_id"]).join(stages, "org_id", "left")
    signed = F.col("signed_up_at")
    return joined.withColumns(
        {
            "email_verified_7d": F.when(times.within_days_of(F.col("email_verified_at"), signed, 7), 1).otherwise(0),
            "onboarding_activated_7d": F.when(times.within_days_of(F.col("usage_at"), signed, 7), F.col("usage_at")),
            "stg1_pao": F.col("product_active_at"),
            "stg2_pao": F.col("stage2_active_at"),
        }
    ).drop("signed_up_at", "usage_at", "product_active_at", "stage2_active_at")


def monthly_kpis(
    sessions: DataFrame,
    client_leads: DataFrame,
    inquiries: DataFrame,
    signups: DataFrame,
    emails: DataFrame,
    domains: dict[str, str],
    internal: str,
    *,
    since: dt.date,
    vocabulary: Vocabulary = DEFAULT,
    stage: Stage = unstaged,
) -> DataFrame:
    """Visitors, new share, views per visitor and 24-hour conversions per month and domain.

    ``domains`` maps a host name to its domain label; hosts outside it are not counted.
    Like the published figures, sums are taken as after joins, so a session counts once
    per matching inquiry and signup; those are counted by :func:`window_sums`, no session
    meets an inquiry. The visits are read several times; ``stage`` them.
    """
    label = F.create_map(*[F.lit(x) for pair in domains.items() for x in pair])
    wanted = sessions.filter((F.col("visit_start_time") >= F.lit(since).cast("timestamp")) & F.col("hostname").isin(*domains))
    visits = lookup_join(wanted, client_leads.select("ga_client_id", "lead_or_contact_id"), ["ga_client_id"])
    external = lookup_join(
        visits,
        emails.select(F.col("id").alias("lead_or_contact_id"), "email").distinct(),
        ["lead_or_contact_id"],
    ).filter(F.col("email").isNull() | ~F.col("email").like(internal))
    groups = ["visit_month", "domain"]
    # Sessions of one client and lead at one instant have the same inquiries and signups.
    instants = (
        external.select(
            times.month(F.col("visit_start_time")).alias("visit_month"),
            F.element_at(label, F.col("hostname")).alias("domain"),
            "ga_client_id",
            "lead_or_contact_id",
            "visit_start_time",
            F.when(F.col("is_new_visitor") == "New", 1).otherwise(0).alias("is_new"),
            "num_pageviews",
        )
        .groupBy(*groups, "ga_client_id", "lead_or_contact_id", "visit_start_time")
        .agg(F.sum("is_new").alias("new"), F.sum("num_pageviews").alias("views"))
    )
    downloads = F.col("campaign_type").isin(vocabulary.platform_download, vocabulary.community_download)
    no, yes = F.lit(0), F.lit(1)
    asked = inquiries.select(
        "lead_or_contact_id",
        F.col("created_ts").alias("happened_at"),
        yes.alias("asked"),
        F.when(F.col("tactic") != vocabulary.cloud_signup, 1).otherwise(0).alias("converted"),
        F.when(downloads, 1).otherwise(0).alias("downloaded"),
        no.alias("signed"),
    )
    signed = signups.select(
        "lead_or_contact_id",
        F.col("created_at").alias("happened_at"),
        no.alias("asked"),
        no.alias("converted"),
        no.alias("downloaded"),
        yes.alias("signed"),
    )
    names = ["asked", "converted", "downloaded", "signed"]
    counted = window_sums(
        stage(instants, "visits"),
        asked.unionByName(signed),
        ["lead_or_contact_id"],
        "visit_start_time",
        "happened_at",
        {"day": Span(0, 86400)},
        {name: ("day", F.col(name)) for name in names},
    )
    times_counted = F.greatest("asked", F.lit(1)) * F.greatest("signed", F.lit(1))
    lead = F.col("lead_or_contact_id")
    reduced = (
        counted.groupBy(*groups, "ga_client_id", "lead_or_contact_id")
        .agg(
            F.sum(F.col("new") * times_counted).alias("new"),
            F.sum(F.col("views") * times_counted).alias("views"),
            *[(F.max(name) > 0).alias(name) for name in names[1:]],
        )
        .withColumns({"converted": F.when(F.col("converted"), lead), "signup_lead": F.when(F.col("signed"), lead)})
    )
    full = reduced.groupBy(*groups).agg(
        F.count_distinct("ga_client_id").alias("num_uv"),
        F.sum("new").alias("new"),
        F.sum("views").alias("views"),
        F.count_distinct("converted").alias("num_converted_leads"),
        F.count_distinct(F.when(F.col("downloaded"), F.col("ga_client_id"))).alias("cp_cc_inquiry"),
        F.count_distinct("signup_lead").alias("signup"),
    )

    def per_visitor(column: str):
        return F.try_divide(F.col(column), F.col("num_uv"))

    return full.select(
        *groups,
        "num_uv",
        per_visitor("new").alias("percent_new_visitor"),
        per_visitor("views").alias("avg_pageview"),
        "num_converted_leads",
        per_visitor("num_converted_leads").alias("web_to_lead_cvr"),
        "cp_cc_inquiry",
        per_visitor("cp_cc_inquiry").alias("cp_cvr"),
        "signup",
        per_visitor("signup").alias("signup_cvr"),
    )
