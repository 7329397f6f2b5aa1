"""Web behaviour: page-visit fact, visitors, sessions, forms and call-to-action pages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import marketing, text, times
from waymark.operators import broadcast_if_small, first_match, interval_join, lookup_join, sequence
from waymark.plans import rulesets
from waymark.sources.sinks import Stage, stamp, unstaged

LOAD_METADATA = ("loaded_at", "uuid_ts", "received_at", "sent_at", "context_ip")


@dataclass(frozen=True)
class PageLog:
    """One page-view log: its rows, its names for the common columns, its domain label."""

    rows: DataFrame
    columns: Mapping[str, str]
    domain: str


def harmonise(logs: Sequence[PageLog]) -> DataFrame:
    """Union logs by column name; a column a log does not have is null there."""
    parts = [
        log.rows.select(*[F.col(src).alias(name) for name, src in log.columns.items()], F.lit(log.domain).alias("domain"))
        for log in logs
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def deduplicate(events: DataFrame, metadata: Sequence[str] = LOAD_METADATA) -> DataFrame:
    """Distinct events, ignoring columns that only describe the load."""
    return events.drop(*metadata).distinct()


def sequence_pages(pages: DataFrame, keys: Sequence[str] = ("visitor_id", "session_id"), **options) -> DataFrame:
    """Rank from both ends, next page time and visit length per visitor and session; ``options`` are those of ``sequence``."""
    ranked = sequence(
        pages,
        keys,
        ["visit_start_time", "page_visit_id"],
        rank="rank_from_start",
        reverse_rank="rank_from_end",
        lead={"visit_end_time": "visit_start_time"},
        **options,
    )
    return ranked.withColumn(
        "visit_length", times.whole_units("SECOND", F.col("visit_start_time"), F.col("visit_end_time"))
    )


def edge_flags() -> dict[str, Column]:
    """Entrance, exit and bounce as the text True / False."""
    first, last = F.col("rank_from_start") == 1, F.col("rank_from_end") == 1

    def flag(c: Column) -> Column:
        return F.when(c, F.lit("True")).otherwise(F.lit("False"))

    return {"is_entrance": flag(first), "is_exit": flag(last), "is_bounce": flag(first & last)}


def tag_columns(pages: DataFrame) -> DataFrame:
    """Lower-cased tags, whether a campaign is known, and the derived medium."""
    return pages.withColumns(
        {
            "utm_campaign": F.lower("utm_campaign"),
            "utm_source": F.lower("utm_source"),
            "utm_medium": F.lower("utm_medium"),
            "utm_campaign_status": marketing.null_status(F.col("utm_campaign")),
            "segment_utm_medium": marketing.derived_medium(
                F.col("utm_campaign"), F.col("referrer"), F.col("utm_medium")
            ),
        }
    )


def channel_detail(
    df: DataFrame,
    rules: Sequence,
    default: str,
    fields: Mapping[str, str],
    out: str = "channel_detail",
) -> DataFrame:
    """Classify by ``rules``. ``fields`` maps each field a rule reads to a column of ``df``.

    The fields are projected once, in front of the CASE, not re-evaluated per rule.
    """
    held = df.withColumns({f"__{c}": F.col(c) for c in df.columns if c in fields})
    held = held.withColumns({name: F.col(f"__{src}" if src in fields else src) for name, src in fields.items()})
    labelled = held.withColumn("__label", first_match(rules, default))
    kept = [F.col(f"__{c}" if c in fields else c).alias(c) for c in df.columns if c != out]
    return labelled.select(*kept, F.col("__label").alias(out))


TAG_FIELDS = {"medium": "utm_medium", "source": "utm_source", "campaign": "utm_campaign"}
DERIVED_FIELDS = {**TAG_FIELDS, "medium": "segment_utm_medium"}


def roll_up(df: DataFrame, mapping: DataFrame | None = None, parity: bool = False) -> DataFrame:
    """Channel and channel aggregate of ``channel_detail``.

    ``mapping`` has ``detail``, ``channel`` and ``channel_aggregate``; without it the
    built-in roll-up applies. An unmapped detail keeps its own name, or becomes the text
    ``channel_detail`` when ``parity`` asks for the published result.
    """
    if mapping is None:
        detail = F.col("channel_detail")
        return df.withColumns(
            {"channel": rulesets.channel_of(detail), "channel_aggregate": rulesets.aggregate_of(detail)}
        )
    unmapped = F.when(F.col("channel_detail").isNotNull(), F.lit("channel_detail") if parity else F.col("channel_detail"))
    renamed = mapping.withColumnsRenamed({"detail": "__detail", "channel": "__channel", "channel_aggregate": "__aggregate"})
    return (
        df.join(broadcast_if_small(renamed), F.col("channel_detail") == F.col("__detail"), "left")
        .withColumns(
            {
                "channel": F.coalesce("__channel", unmapped),
                "channel_aggregate": F.coalesce("__aggregate", unmapped),
            }
        )
        .drop("__detail", "__channel", "__aggregate")
    )


def url_columns(pages: DataFrame, home: str = "/homepage") -> DataFrame:
    """Cleaned URL and its three sections."""
    cleaned = pages.withColumn("url_cleaned", text.clean_url(F.col("url")))
    return cleaned.withColumns(
        {f"url_section_{i}": text.url_section(F.col("url_cleaned"), i, home) for i in (1, 2, 3)}
    )


def new_or_returned(
    pages: DataFrame, visitors: DataFrame, unit: str = "month", hot_from: DataFrame | None = None
) -> DataFrame:
    """New in the period of the first visit, Returned later, None when unknown."""
    first = visitors.select("visitor_id", "first_visit_time")
    seen, now = F.date_trunc(unit, "first_visit_time"), F.date_trunc(unit, "visit_start_time")
    flag = F.when(now == seen, F.lit("New")).when(now > seen, F.lit("Returned")).otherwise(F.lit("None"))
    return (
        lookup_join(pages, first, ["visitor_id"], row_id=["page_visit_id"], hot_from=hot_from)
        .withColumn("flg_new_vs_returned", flag)
        .drop("first_visit_time")
    )


def visitor_dimension(pages: DataFrame, keys: Sequence[str] = ("visitor_id",)) -> DataFrame:
    """First and latest visit per visitor (or per visitor and user)."""
    return pages.groupBy(*keys).agg(
        F.min("visit_start_time").alias("first_visit_time"),
        F.max("visit_start_time").alias("most_recent_visit_time"),
    )


def page_visit_fact(
    logs: Sequence[PageLog],
    visitors: DataFrame,
    run_date: dt.date,
    *,
    mapping: DataFrame | None = None,
    vocabulary: rulesets.Vocabulary = rulesets.DEFAULT,
    derived: bool = True,
    spellings: Mapping[str, DataFrame] | None = None,
    unit: str = "month",
    stage: Stage = unstaged,
) -> DataFrame:
    """The page-visit fact. ``derived`` classifies on the derived medium, as the later form does.

    An event that was loaded twice counts once. The united log is read several times (hot
    keys are counted before rows are sorted), so pass a ``stage`` to unite it once.
    """
    logged = stage(deduplicate(harmonise(logs)), "page_log")
    pages = sequence_pages(logged, ["domain", "visitor_id", "session_id"])
    for column, table in (spellings or {}).items():
        pages = marketing.canonical_values(pages, column, table)
    pages = url_columns(tag_columns(pages))
    rules = rulesets.web_channel_rules(vocabulary, "direct" if derived else "(direct)")
    pages = channel_detail(pages, rules, rulesets.WEB_DEFAULT, DERIVED_FIELDS if derived else TAG_FIELDS)
    pages = new_or_returned(roll_up(pages, mapping), visitors, unit, hot_from=logged)
    return stamp(pages.withColumns(edge_flags()), run_date)


def daily_page_load(pages: DataFrame, run_date: dt.date) -> DataFrame:
    """One day of page visits, ready to replace that day's partition."""
    day = sequence_pages(pages.filter(times.on_day("visit_start_time", run_date)))
    return stamp(day.withColumns(edge_flags()).drop("rank_from_start", "rank_from_end", "visit_length"), run_date)


def session_rollup(pages: DataFrame) -> DataFrame:
    """Start, end, minutes, page count and the languages and sources seen in a session."""
    start, end = F.min("visit_start_time"), F.max("visit_start_time")
    return pages.groupBy("session_id", "visitor_id").agg(
        text.distinct_list("language").alias("language"),
        start.alias("visit_start_time"),
        end.alias("visit_end_time"),
        times.whole_units("MINUTE", start, end).alias("tot_session_time_min"),
        F.count("url").alias("cnt_page_views"),
        F.lower(text.distinct_list("utm_source")).alias("utm_source"),
    )


def sessions_with_visitor(pages: DataFrame) -> DataFrame:
    """Sessions with the first and latest visit of their visitor.

    Both roll-ups and their join work visitor by visitor: on pages bucketed by visitor nothing is shuffled.
    """
    return session_rollup(pages).join(visitor_dimension(pages.dropna(subset=["visitor_id"])), "visitor_id", "left")


def session_conversions(sessions: DataFrame, forms: DataFrame, signup_forms: Sequence[int], download_forms: Sequence[int]) -> DataFrame:
    """Sessions with their form counts, zero where there are none."""
    counts = forms.groupBy("session_id", "visitor_id").agg(
        F.count(F.lit(1)).alias("cnt_inquiries"),
        F.count(F.when(F.col("form_id").isin(*download_forms), 1)).alias("cnt_cp_downloads"),
        F.count(F.when(F.col("form_id").isin(*signup_forms), 1)).alias("cnt_cloud_signup"),
    )
    return sessions.join(counts, ["session_id", "visitor_id"], "left").fillna(
        0, ["cnt_inquiries", "cnt_cp_downloads", "cnt_cloud_signup"]
    )


CLICK_COLUMNS = {
    "session_id": "s_id",
    "visitor_id": "anonymous_id",
    "cloud_user_id": "user_id",
    "component": "component",
    "event": "event",
    "event_text": "event_text",
    "click_id": "id",
    "timestamp": "timestamp",
    "href_url": "href_url",
    "location": "location",
}
EXPERIMENT_COLUMNS = (
    "experiment_id",
    "experiment_name",
    "anonymous_id",
    "campaign_id",
    "campaign_name",
    "is_in_campaign_holdback",
    "variation_id",
    "variation_name",
    "timestamp",
)


def click_engagement(clicks: DataFrame) -> DataFrame:
    return clicks.select(*[F.col(src).alias(name) for name, src in CLICK_COLUMNS.items()])


def experiment_exposure(views: DataFrame) -> DataFrame:
    return views.select(*EXPERIMENT_COLUMNS)


def abandoned_form_pages(forms: DataFrame, pages: DataFrame, minutes: int = 2) -> DataFrame:
    """Each abandoned form with the page views of the same visitor, session and URL around it."""
    seconds = minutes * 60
    views = pages.select("visitor_id", "session_id", "url", F.col("visit_start_time").alias("page_time"), "page_visit_id")
    span = F.expr(f"INTERVAL {minutes} MINUTES")
    return interval_join(
        forms,
        views.distinct(),
        ["visitor_id", "session_id", "url"],
        "timestamp",
        "page_time",
        before=seconds,
        after=seconds,
        matches=lambda form, page: (form >= page - span) & (form <= page + span),
        how="left",
    ).drop("page_time")


# Page families that lead to a form, and the page after it.
CTA_PAGES = ["/resources", "/thank-you", "/online-talk", "/ebook", "/white-paper", "/demo", "/report/"]
THANK_YOU = "/thank-you"


def cta_pages(
    pages: DataFrame,
    keys: Sequence[str] = ("visitor_id", "session_id", "context_ip"),
    extra: Sequence[str] = (),
) -> DataFrame:
    """URLs that offer a form: known page families, and any page seen just before a thank-you page."""
    named = pages.filter(text.contains_any(F.col("url_cleaned"), [*CTA_PAGES, *extra])).select("url_cleaned")
    stepped = sequence(
        pages.select(*keys, "visit_start_time", "page_visit_id", "url_cleaned"),
        keys,
        ["visit_start_time", "page_visit_id"],
        lag={"previous_url": "url_cleaned"},
    )
    before_thanks = stepped.filter(F.col("url_cleaned").contains(THANK_YOU)).select(
        F.col("previous_url").alias("url_cleaned")
    )
    # A missing URL fails this test too.
    wanted = ~F.col("url_cleaned").contains(THANK_YOU)
    return named.unionByName(before_thanks).filter(wanted).distinct()


def cta_flags(pages: DataFrame, cta: DataFrame) -> DataFrame:
    """Mark thank-you pages and call-to-action pages."""
    listed = cta.select("url_cleaned", F.lit(True).alias("flg_page_cta"))
    joined = lookup_join(pages, listed, ["url_cleaned"], row_id=["page_visit_id"])
    return joined.withColumns(
        {
            "flg_page_thank_you": F.coalesce(F.col("url_cleaned").contains(THANK_YOU), F.lit(False)),
            "flg_page_cta": F.coalesce("flg_page_cta", F.lit(False)),
        }
    )
