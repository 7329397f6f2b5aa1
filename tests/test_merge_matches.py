"""The dashboard merge: the rows of a full join of both look-ups, without a shuffle of its own."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from waymark.functions import times
from waymark.operators import full_merge, interval_join, merge_matches
from waymark.operators.intervals import PLACE
from waymark.plans import dashboard
from waymark.sources.sinks import stamp

RUN_DATE = dt.date(2024, 2, 15)
PAGES = "page_visit_id string, visitor_id string, session_id string, visit_start_time timestamp, domain string, url string"
MEMBER = "campaign_member_id string, lead_or_contact_id string, inquiry_date_time timestamp, campaign_type string"
STAGES = ", mql_date_time timestamp, sqm_date_time timestamp, sao_date_time timestamp"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def tables(spark, seed):
    r = random.Random(seed)

    def maybe(value):
        return None if r.random() < 0.2 else value

    # Ids, members and instants repeat, with equal and with other columns beside them.
    pages = [
        (maybe(f"p{r.randrange(12)}"), maybe(f"v{r.randrange(4)}"), maybe("s"), at(200 * r.randrange(3)), r.choice("de"), maybe(r.choice("uw")))
        for _ in range(60)
    ]
    leads = [(f"v{i}", maybe(f"L{i % 3}"), "d") for i in range(4) for _ in range(2)]

    def member():
        return maybe(f"M{r.randrange(6)}"), maybe(f"L{r.randrange(3)}"), at(r.randrange(0, 600, 50)), maybe(r.choice(["Cloud Sign-Up", "x"]))

    def stages():
        return tuple(maybe(at(r.randrange(600))) for _ in range(3))

    return (
        spark.createDataFrame(pages, PAGES),
        spark.createDataFrame(leads, "anonymous_id string, lead_or_contact_id string, source string"),
        spark.createDataFrame([(*member(), *stages()) for _ in range(25)], MEMBER + STAGES),
        spark.createDataFrame([member() for _ in range(25)], MEMBER),
    )


def by_full_join(pages, leads, funnel, asked):
    visits = dashboard.pages_with_leads(pages, leads)

    def keyed(df):
        return df.withColumns(
            {
                "session_id": F.coalesce("session_id", F.lit(dashboard.NO_KEY)),
                "page_visit_id": F.coalesce("page_visit_id", F.lit(dashboard.NO_KEY)),
                "lead_or_contact_id": F.coalesce("lead_or_contact_id", F.lit(dashboard.NO_LEAD)),
            }
        )

    staged = keyed(dashboard.funnel_flags(dashboard.visit_inquiries(visits, funnel)))
    typed = keyed(dashboard.inquiry_type_flags(visits, asked))
    merged = full_merge(staged, typed, [*dashboard.PAGE_KEYS, "campaign_member_id"])
    return stamp(merged.withColumns(times.calendar(F.col("visit_start_time"))).distinct(), RUN_DATE)


@pytest.mark.parametrize("seed", range(3))
def test_same_rows_as_a_full_join(spark, seed):
    given = tables(spark, seed)
    found, wanted = dashboard.web_dashboard(*given, RUN_DATE, domains=["d", "e"]), by_full_join(*given)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    rows = sorted(map(str, wanted.collect()))
    assert sorted(map(str, found.collect())) == rows and len(rows) > 100


def test_the_wide_result_is_not_shuffled(spark):
    pages, leads, funnel, asked = tables(spark, 0)
    visits = dashboard.pages_with_leads(pages, leads)
    sides = funnel.withColumn("side", F.lit("left")).unionByName(asked.withColumn("side", F.lit("right")), allowMissingColumns=True)
    near = interval_join(
        visits, sides, ["lead_or_contact_id"], "visit_start_time", "inquiry_date_time", before=9, after=9,
        matches=lambda a, b: a == b, how="left", row_id=["page_visit_id"], keep_place=True,
    )
    keys = [*dashboard.PAGE_KEYS, "campaign_member_id"]
    by = ["lead_or_contact_id", "visit_start_time"]
    columns = [c for c in funnel.columns if c != "lead_or_contact_id"]
    merged = merge_matches(near, "side", by, keys, visits.columns, columns, columns[:3], place=PLACE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (near, merged)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles[0] == shuffles[1] > 1
