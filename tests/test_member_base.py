"""Campaign members: only repeated ids are ranked, and none of them with its campaign's columns."""

import datetime as dt

from waymark.plans import inquiry
from waymark.sources.sinks import stage

MEMBER = (
    "id string, campaign_id long, lead_id string, contact_id string, created_ts timestamp, inquiry_date_time timestamp,"
    " country string, geo string, region_match string, priority_account boolean, focus_account boolean,"
    " utm_medium string, utm_campaign string, utm_source string"
)
CAMPAIGN = (
    "id long, campaign_name string, campaign_type string, campaign_function string, campaign_team string, start_date date,"
    " campaign_theater string, campaign_region string, tactic string, actual_cost double, campaign_format string"
)


def member(key, campaign, lead, day, country="X", geo=None):
    at = dt.datetime(2024, 1, day)
    return (key, campaign, lead, None, at, at, country, geo, None, True, False, None, None, None)


def campaign(key, name):
    return (key, name, "Webinar", "Digital", "Partner", dt.date(2024, 1, 1), None, None, None, 1.0, None)


def base(spark):
    members = [
        member("once", 1, "gone", 1),  # deleted
        member("two", 9, "L", 1),  # no such campaign, so the later row of this id stays
        member("two", 1, "L", 3),
        member("two", 1, "L", 4),
        member(None, 2, None, 5, geo="EMEA"),
        member(None, 1, "both", 6),
        member("map", 2, "both", 2, country="Y", geo="EMEA"),
    ]
    people = [("gone", True), ("gone", True), ("both", True), ("both", None), ("L", False)]
    return inquiry.member_base(
        spark.createDataFrame(members, MEMBER),
        spark.createDataFrame([campaign(1, "b"), campaign(1, "a"), campaign(2, "c"), campaign(3, "FCI x")], CAMPAIGN),
        spark.createDataFrame(people, "id string, is_deleted boolean"),
        spark.createDataFrame([], "id string, is_deleted boolean"),
        spark.createDataFrame([("Y", "Zulu"), ("Y", None), ("Y", "Oscar")], "country string, theater string"),
        stage=stage,
    )


def test_one_row_per_id_with_the_first_campaign_and_theatre(spark):
    rows = base(spark).select("campaign_member_id", "campaign_name", "created_ts", "theater").collect()
    assert {(r[0], r[1], r[2].day, r[3]) for r in rows} == {
        ("two", "a", 3, "Other"),
        (None, "c", 5, "EMEA"),
        ("map", "c", 2, "EMEA"),
    }
    assert len(rows) == 3


def test_members_are_ranked_without_their_campaign(spark):
    plan = base(spark)._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "windowspecdefinition(campaign_member_id" in line]
    assert not any("campaign_name" in line for line in ranked)
