"""Hand-made rows for the semantics that are easy to get wrong."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from waymark.functions import marketing, text, times
from waymark.operators import quality, valid_at, validity_intervals
from waymark.sources import sinks, versions
from waymark.plans import assist, credits, dashboard, identity, inquiry, rulesets, signup, web


def ts(s):
    return dt.datetime.fromisoformat(s)


def one(df):
    return df.collect()[0]


def test_weeks_start_on_sunday(spark):
    df = spark.createDataFrame([(dt.date(2022, 3, d),) for d in (5, 6, 12)], "d date")
    assert [r[0] for r in df.select(times.sunday_week(F.col("d"))).collect()] == [
        dt.date(2022, 2, 27),
        dt.date(2022, 3, 6),
        dt.date(2022, 3, 6),
    ]


@pytest.mark.parametrize(
    "run, start", [((2024, 2, 15), (2023, 10, 1)), ((2024, 4, 1), (2024, 1, 1)), ((2024, 12, 31), (2024, 7, 1))]
)
def test_previous_quarter(run, start):
    assert times.previous_quarter_start(dt.date(*run)) == dt.date(*start)


def test_union_by_name_leaves_missing_null(spark):
    a = spark.createDataFrame([("p1", "s1", "v")], "id string, s string, v string")
    b = spark.createDataFrame([("p2", "w")], "id string, v string")
    logs = [web.PageLog(a, {"page": "id", "session_id": "s", "visitor": "v"}, "x"), web.PageLog(b, {"page": "id", "visitor": "v"}, "y")]
    rows = {r["page"]: r.asDict() for r in web.harmonise(logs).collect()}
    assert rows["p2"] == {"page": "p2", "session_id": None, "visitor": "w", "domain": "y"}


def detail(spark, rules, default, **fields):
    names = ("medium", "source", "campaign", "referrer", "anonymous_id")
    df = spark.createDataFrame([tuple(fields.get(n) for n in names)], ", ".join(f"{n} string" for n in names))
    return one(web.channel_detail(df, rules, default, {n: n for n in names}))["channel_detail"]


def v1(spark, **fields):
    return detail(spark, rulesets.web_channel_rules(), rulesets.WEB_DEFAULT, **fields)


def v3(spark, **fields):
    return detail(spark, rulesets.signup_channel_rules(), signup.NO_TOUCH, **fields)


def test_missing_campaign_is_organic_only_in_the_later_rules(spark):
    assert v1(spark, source="google") == "Other Referral"
    assert v3(spark, source="google") == "Organic Search - Google"
    assert v1(spark, source="google", campaign="spring") == "Organic Search - Google"
    assert v3(spark, source="google", campaign="x.ch.y") == "Other Referral"


def test_underscore_is_a_wildcard_and_quote_is_literal(spark):
    assert v1(spark, medium="display", campaign="ch.displayX1") == "Display"
    assert v1(spark, medium="ppc", source='ch.sem_"a') == "Paid Search"
    assert v1(spark, medium="ppc", source="ch.sem_a") == "Other Referral"


def test_first_rule_wins(spark):
    assert v1(spark, medium="paidsocial", source="facebook", campaign="ch.quora") == "Paid Social - Facebook"
    assert v1(spark, source="facebook", campaign="ch.quora") == "Paid Social - Quora"
    assert v3(spark, medium="email", source="facebook") == "Email"


@pytest.mark.parametrize(
    "fields, expected",
    [
        ({}, "No Referral"),
        ({"anonymous_id": "a"}, "Direct - because null utms"),
        ({"referrer": "NA"}, "Other Referral: referrer-acros-domains"),
        ({"referrer": "https://news.example.org"}, "Other Referral"),
        ({"referrer": "https://lnkd.in/x"}, "Organic Social - LinkedIn"),
        ({"referrer": "https://m.youtube.com"}, "Organic - Youtube"),
        ({"referrer": "https://search.yahoo.com", "campaign": "x.ch.y"}, "Other Referral"),
        ({"referrer": "https://search.yahoo.com"}, "Organic Search - Other"),
        ({"referrer": "https://www.google.de"}, "Organic Search - Google"),
        ({"medium": '["sem","sem"]', "source": '["google","google"]'}, "Paid Search - Google"),
        ({"medium": "sem", "source": "x,bing"}, "Paid Search - Bing"),
        ({"medium": "a,sem"}, "Paid Search - Other"),
        ({"medium": "partner_referral"}, "Partner Referral"),
        ({"source": "aws_marketplace"}, "Partner Referral"),
        ({"medium": "x"}, "Other Referral"),
    ],
)
def test_signup_rules(spark, fields, expected):
    assert v3(spark, **fields) == expected


def tactic(spark, **fields):
    names = ("tactic", "campaign_name", "utm_medium", "utm_source", "utm_campaign", "web_channel", "web_channel_campaign",
             "web_channel_medium", "web_channel_source")
    df = spark.createDataFrame([tuple(fields.get(n) for n in names)], ", ".join(f"{n} string" for n in names))
    from waymark.plans.campaign import tactic_channels

    row = one(tactic_channels(df.withColumn("interaction_date", F.lit(fields.get("day", "2021-01-01")).cast("date"))))
    return row["channel_detail"], row["channel"], row["channel_aggregate"]


def test_tactic_rules(spark):
    assert tactic(spark, tactic="Tradeshow")[0] == "Tradeshow"
    assert tactic(spark, tactic="Workshop", day="2020-03-31")[0] == "Workshop"
    assert tactic(spark, tactic="Workshop", day="2020-04-01") == ("No Referral", "No Referral", "No Referral")
    assert tactic(spark, tactic="Annual Summit", campaign_name="Annual Summit 2019")[0] == "Annual Summit"
    assert tactic(spark, tactic="Annual Summit", campaign_name="Annual Summit 2020")[0] == "No Referral"
    assert tactic(spark, utm_medium="gmail") == ("Paid Gmail", "Display", "Paid Media")
    assert tactic(spark, web_channel="Paid Email", web_channel_source="x")[0] == "Paid Gmail"
    assert tactic(spark, web_channel="Other", web_channel_medium="referral") == ("Other Referral", "Referral", "Non Paid Web")
    assert tactic(spark, web_channel="Else", web_channel_source="x") == ("Organic Web", "Organic Web", "Non Paid Web")


@pytest.mark.parametrize(
    "url, cleaned", [("http://h/p?a=1", "http://h/p"), ("a?b?c", "ab"), ("u?", "u"), ("plain", "plain"), ("x?x", ""), (None, None)]
)
def test_clean_url(spark, url, cleaned):
    df = spark.createDataFrame([(url,)], "url string")
    assert one(df.select(text.clean_url(F.col("url"))))[0] == cleaned


def test_url_sections_count_the_host(spark):
    df = spark.createDataFrame([("https://h/x/y",), ("https://h",), ("a/b/my-download/z",)], "url string")
    rows = [tuple(r) for r in web.url_columns(df).select("url_section_1", "url_section_2", "url_section_3").collect()]
    assert rows == [("/h", "/x", "/y"), ("/h", "/homepage", "/homepage"), ("/get-started", "/z", "/homepage")]


def test_unmapped_detail(spark):
    df = spark.createDataFrame([("Zzz",), (None,)], "channel_detail string")
    mapping = spark.createDataFrame([("A", "B", "C")], "detail string, channel string, channel_aggregate string")
    assert [r["channel"] for r in web.roll_up(df, mapping).collect()] == ["Zzz", None]
    assert [r["channel"] for r in web.roll_up(df, mapping, parity=True).collect()] == ["channel_detail", None]


def test_lead_routed_both_ways(spark):
    leads = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, ts("2024-01-01"))], "id string, lsm_score double, first_routed_at timestamp")
    assert [r["lead_routed"] for r in inquiry.lead_scores(leads).collect()] == ["No", "Yes"]
    assert [r["lead_routed"] for r in inquiry.lead_scores(leads, parity=True).collect()] == ["Yes", "No"]


def test_visit_without_session_merges_into_one_row(spark):
    pages = spark.createDataFrame(
        [("p1", "v", None, ts("2024-01-10"), "d", "u")],
        "page_visit_id string, visitor_id string, session_id string, visit_start_time timestamp, domain string, url string",
    )
    leads = spark.createDataFrame([("v", "L", "d")], "anonymous_id string, lead_or_contact_id string, source string")
    member = "campaign_member_id string, lead_or_contact_id string, inquiry_date_time timestamp, campaign_type string"
    funnel = spark.createDataFrame(
        [("M", "L", ts("2024-01-11"), "Cloud Sign-Up", None, None, None)],
        member + ", mql_date_time timestamp, sqm_date_time timestamp, sao_date_time timestamp",
    )
    asked = spark.createDataFrame([("M", "L", ts("2024-01-11"), "Cloud Sign-Up")], member)
    rows = dashboard.web_dashboard(pages, leads, funnel, asked, dt.date(2024, 2, 15), domains=["d"]).collect()
    assert len(rows) == 1
    assert (rows[0]["session_id"], rows[0]["flg_cloud_signup"], rows[0]["flg_1d_inq"]) == ("Null ", 1, 1)


def test_whole_days_reach_just_under_eight(spark):
    def matched(hours):
        visits = spark.createDataFrame([("p", "L", ts("2024-01-10"))], "page_visit_id string, lead_or_contact_id string, visit_start_time timestamp")
        at = ts("2024-01-10") + dt.timedelta(hours=hours)
        funnel = spark.createDataFrame(
            [("M", "L", at, None, None, None)],
            "campaign_member_id string, lead_or_contact_id string, inquiry_date_time timestamp, mql_date_time timestamp,"
            " sqm_date_time timestamp, sao_date_time timestamp",
        )
        return one(dashboard.visit_inquiries(visits, funnel))["campaign_member_id"] is not None

    assert [matched(h) for h in (-192, -191, 0, 191, 192)] == [False, True, True, True, False]


ORG = "org_id long, created_at timestamp, first_user_id long, email string"
TOUCH = "utm_campaign string, utm_medium string, utm_source string, referrer string, anonymous_id string, timestamp timestamp"


def _touch(spark, identifies, socials=(), clouds=(), **options):
    cohort = spark.createDataFrame([(1, ts("2024-01-10 12:00"), 7, "e")], ORG)
    i = spark.createDataFrame(list(identifies), "email string, ga_cid string, session_id string, " + TOUCH)
    s = spark.createDataFrame(list(socials), "user_id long, " + TOUCH)
    c = spark.createDataFrame(list(clouds), "user_id long, " + TOUCH)
    return signup.signup_touch(cohort, i, s, c, **options).collect()


def test_nearest_touch_without_fields_drops_the_org_unless_eligible_first(spark):
    touches = [
        ("e", "g1", "s1", None, None, None, None, "near", ts("2024-01-10 11:50")),
        ("e", "g2", "s2", "camp", None, None, None, "far", ts("2024-01-10 13:30")),
    ]
    assert _touch(spark, touches) == []
    found = _touch(spark, touches, eligible_first=True)
    assert [(r["anonymous_id"], r["delta_signup_touch_min"]) for r in found] == [("far", -90)]


def test_two_hours_reach_just_under_three(spark):
    def found(at):
        return len(_touch(spark, [("e", "g", "s", "c", None, None, None, "a", ts(at))]))

    assert [found(f"2024-01-10 {h}") for h in ("09:00:00", "09:00:01", "14:59:59", "15:00:00")] == [0, 1, 1, 0]


def test_touch_precedence_and_labels(spark):
    identify = ("e", "g", "s", None, "m1", None, None, "a1", ts("2024-01-10 11:00"))
    social = (7, "c2", "m2", None, None, "a2", ts("2023-06-01"))
    cloud = (7, "c3", "m3", "s3", None, "a3", ts("2024-01-10 12:30"))
    row = _touch(spark, [identify], [social], [cloud])[0]
    assert [row[c] for c in ("utm_campaign", "utm_medium", "utm_source", "anonymous_id", "cloud_anonymous_id")] == ["c2", "m1", "s3", "a1", "a3"]
    assert row["flg_social_signup"] == "social signup"
    assert _touch(spark, [identify], [], [cloud])[0]["flg_social_signup"] == "direct"
    assert _touch(spark, [], [], [cloud])[0]["flg_social_signup"] is None


def test_keep_one_lead_per_org_is_stable(spark):
    signups = spark.createDataFrame(
        [(1, "e", "e", None, None, ts("2024-01-10"))],
        "org_id long, signup_email string, merged_email string, master_email string, master_lead_id string, signed_up_at timestamp",
    )
    people = spark.createDataFrame(
        [("b", "e", "lead", ts("2024-01-01")), ("a", "e", "lead", ts("2024-01-01")), ("late", "e", "lead", ts("2024-01-12"))],
        "id string, email string, origin string, lead_create_ts timestamp",
    )
    assert sorted(r["lead_or_contact_id"] for r in assist.signup_leads(signups, people).collect()) == ["a", "b"]


def test_lead_up_to_two_days_after_signup_counts(spark):
    signups = spark.createDataFrame(
        [(1, "e", "e", None, None, ts("2024-01-10"))],
        "org_id long, signup_email string, merged_email string, master_email string, master_lead_id string, signed_up_at timestamp",
    )
    people = spark.createDataFrame(
        [("in", "e", "lead", ts("2024-01-11 23:00")), ("out", "e", "lead", ts("2024-01-12 00:00"))],
        "id string, email string, origin string, lead_create_ts timestamp",
    )
    assert [r["lead_or_contact_id"] for r in assist.signup_leads(signups, people).collect()] == ["in"]


def test_promo_without_activity(spark):
    signups = spark.createDataFrame([(1, "L", ts("2024-01-10"))], "org_id long, lead_or_contact_id string, signed_up_at timestamp")
    promos = spark.createDataFrame(
        [(1, "P", ts("2024-01-05"), 9, "u", "m")],
        "org_id long, promo_code string, promo_created_at timestamp, promo_owner long, promo_user string, promo_manager string",
    )
    none = spark.createDataFrame(
        [], "org_id long, activity_at timestamp, owner_id long, user_name string, manager_name string, is_csdr int"
    )
    published = one(assist.earliest_assist(signups, promos, none))
    assert (published["assist_owner"], published["assisted_orig"]) == (None, None)
    fixed = one(assist.earliest_assist(signups, promos, none, null_safe=True))
    assert (fixed["assist_owner"], fixed["assisted_orig"], fixed["first_act_date"]) == (9, "promo_code", dt.date(2024, 1, 5))


def test_call_and_mail_have_their_own_limits(spark):
    signups = spark.createDataFrame([(1, "L", ts("2024-02-10 12:00"))], "org_id long, lead_or_contact_id string, signed_up_at timestamp")
    acts = [
        ("L", None, "x [Call] y", ts("2024-01-26 08:00"), 1),
        ("L", None, "x [Call] y", ts("2024-01-25 20:00"), 2),
        ("L", None, "EMAIL", ts("2024-01-11 08:00"), 3),
        ("L", None, "EMAIL", ts("2024-01-10 20:00"), 4),
        ("L", None, "EMAIL", ts("2024-02-10 12:00"), 5),
        (None, "L", "EMAIL", ts("2024-02-10 11:59"), 6),
    ]
    df = spark.createDataFrame(acts, "lead_id string, contact_id string, subject string, activity_at timestamp, owner_id long")
    df = df.withColumns({"user_name": F.lit("u"), "manager_name": F.lit("m"), "is_csdr": F.lit(0)})
    pairs = assist.qualifying_pairs(signups, df)
    assert sorted(r["owner_id"] for r in pairs.collect()) == [1, 3, 6]
    longer = assist.qualifying_pairs(signups, df, call_days=30)
    assert sorted(r["owner_id"] for r in longer.collect()) == [1, 2, 3, 6]
    assert one(assist.first_activity(pairs))["owner_id"] == 3


def test_asof_country_with_fallback(spark):
    visits = spark.createDataFrame(
        [(f"p{d}", "ip", ts(f"2024-01-0{d} 08:00")) for d in (1, 2, 4, 6)], "page_visit_id string, context_ip string, visit_start_time timestamp"
    )
    history = spark.createDataFrame(
        [("ip", ts(f"2024-01-0{d} 20:00"), f"c{d}", f"n{d}") for d in (2, 5)],
        "ip string, execution_ts timestamp, country string, country_name string",
    )
    found = {r["page_visit_id"]: r["country"] for r in identity.country_of_visit(visits, history).collect()}
    assert found == {"p1": "c2", "p2": "c2", "p4": "c2", "p6": "c5"}
    strict = {r["page_visit_id"]: r["country"] for r in identity.country_of_visit(visits, history, fallback=False).collect()}
    assert strict == {"p1": None, "p2": "c2", "p4": "c2", "p6": "c5"}


TOUCHED = (
    "org_id long, created_at timestamp, channel_detail string, channel string, channel_aggregate string, channel_source string,"
    " channel_medium string, channel_campaign string, session_id string, ga_client_id string, url string, hostname string,"
    " delta_signup_touch_hour int"
)


def test_linear_credit(spark):
    base = (1, ts("2024-01-10"), "d", "c", "a", "s", "m", "k")
    # One page seen twice in a session is one touch; a view six hours before the signup is none.
    seen = [("s1", "g", "u", "h", 40), ("s1", "g", "u", "h", 39), ("s2", "g", "u", "h", 7), ("s3", "g", "u", "h", 6)]
    web_touches = spark.createDataFrame([base + s for s in seen], TOUCHED)
    last = spark.createDataFrame([base + (None, None, None, None, None)], TOUCHED)
    touches = signup.linear_touches(web_touches, last)
    funnel = spark.createDataFrame(
        [(1, ts("2024-01-10"), ts("2024-01-17"), ts("2024-01-25")), (2, ts("2024-01-10"), None, ts("2024-01-24"))],
        "org_id long, signed_up_at timestamp, usage_at timestamp, product_active_at timestamp",
    )
    rows = signup.credit_on_activation(touches, funnel).collect()
    first = [r for r in rows if r["org_id"] == 1]
    assert [round(r["linear_credit"], 6) for r in first] == [0.333333] * 3
    assert all(r["linear_credit_oa"] == r["linear_credit"] and r["linear_credit_pao"] is None for r in first)
    (second,) = [r for r in rows if r["org_id"] == 2]
    assert (second["linear_credit"], second["channel"], second["linear_credit_oa"], second["linear_credit_pao"]) == (1.0, "No Referral", None, 1.0)


def test_reconcile_takes_the_credit(spark):
    base = (1, ts("2024-01-10"), "d", "c", "a", "s", "m", "k")
    web_touches = spark.createDataFrame([base + ("s1", "g", "u", "h", 40), base + ("s2", "g", "u", "h", 9)], TOUCHED)
    funnel = spark.createDataFrame(
        [(1, ts("2024-01-10"), None, None)], "org_id long, signed_up_at timestamp, usage_at timestamp, product_active_at timestamp"
    )
    ours = signup.credit_on_activation(signup.linear_touches(web_touches, web_touches.limit(0)), funnel)
    theirs = spark.createDataFrame(
        [(1, "g", "s1", "u", "h", "e"), (2, "g", "s9", "u", "h", "f")],
        "org_id long, ga_client_id string, session_id string, url string, hostname string, channel_detail string",
    )
    rows = {r["session_id"]: r for r in signup.reconcile_attributions(ours, theirs).collect()}
    assert {k: (r["channel_detail_lt"], r["channel_detail_ga"], r["linear_credit"]) for k, r in rows.items()} == {
        "s1": ("d", "e", 0.5),
        "s2": ("d", None, 0.5),
        "s9": (None, "f", None),
    }


def test_first_user_has_a_user_row(spark):
    users = spark.createDataFrame([(2, "b@x", ts("2024-01-01"))], "id long, email string, created_at timestamp")
    memberships = spark.createDataFrame(
        [(9, 1, ts("2024-01-01")), (9, 2, ts("2024-01-02"))], "org_id long, user_id long, created_at timestamp"
    )
    assert one(identity.first_user_per_org(users, memberships))["user_id"] == 2


def test_an_event_loaded_twice_is_a_bounce(spark):
    rows = spark.createDataFrame(
        [("a", "v", "s", ts("2024-01-01 10:00"), "https://www.example.com/a", None, None, None, None, None)],
        "page_visit_id string, visitor_id string, session_id string, visit_start_time timestamp, url string, referrer string,"
        " utm_source string, utm_medium string, utm_campaign string, user_id string",
    )
    log = web.PageLog(rows, {c: c for c in rows.columns}, "www.example.com")
    fact = one(web.page_visit_fact([log, log], web.visitor_dimension(rows), dt.date(2024, 1, 2)))
    assert (fact["is_bounce"], fact["rank_from_end"]) == ("True", 1)


def test_two_grants_share_a_total_unless_told_apart(spark):
    grants = spark.createDataFrame(
        [(1, dt.date(2024, 1, 2)), (1, dt.date(2024, 2, 1))], "org_id long, credit_expiration_date date"
    )
    billing = spark.createDataFrame(
        [(1, dt.date(2024, 1, d), -60.0, "PromoCredit", "PAYG") for d in (1, 2, 3)],
        "org_id long, date date, bill_amount_usd double, metric_type string, commercial_model string",
    )

    def totals(**how):
        rows = credits.burn_down(grants, billing, **how).collect()
        return sorted((r["date"].day, r["credit_expiration_date"].month, r["running_total"]) for r in rows)

    assert totals() == [(1, 1, -60.0), (1, 2, -120.0), (2, 1, -180.0), (2, 2, -240.0), (3, 2, -300.0)]
    assert totals(per_grant=True) == [(1, 1, -60.0), (1, 2, -60.0), (2, 1, -120.0), (2, 2, -120.0), (3, 2, -180.0)]


def test_bounce_and_edges(spark):
    pages = spark.createDataFrame(
        [("a", "v", "one", ts("2024-01-01 10:00"))] + [(f"b{i}", "v", "three", ts(f"2024-01-01 1{i}:00")) for i in range(3)],
        "page_visit_id string, visitor_id string, session_id string, visit_start_time timestamp",
    )
    out = web.sequence_pages(pages).withColumns(web.edge_flags())
    flags = {r["page_visit_id"]: (r["is_entrance"], r["is_exit"], r["is_bounce"], r["visit_length"]) for r in out.collect()}
    assert flags == {
        "a": ("True", "True", "True", None),
        "b0": ("True", "False", "False", 3600),
        "b1": ("False", "False", "False", 3600),
        "b2": ("False", "True", "False", None),
    }


def test_burn_down_thresholds(spark):
    grants = spark.createDataFrame([(1, dt.date(2024, 2, 1))], "org_id long, credit_expiration_date date")
    billing = spark.createDataFrame(
        [(1, dt.date(2024, 1, d), -x, "PromoCredit", "PAYG") for d, x in ((1, 60.0), (2, 60.0), (3, 90.0))]
        + [(1, dt.date(2024, 1, 1), -500.0, "Usage", "PAYG"), (1, dt.date(2024, 3, 1), -500.0, "PromoCredit", "PAYG")],
        "org_id long, date date, bill_amount_usd double, metric_type string, commercial_model string",
    )
    row = one(credits.threshold_dates(credits.burn_down(grants, billing)))
    assert [row[f"date_reach_{t}"] for t in (100, 200, 300)] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3), None]


def test_derived_medium(spark):
    df = spark.createDataFrame(
        [(None, "https://www.google.com", "M"), (None, None, "M"), (None, "https://x", "Mm"), ("c", None, "Mm")],
        "c string, r string, m string",
    )
    out = df.select(marketing.derived_medium(F.col("c"), F.col("r"), F.col("m")))
    assert [r[0] for r in out.collect()] == ["organic_search", "direct", "mm", "mm"]


def test_interaction_time(spark):
    from waymark.plans.campaign import interaction_time

    df = spark.createDataFrame(
        [
            (ts("2024-01-10 10:00:30"), ts("2024-01-11 23:00"), "x"),
            (ts("2024-01-10 10:00:30"), ts("2024-01-12 01:00"), "x"),
            (ts("2024-01-10 10:00:30"), ts("2024-01-10 09:00"), "PG Prospecting Days"),
            (ts("2024-01-10 10:00:30"), None, "x"),
        ],
        "c timestamp, a timestamp, t string",
    )
    out = [r[0] for r in df.select(interaction_time(F.col("c"), F.col("a"), F.col("t"))).collect()]
    assert out == [ts("2024-01-10 10:00"), ts("2024-01-12 01:00"), ts("2024-01-10 09:00"), ts("2024-01-10 10:00")]


def test_not_in_with_null_on_the_right(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(1,), (None,)], "k long")
    assert quality.missing_keys(left, right, "k", strict_null=True).count() == 0
    assert sorted(str(r[0]) for r in quality.missing_keys(left, right, "k").collect()) == ["2", "None"]
    assert [r[0] for r in quality.missing_keys(left, right.dropna(), "k", strict_null=True).collect()] == [2]
    assert quality.missing_keys(left, right.limit(0), "k", strict_null=True).count() == 3


def test_first_signup_rank_per_org(spark):
    users = spark.createDataFrame([(i, f"e{i}", ts(f"2024-01-0{i}")) for i in (1, 2, 3)], "id long, email string, created_at timestamp")
    members = spark.createDataFrame([(9, i, ts("2024-02-01")) for i in (3, 1, 2)], "org_id long, user_id long, created_at timestamp")
    orgs = spark.createDataFrame([(9, True, "Product-Led", None)], "id long, is_customer boolean, motion string, deactivated_at timestamp")
    people = spark.createDataFrame([("L1", "e1", "lead", ts("2024-01-01"))], "id string, email string, origin string, lead_create_ts timestamp")
    out = identity.org_to_person_product_led(users, members, orgs, people, "%@service")
    assert {r["user_id"]: r["rnk_is_first_signup"] for r in out.collect()} == {1: 1, 2: 2, 3: 3}


def test_a_fixed_list_names_the_managers(spark):
    snapshots = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "Ann", assist.ROLES[0], 2), (2, dt.date(2024, 1, 1), "Boss", "VP", None)],
        "id long, day date, name string, role string, manager_id long",
    )
    promos = spark.createDataFrame(
        [(9, "p", "p1", "Claimed", 1, ts("2024-01-01 10:00"))],
        "org_id long, promo_code string, promo_code_id string, status string, creator_id long, promo_created_at timestamp",
    )
    listed = spark.createDataFrame([("Ann", "Chief")], "sdr_name string, manager_name string")
    assert one(assist.first_promo(promos, snapshots))["promo_manager"] == "Boss"
    assert one(assist.first_promo(promos, snapshots, managers=listed))["promo_manager"] == "Chief"


def test_versions_read_only_buckets_that_differ(spark, tmp_path):
    old = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS a", "CAST(NULL AS STRING) AS b")
    new = old.withColumn("b", F.expr("CASE WHEN id = 7 THEN a END")).withColumn("a", F.expr("CASE WHEN id <> 7 THEN a END"))
    for df, name in ((old, "old"), (new, "new"), (old, "same")):
        versions.write_version(df, f"{tmp_path}/{name}", ["id"], buckets=16)
    found = versions.changes(spark, f"{tmp_path}/old", f"{tmp_path}/new", ["id"])
    assert [tuple(r) for r in found.collect()] == [(7, "changed", ["a", "b"])]
    assert len(versions.differing_buckets(spark, f"{tmp_path}/old", f"{tmp_path}/new")) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    (bucket,) = versions.differing_buckets(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    assert filters and all(re.search(rf"PartitionFilters: \[.*\(__bucket#\d+ = {bucket}\)\]", line) for line in filters)
    assert versions.changes(spark, f"{tmp_path}/old", f"{tmp_path}/same", ["id"]).count() == 0


def test_versions_of_repeated_and_new_columns(spark, tmp_path):
    old = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id long, a string")
    new = spark.createDataFrame([(2, None, None), (3, "y", 5), (4, "z", None)], "id long, a string, c int")
    versions.write_version(old, f"{tmp_path}/old", ["id"])
    versions.write_version(new, f"{tmp_path}/new", ["id"])
    found = versions.changes(spark, f"{tmp_path}/old", f"{tmp_path}/new", ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, "removed", None), (3, "changed", ["c"]), (4, "added", None)]


def test_counted_stage(spark):
    counted = sinks.CountedStage()
    kept = counted(spark.range(10).filter("id > 3"), "some")
    counted(kept.filter("id > 100"), "none")
    assert [tuple(r) for r in counted.counts(spark).collect()] == [("some", 6), ("none", 0)]


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_validity_intervals(spark, hot_rows):
    rows = [("k", 1, "a"), ("k", 2, "a"), ("k", 3, None), ("k", 4, None), ("k", 5, "a"), ("k", 5, "b"), ("k", 5, "b"), ("j", 9, None), ("j", None, "z")]
    history = spark.createDataFrame(rows, "key string, at long, v string")
    found = validity_intervals(history, ["key"], "at", ["v"], hot_rows=hot_rows)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("k", "a", 1, 3), ("k", None, 3, 5), ("k", "b", 5, None), ("j", None, 9, None)], key=str
    )
    asked = spark.createDataFrame([("k", 0), ("k", 2), ("k", 4), ("k", 99), ("j", 9), ("none", 1)], "key string, t long")
    held = {(r.key, r.t): r.v for r in valid_at(asked, found, ["key"], "t", ["v"], hot_rows=hot_rows).collect()}
    assert held == {("k", 0): None, ("k", 2): "a", ("k", 4): None, ("k", 99): "b", ("j", 9): None, ("none", 1): None}


def test_merges_in_a_circle_end(spark):
    def at(day):
        return dt.datetime(2024, 1, day)

    rows = [("a", "ea", "b", "eb", at(1)), ("b", "eb", "c", "ec", at(2)), ("c", "ec", "a", "ea", at(3)), ("d", "ed", "a", "ea", at(1)), ("x", "ex", "y", "ey", at(5))]
    merges = spark.createDataFrame(rows, "deleted_lead_id string, deleted_email string, master_lead_id string, master_email string, merged_at timestamp")
    found = {r.deleted_lead_id: (r.master_lead_id, r.master_email) for r in identity.last_survivors(merges).collect()}
    assert found == {"a": ("a", "ea"), "b": ("a", "ea"), "c": ("a", "ea"), "d": ("a", "ea"), "x": ("y", "ey")}
    assert identity.last_survivors(merges.limit(0)).count() == 0
