"""One row written by hand for each rule, with the label the published statements give it."""

from waymark.operators import first_match
from waymark.plans import rulesets, signup, web

WEB = [
    # medium, source, campaign, label
    ("PaidSocial", "m.facebook.com", None, "Paid Social - Facebook"),
    ("paidsocial", "twitter", "x", "Paid Social - Twitter"),
    ("paidsocial", "linkedin-ads", None, "Paid Social - LinkedIn"),
    ("cpc", "quora", "q.CH.quora.1", "Paid Social - Quora"),
    ("paidsocials", "facebook", None, "Organic Social - Facebook"),
    (None, "TWITTER.com", None, "Organic Social - Twitter"),
    ("referral", "linkedin", None, "Organic Social - LinkedIn"),
    ("display", "dsp", "ch.display_spring", "Display"),
    ("ppc", 'ch.sem_"brand"', None, "Paid Search"),
    ("sem", "google", "ch.sem", "Paid Search - Google"),
    ("sem", "bing", None, "Paid Search - Bing"),
    ("sem", None, None, "Paid Search - Other"),
    ("gmail", "google", None, "Paid Gmail"),
    ("nurtureemail", None, "tm.lifecycle.1", "Nurture - Lifecycle"),
    ("nurtureemail", None, "tm.campaigns.1", "Nurture - Global Campaigns"),
    ("nurtureemail", None, "tm.global-campaigns", "Nurture - Global Campaigns"),
    (None, "mail", "a-reduce-your-tco-b", "Nurture - Global Campaigns"),
    ("web", None, "x-ebook-retail", "Nurture - Global Campaigns"),
    ("nurtureemail", None, "other", "Email"),
    (None, "(direct)", None, "Direct"),
    ("x", "azure", None, "Partner Referral"),
    ("partner-referral", None, None, "Partner Referral"),
    (None, "cloud.google.com", None, "Partner Referral"),
    ("partners", None, None, "Partner Referral"),
    (None, "partner-x", None, "Partner Referral"),
    (None, "drift", None, "Own website"),
    (None, None, "a.type.community.b", "DevX Referral"),
    (None, "x", "tm.devx", "DevX Referral"),
    (None, None, "tech-tip.community", "DevX Referral"),
    (None, None, "ch.client-setup.community_content", "DevX Referral"),
    (None, "google", "spring", "Organic Search - Google"),
    ("organic", "bing", "spring", "Organic Search - Bing"),
    (None, "baidu", "spring", "Organic Search - Other"),
    ("referral", "google", None, "Other Referral"),
    ("referral", None, None, "Other Referral"),
    (None, "duckduckgo", "ch.x", "Other Referral"),
    ("display", None, "spring", "Other"),
    (None, None, "spring", "Other"),
    (None, None, None, "No Referral"),
]

SIGNUP = [
    # medium, source, campaign, referrer, anonymous_id, label
    ("x,paidsocial", "facebook", None, None, None, "Paid Social - Facebook"),
    ("paidsocial", "twitter", None, None, None, "Paid Social - Twitter"),
    ("paidsocial", "linkedin", None, None, None, "Paid Social - LinkedIn"),
    (None, None, "ch.quora", None, None, "Paid Social - Quora"),
    ("ppc", None, 'ch.sem_"a', None, None, "Paid Search"),
    ("sem", "google", None, None, None, "Paid Search - Google"),
    ('["sem"]', '["bing"]', None, None, None, "Paid Search - Bing"),
    ("sem,x", "yahoo", None, None, None, "Paid Search - Other"),
    ("gmail", None, None, None, None, "Paid Gmail"),
    ("a nurtureemail b", None, "tm.lifecycle", None, None, "Nurture - Lifecycle"),
    ("nurtureemail", None, "tm.campaigns", None, None, "Nurture - Global Campaigns"),
    (None, None, "transform-your-business", None, None, "Nurture - Global Campaigns"),
    (None, None, "exec-report-insurance", None, None, "Nurture - Global Campaigns"),
    ("e-email", "twitter", None, None, None, "Email"),
    (None, "(direct)", None, None, None, "Direct"),
    ("direct", None, None, None, None, "Direct"),
    (None, "gcp", None, None, None, "Partner Referral"),
    ("partner_referral", None, None, None, None, "Partner Referral"),
    (None, "aws_marketplace", None, None, None, "Partner Referral"),
    (None, "webiste", None, None, None, "Own website"),
    (None, None, "type.community", None, None, "DevX Referral"),
    (None, None, "tm.devx", None, None, "DevX Referral"),
    (None, None, "tech-tip.community", None, None, "DevX Referral"),
    (None, None, "ch.iot-streams.community_content", None, None, "DevX Referral"),
    (None, None, None, "https://www.facebook.com/", None, "Organic Social - Facebook"),
    (None, "twitter", None, None, None, "Organic Social - Twitter"),
    (None, None, None, "https://lnkd.in/x", None, "Organic Social - LinkedIn"),
    (None, None, None, "https://www.reddit.com/r", None, "Organic Social - Other"),
    ("display", None, "ch.display_x", None, None, "Display"),
    (None, "google", None, None, None, "Organic Search - Google"),
    (None, None, None, "https://www.bing.com", None, "Organic Search - Bing"),
    (None, None, None, "https://www.google.fr", None, "Organic Search - Google"),
    (None, "baidu", None, None, None, "Organic Search - Other"),
    (None, None, None, "https://www.youtube.com", None, "Organic - Youtube"),
    (None, None, None, "https://x/project.example.org/y", None, "Organic Search - Project Website"),
    ("referral", None, None, None, None, "Other Referral"),
    (None, "blog", None, None, None, "Other Referral"),
    (None, None, None, "NA", "a", "Other Referral: referrer-acros-domains"),
    (None, None, None, "https://blog.example.org", "a", "Other Referral"),
    (None, None, None, None, "a", "Direct - because null utms"),
    (None, None, None, None, None, "No Referral"),
    (None, None, "spring", None, "a", "Other Referral"),
]

GROUPS = [
    # tactic, campaign_team, group, team
    ("Cloud Sign-Up", "Partner", "Partner Cloud Signup", "Partner Marketing"),
    ("Cloud Sign-Up", "Field Marketing", "Growth Cloud Signup", "Growth"),
    ("Webinar", "Partner", "Partner Webinar", "Partner Marketing"),
    ("Webinar", "Field Marketing", "FM Total", "GRM"),
    ("Webinar", None, "Growth Webinar", "Growth"),
    ("Annual Summit", "Partner", "Annual Summit", "GRM"),
    ("Paid Media", "Partner", "Online Collateral and Other Web", "Growth"),
    ("Roundtable", "Strategic Events", "Other Strategic Event", "GRM"),
    ("Forum", None, "FM Total", "GRM"),
    ("Roundtable", "Field Marketing", "FM Total", "GRM"),
    ("Roundtable", "Global Campaigns", "Global Campaigns", "GRM"),
    ("Online Collateral", "Partner", "Partner Online Collateral", "Partner Marketing"),
    ("Roundtable", "Partner", "Other Partner Marketing", "Partner Marketing"),
    ("Roundtable", "Revenue Marketing Cloud Partner", "Online Collateral and Other Web", "GRM"),
    (None, None, "Online Collateral and Other Web", "Growth"),
]


def _frame(spark, rows, *names):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))


def _wrong(df, *pairs):
    return [r for r in df.orderBy("i").collect() if any(r[found] != r[label] for found, label in pairs)]


def test_page_view_rules(spark):
    # The rules take no upper case; the tags are lower-cased as in the fact.
    df = _frame(spark, WEB, "utm_medium", "utm_source", "utm_campaign", "label").selectExpr("*", "CAST(NULL AS STRING) AS referrer")
    out = web.channel_detail(
        web.tag_columns(df).selectExpr("* EXCEPT (utm_medium, utm_source)", "lower(utm_medium) AS utm_medium", "lower(utm_source) AS utm_source"),
        rulesets.web_channel_rules(), rulesets.WEB_DEFAULT, web.TAG_FIELDS,
    )
    assert _wrong(out, ("channel_detail", "label")) == []
    assert {r.label for r in rulesets.web_channel_rules()} <= {r[-1] for r in WEB}


def test_signup_rules(spark):
    names = ("medium", "source", "campaign", "referrer", "anonymous_id")
    df = _frame(spark, SIGNUP, *names, "label")
    out = df.withColumn("found", first_match(rulesets.signup_channel_rules(), signup.NO_TOUCH))
    assert _wrong(out, ("found", "label")) == []
    assert {r.label for r in rulesets.signup_channel_rules()} <= {r[-1] for r in SIGNUP}


def test_tactic_groups_and_teams(spark):
    df = _frame(spark, GROUPS, "tactic", "campaign_team", "grp", "team")
    out = df.withColumns(
        {
            "found_group": first_match(rulesets.tactic_group_rules(), rulesets.TACTIC_GROUP_DEFAULT),
            "found_team": first_match(rulesets.tactic_team_rules(), rulesets.TACTIC_TEAM_DEFAULT),
        }
    )
    assert _wrong(out, ("found_group", "grp"), ("found_team", "team")) == []
