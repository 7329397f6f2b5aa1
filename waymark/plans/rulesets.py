"""Channel rules and campaign buckets.

Rules read the lower-cased fields ``medium``, ``source``, ``campaign`` and, where named,
``referrer``, ``tactic``, ``web_channel`` and so on. Names of a company's own campaigns,
sites and events are not fixed: they come in through :class:`Vocabulary`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.operators.rules import Rule, any_of, has, is_in, is_null, lacks, like, present, rule


@dataclass(frozen=True)
class Vocabulary:
    """A company's own names, with invented defaults."""

    own_site_label: str = "Own website"
    own_source: str = "webiste"
    product_site: str = "app.example.com"
    chat: str = "drift"
    docs_site: str = "docs.example.com"
    developer_site: str = "developer.example.com"
    main_site: str = "example.com"
    project_site: str = "/project.example.org/"
    project_site_label: str = "Organic Search - Project Website"
    nurture_campaigns: tuple[str, ...] = ("transform-your-business", "reduce-your-tco")
    vertical_campaigns: tuple[str, ...] = ("then-and-now-banking", "exec-report-insurance", "ebook-retail")
    community_campaigns: tuple[str, ...] = ("ch.client-setup.community_content", "ch.iot-streams.community_content")
    summit: str = "Annual Summit"
    summit_virtual_years: tuple[str, ...] = ("2020", "2021")
    streaming_event: str = "Product Event"
    tour: str = "Product Tour"
    platform_download: str = "Platform Download"
    community_download: str = "Community Download"
    cloud_signup: str = "Cloud Sign-Up"
    devx_campaign_names: tuple[str, ...] = ("WP Tuning Your Deployment", "WP Monitoring Your Deployment")
    excluded_name_prefix: str = "FCI"

    @property
    def own_sources(self) -> tuple[str, ...]:
        """Sources that mean the company's own website."""
        return (self.own_source, self.product_site, self.chat)

    @property
    def own_sites(self) -> tuple[str, ...]:
        return (self.docs_site, self.developer_site, self.main_site)

    @property
    def no_touch_sources(self) -> tuple[str, ...]:
        """Sources of a signup that say nothing; the documentation sites do count as a touch."""
        return (self.main_site, self.product_site, self.chat)


DEFAULT = Vocabulary()

# Field values and patterns of the channel rules.
PAID_SOCIAL_SITES = {"facebook": "Facebook", "twitter": "Twitter", "linkedin": "LinkedIn"}
DISPLAY_CAMPAIGN = "ch.display_%"
SEM_SOURCE = 'ch.sem_"%'
LIFECYCLE_CAMPAIGN = "tm.lifecycle%"
GLOBAL_CAMPAIGNS = ("tm.global-campaigns%", "tm.campaigns%")
CLOUD_PROVIDERS = ("gcp", "aws", "azure")
MARKETPLACES = ("aws.amazon.com", "cloud.google.com", "azuremarketplace.microsoft.com")
DEVX_MARKERS = ("type.community", "tm.devx", "tech-tip.community")
PAID_MARKER = "ch."
SEARCH_ENGINES = ("google", "bing", "baidu", "duckduckgo")
NA_REFERRER = "NA"


def _nurture(v: Vocabulary, medium: str | None) -> list[Rule]:
    """Nurture campaigns; ``medium`` None requires the exact medium, else the contained text."""
    nurture = has("medium", medium) if medium else is_in("medium", "nurtureemail")
    return [
        rule("Nurture - Lifecycle", nurture, like("campaign", LIFECYCLE_CAMPAIGN)),
        rule("Nurture - Global Campaigns", nurture, like("campaign", *GLOBAL_CAMPAIGNS)),
        rule("Nurture - Global Campaigns", has("campaign", *v.nurture_campaigns)),
        rule("Nurture - Global Campaigns", has("campaign", *v.vertical_campaigns)),
    ]


def _devx(v: Vocabulary, campaign: str = "campaign") -> list[Rule]:
    return [
        *[rule("DevX Referral", has(campaign, marker)) for marker in DEVX_MARKERS],
        rule("DevX Referral", is_in(campaign, *v.community_campaigns)),
    ]


def web_channel_rules(v: Vocabulary = DEFAULT, direct_source: str = "(direct)") -> list[Rule]:
    """Channel of a page view from its tags alone.

    Organic search here needs a known campaign: ``lacks(..., known=True)`` is unknown for
    a missing one, so such visits become referrals. Apply to the derived medium with
    ``direct_source="direct"`` for the later form.
    """
    return [
        *[
            rule(f"Paid Social - {name}", is_in("medium", "paidsocial"), has("source", site))
            for site, name in PAID_SOCIAL_SITES.items()
        ],
        rule("Paid Social - Quora", has("campaign", "ch.quora")),
        *[rule(f"Organic Social - {name}", has("source", site)) for site, name in PAID_SOCIAL_SITES.items()],
        rule("Display", is_in("medium", "display"), like("campaign", DISPLAY_CAMPAIGN)),
        rule("Paid Search", is_in("medium", "ppc"), like("source", SEM_SOURCE)),
        rule("Paid Search - Google", is_in("medium", "sem"), is_in("source", "google")),
        rule("Paid Search - Bing", is_in("medium", "sem"), is_in("source", "bing")),
        rule("Paid Search - Other", is_in("medium", "sem")),
        rule("Paid Gmail", is_in("medium", "gmail")),
        *_nurture(v, None),
        rule("Email", has("medium", "email")),
        rule("Direct", is_in("source", direct_source)),
        rule("Partner Referral", is_in("source", *CLOUD_PROVIDERS)),
        rule("Partner Referral", is_in("medium", "partner-referral")),
        any_of(
            "Partner Referral",
            is_in("source", *MARKETPLACES),
            like("medium", "partner%"),
            like("source", "partner%"),
        ),
        rule(v.own_site_label, is_in("source", *v.own_sources)),
        *_devx(v),
        rule("Organic Search - Google", is_in("source", "google"), lacks("campaign", PAID_MARKER, known=True)),
        rule("Organic Search - Bing", is_in("source", "bing"), lacks("campaign", PAID_MARKER, known=True)),
        rule("Organic Search - Other", is_in("source", *SEARCH_ENGINES), lacks("campaign", PAID_MARKER, known=True)),
        rule("Other Referral", is_in("medium", "referral")),
        rule("Other Referral", present("source")),
        any_of("Other", present("medium"), present("campaign")),
    ]


WEB_DEFAULT = "No Referral"


def _listed(name: str, value: str, *, closing: bool = True) -> tuple:
    """``value`` alone, or inside a list kept as text such as ``["sem","sem"]`` or ``sem,sem``.

    With ``closing`` text may follow the value after a comma.
    """
    if closing:
        return is_in(name, value), has(name, f'"{value}"', f",{value}", f"{value},")
    return is_in(name, value), has(name, f'"{value}"', f"{value},"), like(name, f"%,{value}")


def _and(left: tuple, right: tuple) -> list[tuple]:
    return [(a, b) for a in left for b in right]


def signup_channel_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Channel of a signup from blended touches: referrer-aware, organic below paid.

    Reads ``medium``, ``source``, ``campaign``, ``referrer`` (``NA`` for an own site) and
    ``anonymous_id``.
    """
    sem = _listed("medium", "sem")
    google = _listed("source", "google", closing=False)
    bing = _listed("source", "bing")
    unpaid = lacks("campaign", PAID_MARKER)
    untagged = (is_null("source"), is_null("medium"), is_null("campaign"))
    return [
        *[
            rule(f"Paid Social - {name}", has("medium", "paidsocial"), has("source", site))
            for site, name in PAID_SOCIAL_SITES.items()
        ],
        rule("Paid Social - Quora", has("campaign", "ch.quora")),
        rule("Paid Search", is_in("medium", "ppc"), like("campaign", SEM_SOURCE)),
        any_of("Paid Search - Google", *_and(sem, google)),
        any_of("Paid Search - Bing", *_and(sem, bing)),
        any_of("Paid Search - Other", *sem),
        rule("Paid Gmail", is_in("medium", "gmail")),
        *_nurture(v, "nurtureemail"),
        rule("Email", has("medium", "email")),
        rule("Direct", is_in("source", "(direct)")),
        rule("Direct", is_in("medium", "direct")),
        rule("Partner Referral", is_in("source", *CLOUD_PROVIDERS)),
        rule("Partner Referral", is_in("medium", "partner-referral", "partner_referral")),
        any_of(
            "Partner Referral",
            is_in("source", *MARKETPLACES),
            like("medium", "partner%"),
            like("source", "partner%", "aws_marketplace"),
        ),
        rule(v.own_site_label, is_in("source", *v.own_sources)),
        *_devx(v),
        any_of("Organic Social - Facebook", has("source", "facebook"), has("referrer", "facebook.com")),
        any_of("Organic Social - Twitter", has("source", "twitter"), has("referrer", "twitter")),
        any_of("Organic Social - LinkedIn", has("source", "linkedin"), has("referrer", "linkedin", "lnkd.in")),
        rule("Organic Social - Other", has("referrer", "instagram.com", "reddit.com")),
        rule("Display", is_in("medium", "display"), like("campaign", DISPLAY_CAMPAIGN)),
        any_of("Organic Search - Google", *[(g, unpaid) for g in google]),
        any_of("Organic Search - Bing", *[(b, unpaid) for b in bing], has("referrer", "bing")),
        rule("Organic Search - Google", has("referrer", "www.google.")),
        any_of(
            "Organic Search - Other",
            (is_in("source", *SEARCH_ENGINES), unpaid),
            (has("referrer", "duckduckgo", "yahoo.com"), unpaid),
        ),
        rule("Organic - Youtube", has("referrer", "youtube")),
        rule(v.project_site_label, has("referrer", v.project_site)),
        rule("Other Referral", is_in("medium", "referral")),
        rule("Other Referral", present("source")),
        rule("Other Referral: referrer-acros-domains", *untagged, is_in("referrer", NA_REFERRER)),
        rule("Other Referral", *untagged, present("referrer")),
        rule("Direct - because null utms", *untagged, present("anonymous_id")),
        rule("No Referral", *untagged),
        any_of("Other Referral", present("medium"), present("campaign"), present("referrer")),
    ]


# Campaign types and formats.
TACTICS_KEPT = ("Tech Talk", "Tradeshow", "Forum", "Targeted Activity at Key Event")
CHANNEL_TYPES = ("Digital ABM", "Intent Leads", "Content Syndication")
WEB_CHANNELS_KEPT = ("Email", "Display", "Direct", "Organic Social", "Organic Video", "Paid Social", "Paid Search")
TYPES_NOT_ATTRIBUTED = (
    "Telemarketing",
    "Sales - Outbound Prospecting",
    "SDR - Outbound Prospecting",
    "Training",
    "Other",
    "List Buy",
    "Partner",
    "Legal",
    "Marketing - DO NOT ATTRIBUTE",
    "digital touch",
    "Email",
    "Email Nurture",
    "Campaigns Nurture",
    "Ungated Content",
)
FORMAT_WEB_TYPE = {"Virtual": "Web", "In Person": "Non-Web", "Hybrid": "Web"}
IN_PERSON_WORKSHOP_BEFORE = "2020-04-01"


def campaign_channel_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """First channel of a campaign touch, from its type and tags as stored (not lower-cased).

    Reads ``sfdc_campaign_type``, ``utm_medium``, ``utm_campaign`` and the lower-cased
    ``campaign``.
    """
    nurture = is_in("utm_medium", "nurtureemail")
    return [
        *[rule(t, is_in("sfdc_campaign_type", t)) for t in CHANNEL_TYPES],
        rule("Paid Search", is_in("utm_medium", "sem", "search")),
        rule("Paid Social", is_in("utm_medium", "paidsocial")),
        rule("Display", is_in("utm_medium", "display")),
        rule("Display", is_in("utm_medium", "gmail"), like("utm_campaign", "ch.gmail%")),
        rule("Nurture - Lifecycle", nurture, like("utm_campaign", LIFECYCLE_CAMPAIGN)),
        rule("Nurture - Global Campaigns", nurture, like("utm_campaign", *GLOBAL_CAMPAIGNS)),
        rule("Nurture - Global Campaigns", is_in("utm_medium", "email"), has("campaign", *v.nurture_campaigns)),
        rule("Nurture - Global Campaigns", has("campaign", *v.vertical_campaigns)),
    ]


def marketing_group_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Reads ``campaign_team`` and ``campaign_type``."""
    teams = {
        "Partner": "Partner Marketing",
        "Global Campaigns": "Global Campaigns",
        "Strategic Events": "Strategic Events",
        "Growth - Lifecycle": "Lifecycle Marketing",
        "Field Marketing": "Field Marketing",
    }
    owned = (
        "Online Collateral",
        "Contact Us",
        "Newsletter",
        v.platform_download,
        "Website Chat",
        "Request a Quote",
        "Recorded Video",
        v.community_download,
        "Webinar - Recorded",
        v.cloud_signup,
    )
    return [
        *[rule(group, is_in("campaign_team", team)) for team, group in teams.items()],
        rule("Paid Media", is_in("campaign_team", "Growth - Digital"), has("campaign_type", "Paid")),
        rule("Email Marketing", has("campaign_type_lower", "email")),
        rule("Owned Media", is_in("campaign_type", *owned)),
    ]


def web_type_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Reads ``campaign_type`` and ``campaign_format``."""
    web = (
        "Online Collateral",
        "Webinar - Live",
        v.platform_download,
        v.cloud_signup,
        "Webinar - Recorded",
        "Website Chat",
        "Newsletter",
        "Contact Us",
        "Content Syndication",
        v.community_download,
        "Request a Quote",
        "Recorded Video",
        "Paid Search",
        "Display",
        "Paid Social",
    )
    live = ("Tradeshow", "Targeted Activity at Key Event", v.streaming_event, v.tour, "Roundtable", "Community")
    return [
        rule("Web", is_in("campaign_type", v.summit)),
        *[rule(kind, is_in("campaign_format", fmt)) for fmt, kind in FORMAT_WEB_TYPE.items()],
        rule("Web", is_in("campaign_type", *web)),
        rule("Non-Web", is_in("campaign_type", *live)),
    ]


def tactic_group_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Reads ``tactic`` and ``campaign_team``."""
    signup, webinar = is_in("tactic", v.cloud_signup), is_in("tactic", "Webinar")
    partner, field = is_in("campaign_team", "Partner"), is_in("campaign_team", "Field Marketing")
    return [
        rule("Partner Cloud Signup", signup, partner),
        rule("Growth Cloud Signup", signup),
        rule("Partner Webinar", webinar, partner),
        rule("FM Total", webinar, field),
        rule("Growth Webinar", webinar),
        rule(v.summit, is_in("tactic", v.summit)),
        rule("Online Collateral and Other Web", is_in("tactic", "Paid Media")),
        rule("Other Strategic Event", is_in("campaign_team", "Strategic Events")),
        rule("FM Total", is_in("tactic", "Forum", "Tech Talk")),
        rule("FM Total", field),
        rule("Global Campaigns", is_in("campaign_team", "Global Campaigns")),
        rule("Partner Online Collateral", partner, is_in("tactic", "Online Collateral")),
        rule("Other Partner Marketing", partner),
    ]


TACTIC_GROUP_DEFAULT = "Online Collateral and Other Web"


def tactic_team_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Reads ``tactic`` and ``campaign_team``."""
    signup, partner = is_in("tactic", v.cloud_signup), is_in("campaign_team", "Partner")
    regional = ("Field Marketing", "Global Campaigns", "Revenue Marketing Cloud Partner", "Strategic Events")
    return [
        rule("Partner Marketing", signup, partner),
        rule("Growth", signup),
        rule("GRM", is_in("campaign_team", *regional)),
        rule("Partner Marketing", is_in("tactic", "Webinar"), partner),
        rule("Growth", is_in("tactic", "Webinar")),
        rule("GRM", is_in("tactic", v.summit)),
        rule("Growth", is_in("tactic", "Paid Media")),
        rule("GRM", is_in("tactic", "Forum", "Tech Talk")),
        rule("Partner Marketing", partner),
    ]


TACTIC_TEAM_DEFAULT = "Growth"


def tactic_channel_rules(v: Vocabulary = DEFAULT) -> list[Rule]:
    """Channel detail of a campaign touch: tactic first, then its tags, then the matched web visit.

    Reads ``tactic``, ``campaign_name``, ``in_person_workshop`` (text ``yes``),
    ``utm_medium``, ``utm_source``, ``utm_campaign``, the lower-cased ``campaign`` and the
    ``web_channel`` fields.
    """
    kept = (*TACTICS_KEPT[:4], v.streaming_event, v.tour, "Other Event", *CHANNEL_TYPES)
    nurture = is_in("utm_medium", "nurtureemail")
    other = is_in("web_channel", "Other")
    return [
        *[rule(t, is_in("tactic", t)) for t in kept],
        rule(v.summit, is_in("tactic", v.summit), lacks("campaign_name", *v.summit_virtual_years, known=True)),
        rule("Workshop", is_in("tactic", "Workshop"), is_in("in_person_workshop", "yes")),
        rule("Paid Social", is_in("utm_medium", "paidsocial")),
        rule("Display", is_in("utm_medium", "display")),
        rule("Paid Search", is_in("utm_medium", "ppc", "sem")),
        rule("Paid Gmail", is_in("utm_medium", "gmail")),
        any_of(
            "Nurture - Lifecycle",
            (nurture, like("utm_campaign", LIFECYCLE_CAMPAIGN)),
            (nurture, like("web_channel_campaign", LIFECYCLE_CAMPAIGN)),
        ),
        any_of(
            "Nurture - Global Campaigns",
            (nurture, like("utm_campaign", *GLOBAL_CAMPAIGNS)),
            (nurture, like("web_channel_campaign", *GLOBAL_CAMPAIGNS)),
        ),
        rule("Nurture - Global Campaigns", has("campaign", *v.nurture_campaigns)),
        rule("Nurture - Global Campaigns", has("campaign", *v.vertical_campaigns)),
        rule("Email", has("utm_medium", "email")),
        rule("Partner Referral", is_in("utm_source", *CLOUD_PROVIDERS)),
        rule(v.own_site_label, is_in("utm_source", v.own_source, v.product_site)),
        *_devx(v, "utm_campaign"),
        *[rule(c, is_in("web_channel", c)) for c in (*WEB_CHANNELS_KEPT, v.own_site_label)],
        *_devx(v, "web_channel_campaign"),
        rule("Paid Gmail", is_in("web_channel", "Paid Email")),
        rule("Partner Referral", is_in("web_channel", "Partner referral")),
        rule("Email", other, is_in("web_channel_medium", "email")),
        rule("Other Referral", other, is_in("web_channel_medium", "referral")),
        rule(v.own_site_label, other, is_in("web_channel_source", v.own_source)),
        rule("No Referral", is_null("web_channel_source")),
    ]


TACTIC_CHANNEL_DEFAULT = "Organic Web"


def channel_of(detail: Column) -> Column:
    """Channel of a channel detail."""
    return (
        F.when(detail == "Paid Gmail", F.lit("Display"))
        .when(detail == "No Referral", F.lit("No Referral"))
        .when(detail.endswith("Referral"), F.lit("Referral"))
        .otherwise(detail)
    )


def aggregate_of(detail: Column, v: Vocabulary = DEFAULT) -> Column:
    """Channel aggregate of a channel detail."""
    unpaid = (
        "Organic Web",
        "Direct",
        "Email",
        "Other Referral",
        "Organic Social",
        v.own_site_label,
        "DevX Referral",
        "Partner Referral",
        "Organic Video",
    )
    return (
        F.when(detail.contains("Paid") | (detail == "Display"), F.lit("Paid Media"))
        .when(detail.startswith("Nurture"), F.lit("Nurture"))
        .when(detail.isin(*unpaid), F.lit("Non Paid Web"))
        .otherwise(detail)
    )
