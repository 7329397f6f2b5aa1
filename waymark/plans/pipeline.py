"""Table order of the daily web build: visitors, page fact, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from waymark.plans import dashboard, web
from waymark.plans.identity import lead_to_visitor
from waymark.plans.rulesets import DEFAULT, Vocabulary
from waymark.sources.sinks import Stage, unstaged


def build_web(
    logs: Sequence[web.PageLog],
    leads: DataFrame,
    identifies: DataFrame,
    funnel: DataFrame,
    inquiries: DataFrame,
    run_date: dt.date,
    *,
    domains: Sequence[str],
    lead_source: str,
    vocabulary: Vocabulary = DEFAULT,
    stage: Stage = unstaged,
) -> dict[str, DataFrame]:
    """The tables of the build in their order, keyed by name.

    With :func:`waymark.sources.sinks.stage` each table is written before the next reads
    it, as a daily run does; without, all are one lazy plan.
    """
    visitors = stage(web.visitor_dimension(web.harmonise(logs)), "dim_visitor")
    fact = stage(web.page_visit_fact(logs, visitors, run_date, vocabulary=vocabulary, stage=stage), "fct_page_visit")
    lead_map = stage(lead_to_visitor(leads, identifies, run_date, lead_source), "lookup_lead_visitor")
    report = dashboard.web_dashboard(
        fact.drop("extract_date"),
        lead_map,
        funnel,
        inquiries,
        run_date,
        domains=domains,
        vocabulary=vocabulary,
        stage=stage,
    )
    return {"dim_visitor": visitors, "fct_page_visit": fact, "lookup_lead_visitor": lead_map, "rpt_web_dashboard": report}
