"""Mixing: targets by the plain rule, words near them, copies within bounds."""

from collections import defaultdict

import pytest

from waymark.llm import mixing


def plain_targets(totals, weights=(1, 2, 3), cap=3):
    """Share by weight; who is above the cap stops there and the rest shares what is left."""
    names = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    stopped: dict = {}
    while True:
        left = sum(totals.values()) - sum(stopped.values())
        open_ = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        above = [s for s in open_ if share[s] >= cap * totals[s]]
        if not above:
            return stopped | share
        stopped |= {s: float(cap * totals[s]) for s in above}


def judged(rows):
    totals, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        totals[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.size == len((r.text or "").encode().split())
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
    return totals, taken, largest


def test_words_come_near_the_targets(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    totals, taken, largest = judged(rows)
    targets = plain_targets(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(targets[r.source])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.05 * target, 1)


def test_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    two = {r.doc_id: r.copies for r in mixing.mix(docs.repartition(7, "text")).collect()}
    assert one == two


def test_capped_sources_null_last_and_clashing_columns(spark):
    rows = [(k, "w " * (1 + k % 9), s, "x") for s, n in (("a", 300), ("é", 4), (None, 40), ("z", 2)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    got = out.collect()
    totals, taken, _ = judged(got)
    targets = plain_targets(totals)
    assert {r.source: round(r.target, 6) for r in got} == {s: round(t, 6) for s, t in targets.items()}
    assert targets["é"] == 3 * totals["é"] == taken["é"]


def test_one_large_cell_is_cut_into_slots(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_ROWS", 50)
    rows = [(k, "same words here", "hot") for k in range(2000)] + [(k, "w " * (k % 30 + 1), "b") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    totals, taken, _ = judged(mixing.mix(docs).collect())
    for source, target in plain_targets(totals).items():
        assert abs(taken[source] - target) <= 0.05 * target


def test_no_words_repeats_and_no_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "", "a"), (None, "one two", "a"), (3, " \t", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 5 and {r.taken for r in got if not r.size} == {0}
    assert mixing.mix(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
