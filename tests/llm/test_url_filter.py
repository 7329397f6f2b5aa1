"""URL filters: parts, rules and the model."""

import re

from waymark.llm import url_filter


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in url_filter.RULES:
        rule_host, slash, tail = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def test_parts_and_rules(spark, sf):
    urls = [r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    urls += ["http://A.Example.ORG", "x://EXAMPLE.org/es/x?q#f", "http://x.com#/fr/", "a://b://c/d", "http://org/", "://", None]
    urls += ["http://É.com/fr/é", "no scheme", "http://badcom/fr/", "http://q.com/fr/\n/x", "", "s://h?a/b", "http://example.org/en/12"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge(df).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, best = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == (best[0] if best else "block" if r.block_score > 0.5 else "allow")


def test_the_model_tells_unseen_hosts_apart(spark):
    bad = [f"http://{h}.example.net/en/{k}" for k, h in enumerate(["cheap-pills", "spam-farm", "free-bets", "www.casino-win", "ads-track"])]
    good = [f"http://{h}.example.net/en/{k}" for k, h in enumerate(["therha", "blog.ththon", "m.thering", "www.kitchen", "parliament"])]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(bad + good)], "page_id long, url string")
    got = {r.url: r.verdict for r in url_filter.judge(df).collect()}
    assert [got[u] for u in bad] == ["block"] * 5 and [got[u] for u in good] == ["allow"] * 5


def test_own_rules_repeats_clashes_and_no_rows(spark):
    df = spark.createDataFrame([(1, "http://a.net/x/y", "h"), (1, "http://a.net/x/y", "h"), (None, None, None)], "page_id long, url string, host string")
    out = url_filter.judge(df, rules=(("block", "net/"), ("allow", "a.net/x/")))
    assert out.columns == ["page_id", "url", "block_score", "host", "path", "rule", "verdict"] or set(out.columns) == {
        "page_id", "url", "host", "path", "rule", "verdict", "block_score"
    }
    rows = out.collect()
    assert [(r.rule, r.verdict) for r in rows if r.page_id] == [("a.net/x/", "allow")] * 2
    assert [(r.host, r.path, r.rule) for r in rows if not r.page_id] == [("", "", None)]
    assert url_filter.judge(df.limit(0)).collect() == []
