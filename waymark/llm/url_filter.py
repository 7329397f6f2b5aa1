"""URL filters: host and path rules, and for other urls logistic regression on hashed n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.frames import map_batches, own_names

#: verdict and rule (host, then path prefix), fixed values of the query.
RULES: tuple[tuple[str, str], ...] = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Names the labelled urls are made of (1: block), as host and path; invented.
NAMES: tuple[tuple[str, int], ...] = (
    ("cheap-pills.example/buy/now", 1),
    ("cheap-meds.example/en/12?ref=x", 1),
    ("pills-online.example/offer", 1),
    ("spam-farm.example/en/3", 1),
    ("spam-links.example/links/99", 1),
    ("seo-spam.example/backlinks.html", 1),
    ("link-farm.example/page/4", 1),
    ("free-casino.example/win/jackpot", 1),
    ("casino-bonus.example/spin", 1),
    ("best-poker.example/bonus", 1),
    ("adult-cams.example/live", 1),
    ("hot-xxx.example/video/8", 1),
    ("cheap-replica.example/watches", 1),
    ("replica-bags.example/sale", 1),
    ("fast-loans.example/apply", 1),
    ("crypto-doubler.example/invest", 1),
    ("free-download-crack.example/keygen", 1),
    ("warez-torrent.example/crack.html", 1),
    ("click-bait.example/you-wont-believe", 1),
    ("track-clicks.example/ads/banner", 1),
    ("sports-bets.example/odds", 1),
    ("bets-today.example/en/4", 1),
    ("free-spins.example/win", 1),
    ("casino-slots.example/en/61", 1),
    ("win-prizes.example/en/22", 1),
    ("ads-server.example/track/7", 1),
    ("ads-clicks.example/en/15", 1),
    ("spam-mail.example/es/31", 1),
    ("library.example/books/12", 0),
    ("example.example/en/4", 0),
    ("new-books.example/en/41.html", 0),
    ("old-town.example/es/9?page=2", 0),
    ("green-tea.example/fr/128", 0),
    ("open-data.example/en/7#top", 0),
    ("lake-house.example/de/66", 0),
    ("two-rivers.example/en/3/", 0),
    ("photo-club.example/en/5000", 0),
    ("museum.example/en/collection", 0),
    ("garden.example/en/roses.html", 0),
    ("weather.example/fr/paris", 0),
    ("news.example/de/politik/77", 0),
    ("university.example/courses/physics", 0),
    ("docs.tools.example/guide/install", 0),
    ("recipes.example/es/sopa", 0),
    ("railway.example/timetable", 0),
    ("history.example/en/853/", 0),
    ("science.example/articles/1234", 0),
    ("sport.example/fr/football", 0),
    ("city.example/de/rathaus", 0),
    ("forum.cycling.example/thread/55", 0),
    ("archive.example/1998/index.html", 0),
    ("school.example/en/445", 0),
    ("health.example/es/consejos", 0),
    ("travel.example/en/971?page=2", 0),
    ("maps.example/en/471", 0),
    ("theatre.example/programme", 0),
)
ENDS, FRONTS = (".example.com", ".example.net", ".example.org"), ("", "www.", "m.", "blog.")
#: The small labelled table: every name under every ending and front, so that neither tells anything.
LABELLED = tuple(
    (front + name.replace(".example", end, 1), y) for name, y in NAMES for end in ENDS for front in FRONTS
)
GRAMS, DIMENSIONS = (3, 4), 1 << 14
EPOCHS, RATE, DECAY = 300, 4.0, 5e-4
#: Paths say less than hosts; a clean url blocked costs more than a bad one let through.
PATH_SHARE, ALLOW_COST = 0.25, 1.8
OWN = ["host", "path", "rule", "verdict", "block_score"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without ``://`` or for a null url."""
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    # All after the first "://"; the host ends at "/", "?" or "#", the path at "?" or "#".
    rest = F.expr("substr(__url, locate('://', __url) + 3)")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def features(part: str, text: str) -> list[int]:
    """Places of the hashed character n-grams of one part of a url, each counted once."""
    text = f"^{text}$"
    grams = {part + text[i : i + n] for n in GRAMS for i in range(len(text) - n + 1)}
    return sorted({zlib.crc32(g.encode()) % DIMENSIONS for g in grams})


def vector(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values; host and path are scaled each, so a long path does not hide the host."""
    found = [features("h", host), features("p", path)]
    values = [np.full(len(f), s / max(1, len(f)) ** 0.5) for f, s in zip(found, (1.0, PATH_SHARE), strict=True)]
    return np.array(found[0] + found[1], dtype=np.int64), np.concatenate(values)


def fit(labelled: Sequence[tuple[str, int]] = LABELLED) -> np.ndarray:
    """Weights and, last, the bias, by gradient descent on the small labelled table."""
    vectors = [vector(*_split(url)) for url, _ in labelled]
    used = np.unique(np.concatenate([places for places, _ in vectors] + [np.array([DIMENSIONS])]))
    x = np.zeros((len(labelled), len(used)))
    for row, (places, values) in zip(x, vectors, strict=True):
        np.add.at(row, np.searchsorted(used, places), values)
    x[:, -1] = 1.0  # the bias, last of all
    y = np.array([y for _, y in labelled], dtype=float)
    cost = np.where(y == 0, ALLOW_COST, 1.0)
    w = np.zeros(len(used))
    for _ in range(EPOCHS):
        p = 1 / (1 + np.exp(-x @ w))
        w -= RATE * (x.T @ (cost * (p - y)) / len(y) + DECAY * w)
    weights = np.zeros(DIMENSIONS + 1)
    weights[used] = w
    return weights


def _split(url: str) -> tuple[str, str]:
    host, slash, path = url.partition("/")
    return host, (slash + path).split("?")[0].split("#")[0]


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and its verdict of the longest rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, name in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, slash, rest = name.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    labelled: Sequence[tuple[str, int]] = LABELLED,
    threshold: float = 0.5,
) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and block_score of every url.

    The longest rule that fits decides; other urls are blocked when the model's score
    passes ``threshold``. ``block_score`` is the model's also where a rule decides. A null
    url, or one without ``://``, has an empty host and path and is judged by the model on
    those. Rows that repeat are judged each; own columns with the added names are replaced.
    """
    pages = own_names(pages, OWN)
    weights = fit(labelled)
    split = pages.withColumn("__url", F.col("url"))
    host, path = parts(F.col("__url"))
    split = split.withColumns({"host": host, "path": path}).drop("__url")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = []
        for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
            places, values = vector(h, p)
            scores.append(1 / (1 + np.exp(-(weights[places] @ values + weights[-1]))))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "block_score"]
        )

    schema = split.limit(0).withColumn("block_score", F.lit(0.0)).schema
    scored = map_batches(split, run, schema)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    model = F.when(F.col("block_score") > threshold, "block").otherwise("allow")
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, model)})
