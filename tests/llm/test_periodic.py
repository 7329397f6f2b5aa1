"""Periodic runs against a version that tries every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.llm import periodic
from waymark.llm.frames import documents
from waymark.llm.queries import QUERIES


def plain_runs(words, least, times):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(least, times * q):
                found.setdefault((start, i - start), q)  # periods rise, so the smallest is first
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best and 1000 * best[1] // best[2]
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), milli, *digest)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(2, 2), (4, 2), (6, 3), (9, 3)]))
def test_every_run_of_random_words(words, limits):
    assert periodic.runs(words, *limits) == plain_runs(words, *limits)
    assert periodic.text_runs(words, *limits) == plain_runs(words, *limits)


@pytest.mark.parametrize("seed", range(30))
def test_planted_runs(seed):
    r = random.Random(seed)
    words = []
    for _ in range(r.randrange(1, 6)):
        words += [r.randrange(50) for _ in range(r.randrange(40))]
        words += [r.randrange(1 + r.randrange(6)) for _ in range(r.randrange(1, 20))] * r.randrange(1, 9)
        if r.random() < 0.5:
            words += words[-r.randrange(1, 30) :] * r.randrange(1, 4)
    assert periodic.text_runs(words) == plain_runs(words, 24, 3)


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for least, times in ((2, 2), (9, 3)):
        assert periodic.runs(b, least, times) == plain_runs(b, least, times)


def test_long_text_of_one_word():
    assert periodic.text_runs([b"a"] * 50_000) == [(0, 50_000, 1)]


def test_stretches_are_where_runs_can_be():
    words = list(range(500)) + list(range(600, 610)) * 4 + list(range(700, 900)) + list(range(100, 130)) * 2
    assert periodic.gram_size() == 8
    assert list(periodic.stretches(np.array(words))) == [(100, 130), (500, 540), (740, 770), (770, 800)]


def test_odd_documents(spark):
    text = " ".join(["a b c"] * 20)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, text), (4, text), (4, text), (5, "x " * 23), (6, "x " * 24)]
    rows += [(i, f"one two three {i} x\x1cy " * 9) for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_runs": F.lit("own"), "start": F.lit(1)})
    found = sorted(map(tuple, periodic.digest_rows(docs, planted=True).collect()), key=str)
    want = [plain(k, t) for k, t in rows if k is not None]
    want.append((None, *plain("no number", text)[1:]))
    assert zlib.crc32(b"no number") % 10
    assert found == sorted(want, key=str)
    assert periodic.digest_rows(docs.limit(0)).collect() == []


def test_text_without_repeats(spark):
    docs = spark.createDataFrame([(1, None, "u"), (2, "q " * 30 + "end", "v"), (3, "a  b", "w")], "doc_id long, text string, n_runs string")
    found = periodic.without_repeats(docs)
    assert found.columns == docs.columns
    assert [r.text for r in found.orderBy("doc_id").collect()] == [None, "q end", "a  b"]


def test_given_documents(spark, sf):
    want = [plain(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    found = QUERIES["op13_runs"](spark, sf).collect()
    assert sorted(map(tuple, found)) == sorted(want)
    assert any(r.n_runs > 1 for r in found)
