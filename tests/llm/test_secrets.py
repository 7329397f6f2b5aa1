"""Secret scans: base spans by plain patterns, decoding by enumeration, held-out lines."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from waymark.llm import secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PLAIN = {
    "assign": (re.compile(ASSIGN, re.IGNORECASE | re.ASCII), lambda m: len(m[2]) >= 12),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def plain(text):
    found = [(m.start(), m.end(), k) for k, (p, ok) in PLAIN.items() for m in p.finditer(text) if ok(m)]
    return sorted(found, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


@pytest.fixture(scope="module")
def field():
    return secrets.trained()


def test_base_spans():
    r = random.Random(3)
    bits = ["secret", "TOKEN", "api_key", "=", ": ", '"', "abcdef0123456789", "AKIA", "ABCDEFGHIJKLMN", " ", "é", "🙂", "x", "/", "ſecret=", "K"]
    for _ in range(3000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
        assert secrets.base_spans(text) == plain(text)


def test_viterbi_is_the_best_path(field):
    r = np.random.default_rng(2)
    for _ in range(200):
        codes = np.concatenate([[0], r.integers(1, secrets.CODES, 5), [0]])
        files = np.zeros(5, dtype=int)
        scores = field.scores(codes, files)
        m = field.moves

        def value(path):
            whole = [0, *path, 0]
            return sum(scores[t, y] for t, y in enumerate(path)) + sum(m[a, b] for a, b in itertools.pairwise(whole))

        best = max(itertools.product(range(3), repeat=5), key=value)
        tagged = {t for first, last in field.tags(codes, files) for t in range(first, last + 1)}
        assert tagged == {t for t, y in enumerate(best) if y}


def test_held_out_lines(field):
    hit = extra = missed = 0
    for codes, file, tags in secrets.training_lines(seed=99, lines=400):
        got = set(field.tags(np.array([0, *codes, 0]), np.full(len(codes), file)))
        starts = [k for k, y in enumerate(tags) if y == secrets.BEGIN]
        want = set()
        for start in starts:
            end = start
            while end + 1 < len(tags) and tags[end + 1] == secrets.INSIDE:
                end += 1
            want.add((start, end))
        hit, extra, missed = hit + len(got & want), extra + len(got - want), missed + len(want - got)
    assert hit / (hit + missed) > 0.9 and hit / (hit + extra) > 0.9


def test_spans_are_added_beside_base_ones(spark):
    key = "ghp_" + "a8Bq9Zx2Lm4Kp7Rt1Yv3" + "Nc6Wd5"
    rows = [(1, f"the words {key}, and on"), (2, "password=abcdef0123456789 the"), (3, "plain words, 12.5.2020 www.example.com/x")]
    out = {r.doc_id: r for r in secrets.digest_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].spans == f"crf:10:{10 + len(key)}" and out[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert out[2].spans == "assign:0:25,hex:9:25" and (out[2].n_assign, out[2].n_hex) == (1, 1)
    assert out[3].spans == ""


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.scan(docs).collect():
        spans = [(s.start, s.end, s.kind) for s in r.spans]
        assert [s for s in spans if s[2] != "crf"] == plain(texts[r.doc_id])
        assert spans == sorted(spans, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def test_nulls_repeats_long_texts_and_no_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (4, "word " * 50_000 + "token=abcdefghijklmnop", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(((r.doc_id, r.spans) for r in secrets.digest_rows(docs).collect()), key=str)
    assert got == sorted([(1, ""), (1, ""), (None, ""), (4, "assign:250000:250022")], key=str)
    assert secrets.digest_rows(docs.limit(0)).collect() == []
