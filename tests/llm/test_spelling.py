"""Spelling variants against a version that compares all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from waymark.llm import spelling
from waymark.llm.frames import documents
from waymark.llm.queries import QUERIES

ALPHABET = "abcdeéßÿ"


def plain_counts(rows, planted=True):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if planted and doc_id is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_near(words):
    """Words one edit apart share the word, or what is left without one letter."""
    meet = defaultdict(set)
    for w in words:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            meet[k].add(w)
    return {(a, b) for group in meet.values() for a in group for b in group if a != b and one_edit(a, b)}


def plain(counts):
    near = defaultdict(list)
    for a, b in plain_near(counts):
        near[a].append(b)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o))
        if counts[best] >= 5 * counts[w]:
            forms[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.add((w, form, root, n, len(near[w]), counts[form] if form else None))
    return out


def invented(seed, n, letters=(4, 12)):
    r = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(r.choice(ALPHABET) for _ in range(r.randrange(*letters)))
        words.add(w)
        for _ in range(r.randrange(3)):
            i, c = r.randrange(len(w) + 1), r.choice(ALPHABET)
            words.add(r.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], c * len(w)]))
    return sorted(w for w in words if len(w) >= letters[0])


@pytest.mark.parametrize("frequent", [0, 3, 20, 10**6])
def test_lists_of_near_words_meet(frequent):
    words = invented(frequent, 1500)
    places = Counter(w[p : p + q] for w in words for q in range(2, 8) for p in range(len(w) - q + 1))
    grams = spelling.Dictionary({g: n for g, n in places.items() if n > frequent})
    keys = {w: tuple(map(set, spelling._keys(w, grams, 4))) for w in words}
    near = plain_near(words)
    assert len(near) > 1000
    for a, b in near:
        if len(a) == len(b):
            assert keys[a][0] & keys[b][0]
        elif len(a) < len(b):
            assert keys[a][0] & keys[b][1]


def test_grams_grow_while_they_are_frequent():
    grams = spelling.Dictionary({"st": 90, "str": 60, "ra": 80, "ng": 70})
    assert grams.decompose("strange", 3) == [("str", False), ("tr", False), ("ran", False), ("an", False), ("nge", False), ("ge", False)]
    assert grams.decompose("string", 4)[-1] == ("ng", True)
    # Three grams hold the third letter.
    assert spelling.affected(grams.decompose("strange", 3), 7) == 3


def test_dictionary_has_a_bound(spark):
    words = spark.createDataFrame([(w, 5) for w in invented(1, 3000)], "word string, n long")
    for most in (60, 400):
        held = spelling.dictionary(words, frequent=1, most=most).places
        assert 0 < max(Counter(map(len, held)).values()) <= most
    free = spelling.dictionary(words, frequent=1).places
    assert all(g[:-1] in free for g in free if len(g) > 2)


@pytest.mark.parametrize("seed", range(2))
def test_variants_of_invented_words(spark, seed):
    r = random.Random(seed)
    counts = {w: 5 * 6 ** r.randrange(5) + r.randrange(2) for w in invented(seed, 2500, (6, 11))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {tuple(row) for row in spelling.variants(words).collect()}
    assert found == plain(counts)
    assert any(f and root != f for _, f, root, *_ in found)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "Strange Straße strasse " * 30), (3, "x" * 2_000 + " STRANGE-strangé_stränge "), (3, "x" * 2_000)]
    rows += [(i, "strang strange9strange ÀÉÎÕÜ÷àéîõü× " + "x" * 2_000) for i in range(4, 10)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("own"), "n": F.lit(1)})
    for planted in (False, True):
        found = spelling.word_counts(docs, planted=planted)
        want = plain_counts(rows, planted)
        assert {r.word: r.n for r in found.collect()} == want
        assert {tuple(r) for r in spelling.variants(found).collect()} == plain(want)
    assert spelling.variants(spelling.word_counts(docs.limit(0))).collect() == []


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    counts = plain_counts([(r.doc_id, r.text) for r in documents(spark, folder).collect()])
    found = {tuple(r) for r in QUERIES["op12_spelling"](spark, folder).collect()}
    assert found == plain(counts)
    assert any(form for _, form, *_ in found)
