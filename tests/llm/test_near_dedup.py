"""MinHash near-dedup against all pairs of full sets."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from waymark.llm import near_dedup
from waymark.llm.components import components


def sets_of(rows, words):
    out = {}
    for key, text in rows:
        w = (text or "").encode().lower().split()
        grams = [tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        out[key] = frozenset(grams)
    return out


def plain(rows, words, percent=80):
    sets = sets_of(rows, words)
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


def judged(spark, rows, words):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, words).collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_given_documents(spark, sf, words):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert judged(spark, rows, words) == plain(rows, words)


def test_families_of_borderline_copies(spark):
    """Copies of copies, where the smallest id is often not similar to the rest of its bucket."""
    r = random.Random(4)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for _ in range(12):
        text = r.choices(words, k=60)
        for _ in range(14):
            text = list(text)
            for _ in range(r.randint(1, 3)):
                text[r.randrange(60)] = r.choice(words)
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    assert judged(spark, rows, 2) == plain(rows, 2)


def test_pairs_within_a_template_family(spark):
    """Thousands of texts of one template, none similar enough to another but for some pairs."""
    r = random.Random(11)
    template = [f"t{k}" for k in range(160)]

    def changed(text, n, name):
        text = list(text)
        for k, place in enumerate(r.sample(range(160), n)):
            text[place] = f"{name}x{k}"
        return text

    texts = [changed(template, 7, f"a{k}") for k in range(2000)]
    pairs = [changed(texts[37 * k], 8, f"b{k}") for k in range(40)]
    rows = list(enumerate([" ".join(t) for t in texts + pairs]))
    r.shuffle(rows)
    sets = sets_of(rows, 2)
    # All pairs at once: one column for each shingle that several texts hold.
    several = [g for g, n in Counter(itertools.chain(*sets.values())).items() if n > 1]
    column = {g: k for k, g in enumerate(several)}
    held = np.zeros((len(rows), len(several)), np.float32)
    for k, grams in sets.items():
        held[k, [column[g] for g in grams if g in column]] = 1
    sizes, shared = np.array([len(sets[k]) for k in range(len(rows))]), held @ held.T
    alike = np.triu(shared / (sizes[:, None] + sizes - shared), 1)
    similar = np.argwhere(alike >= 0.8)
    assert len(similar) >= 30 and np.median(alike[:2000, :2000][np.triu_indices(2000, 1)]) > 0.67
    component = list(range(len(rows)))
    for _ in similar:
        for a, b in similar:
            component[a] = component[b] = min(component[a], component[b])
    got = judged(spark, rows, 2)
    assert [got[k][1] for k in range(len(rows))] == component


def test_no_similar_pair_is_missed_by_rare_shingles(spark, monkeypatch):
    """The exact step alone gives every similar pair, with counters that tell little as well."""
    monkeypatch.setattr(near_dedup, "COUNTER_BITS", 3)
    r = np.random.default_rng(5)
    base = r.integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2)
    sets = []
    for _ in range(300):
        own = r.integers(0, 2**63, r.integers(0, 12), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sets.append(np.unique(np.concatenate([r.choice(base, r.integers(1, 60), replace=False), own])))
    table = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "id long, members binary")
    placed = spark.createDataFrame([(1, k, len(s), k) for k, s in enumerate(sets)], "key long, rep long, n long, comp long")
    given = near_dedup._rest(placed, table, 80, 2)
    got = {(x.a, x.b) for x in near_dedup._confirmed(given, table, 80).collect()}
    whole = [frozenset(s.tolist()) for s in sets]
    similar = {(i, j) for i, j in itertools.combinations(range(300), 2) if 100 * len(whole[i] & whole[j]) >= 80 * len(whole[i] | whole[j])}
    assert len(similar) > 20 and got == similar


def test_a_later_round_repeats_no_pair_of_the_first_centre(spark):
    """A bucket of two gives none, and any other fewer rows than centres times members."""
    sizes = [2] * 5 + [3] * 4 + [40, 80]
    rows = [(key, 100 * key + k, 10, 100 * key, 100 * key + k) for key, m in enumerate(sizes) for k in range(m)]
    placed = spark.createDataFrame(rows, "key long, rep long, n long, star long, comp long")
    made = Counter(r.rep // 100 for r in near_dedup._again(placed, 1, 80, 2).collect())
    pairs = near_dedup._again(placed, 1, 80, 2).distinct().collect()
    assert all(r.centre % 100 and r.rep % 100 for r in pairs)
    for key, m in enumerate(sizes):
        assert (made[key] > 0) == (m > 2) and made[key] <= near_dedup.CENTRES * (m - 2)


def test_small_sets_and_one_large_group(spark):
    rows = [(k, "alpha beta gamma delta epsilon" + (" zeta" if k % 2 else "")) for k in range(400)]
    rows += [(1000 + k, "Alpha  BETA") for k in range(30)] + [(2000, "x"), (2001, "X"), (2002, None), (2003, " \n"), (2004, "")]
    assert judged(spark, rows, 2) == plain(rows, 2)


def test_nulls_repeats_extra_columns_and_no_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", 1), (None, "a b c", 2), (3, "a b c", 3), (3, "q r", 4), (5, None, 5)],
        "doc_id long, text string, bands int",
    )
    rows = sorted((tuple(r) for r in near_dedup.near_duplicates(docs, 2).collect()), key=str)
    assert rows == sorted(
        [(1, 2, 1, True), (None, 2, None, True), (3, 2, 1, False), (3, 1, 3, True), (5, 0, 5, True)], key=str
    )
    left = near_dedup.drop_near_duplicates(docs, 2)
    assert left.columns == docs.columns and sorted(r.bands for r in left.collect()) == [1, 2, 3, 4, 5]
    assert near_dedup.near_duplicates(docs.limit(0)).collect() == []


def test_a_text_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP", 64)
    text = " ".join(f"word{k % 50}" for k in range(300))
    (got,) = near_dedup.shingle_sets([text], 2)
    monkeypatch.setattr(near_dedup, "GROUP", 1 << 20)
    (want,) = near_dedup.shingle_sets([text], 2)
    assert np.array_equal(got, want) and len(got) == 50


def test_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    base = np.sort(r.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2))
    other = np.sort(np.concatenate([base[:800], r.integers(0, 2**63, 200, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
    with np.errstate(over="ignore"):
        a, b = near_dedup.sketches([base, other], bins=4000)
    assert abs((a == b).mean() - 800 / 1200) < 0.05


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(300)] + [(7, 7), (100, 200)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100} | {200 + k: 100 for k in range(300)}
    assert components(df.limit(0)).collect() == []
