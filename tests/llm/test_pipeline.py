"""The pipeline stage by stage against plain versions, each on the stage's own input."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm import bpe, language
from waymark.llm.frames import documents, stage

from test_mixing import plain_targets
from test_near_dedup import plain as plain_near


@pytest.fixture(scope="module")
def tables(spark, sf):
    """Input of each stage, and the result."""
    found = [documents(spark, sf)]
    for name, step in corpus_pipeline.STAGES:
        found.append(stage(step(spark, found[-1], sf), name))
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(tables):
    for df in tables[:-1]:
        assert df.columns == tables[0].columns


def test_language(tables):
    scorer = language.Scorer(language.fit(tables[0]))
    want = set()
    for key, r in by_id(tables[0]).items():
        if scorer.predict(r.text or "")[0] != language.UNKNOWN:
            want.add(key)
    assert set(by_id(tables[1])) == want


def test_exact_copies(tables):
    largest = {}
    for key, r in sorted(by_id(tables[1]).items()):
        largest[r.text] = key
    assert set(by_id(tables[2])) == set(largest.values())


def test_near_copies(tables):
    judged = plain_near([(k, r.text) for k, r in by_id(tables[2]).items()], 5)
    assert set(by_id(tables[3])) == {k for k, (_, _, kept) in judged.items() if kept}


def test_mix(tables):
    given = by_id(tables[3])
    size = {k: len((r.text or "").encode().split()) for k, r in given.items()}
    totals = defaultdict(int)
    for k, r in given.items():
        totals[r.source] += size[k]
    copies = Counter(r.doc_id for r in tables[4].collect())
    assert max(copies.values()) <= 3
    taken = defaultdict(int)
    for k, n in copies.items():
        taken[given[k].source] += n * size[k]
    for source, target in plain_targets(totals).items():
        largest = max(size[k] for k, r in given.items() if r.source == source)
        assert abs(taken[source] - target) <= largest


def test_tokens(tables):
    coder = bpe.codec(public_tokenizers.path(bpe.MULTI_50K))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text))) for r in tables[4].collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in tables[5].collect()) == want
    assert tables[5].filter("NOT exact").count() == 0


def test_run_is_its_stages(spark, sf, tables):
    rows = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf).collect())
    assert rows == Counter((r.doc_id, r.n_tokens) for r in tables[5].collect())


def test_odd_rows_and_columns(spark, sf):
    rows = [(1, "The and attion of the words here.", None, "s", 9), (2, None, "en", None, 1), (2, None, "en", None, 1)]
    rows += [(None, "and the of attion thing was on", "en", "s", 2), (5, "123 456", "en", "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long")
    for df in (docs, docs.limit(0)):
        for _, step in corpus_pipeline.STAGES[:-1]:
            df = stage(step(spark, df, sf), "odd")
            assert df.columns == docs.columns
        assert all(r.size in (9, 2) for r in df.collect())
        coded = corpus_pipeline.tokenized(spark, docs if df.isEmpty() else df, sf)
        assert coded.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "exact"]
        assert all(r.exact for r in coded.collect())


def test_tokens_of_odd_rows(spark, sf):
    rows = [(1, None, None, None, 5), (None, "", "en", "s", 6), (3, "é 😀\x00 </s>", "en", "s", 7), (3, "é 😀\x00 </s>", "en", "s", 7)]
    rows.append((4, "word " * 400_000 + "é" * 100_000, "en", "t", 8))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, ids long").withColumn("exact", F.lit("own"))
    found = corpus_pipeline.tokenized(spark, docs, sf).collect()
    assert sorted((r.doc_id or 0, r.lang, r.exact) for r in found if r.doc_id != 1) == [
        (0, "en", True), (3, "en", True), (3, "en", True), (4, "en", True)
    ]
    assert [r.ids for r in found if r.doc_id in (1, None)] == [[], []]
    assert corpus_pipeline.tokenized(spark, docs.limit(0), sf).collect() == []


def test_short_clean_texts_stay(spark, sf):
    docs = documents(spark, sf)
    short = docs.limit(50).withColumn("text", F.regexp_extract("text", r"(\p{L}+)", 1)).withColumn("doc_id", F.col("doc_id") + 10**6)
    short = short.filter("text <> ''")
    kept = corpus_pipeline.known_language(spark, docs.unionByName(short), sf).filter("doc_id >= 1000000")
    assert kept.count() == short.count()
