"""Language ID: the forward pass against enumeration, and held-out accuracy."""

import functools

import numpy as np
import pytest

from waymark.llm import language


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def enumerated(word, vocab, probabilities):
    number = {p: i for i, p in enumerate(vocab.pieces)}

    @functools.cache
    def rest(at):
        if at == len(word):
            return np.ones(probabilities.shape[1])
        ends = range(at + 1, min(len(word), at + language.LONGEST_PIECE) + 1)
        return sum(probabilities[number[word[at:e]]] * rest(e) for e in ends if word[at:e] in number)

    return np.log(rest(0))


def test_forward_sums_all_segmentations(model):
    vocab = language.vocabulary(model.path)
    words = [b" the", b" ungeheit", " étreau".encode(), b" x", b" " + b"ab" * 15]
    scores = language.word_scores(words, vocab, model.probabilities)
    for word, score in zip(words, scores, strict=True):
        assert np.allclose(score, enumerated(word, vocab, model.probabilities))


def test_expected_uses_spell_the_words(model):
    vocab = language.vocabulary(model.path)
    words = [b" there", b" again"]
    counts = np.full((2, len(model.languages)), 3.0)
    uses = language.expected(words, counts, vocab, model.probabilities)
    lengths = np.array([len(p) for p in vocab.pieces])
    assert np.allclose(lengths @ uses, 3 * sum(map(len, words)))


def test_held_out_accuracy(docs, model):
    rows = language.predict(docs.withColumn("out", language.held_out()), model).filter("out AND lang IS NOT NULL").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_learned(spark, docs, model):
    from pyspark.sql import functions as F

    lied = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    again = language.fit(lied)
    assert again.languages == model.languages
    assert np.array_equal(again.probabilities, model.probabilities)


def test_full_memory_keeps_words_in_use(model, monkeypatch):
    """Common words are scored once however many others pass through, and values never depend on what is kept."""
    learned = []
    score = language.word_scores
    monkeypatch.setattr(language, "word_scores", lambda words, *rest: learned.extend(words) or score(words, *rest))
    texts = [["the", "and", "Of"] + [f"{a}{b}{c}" for c in "abcdefghij"] for a in "klmnopqrst" for b in "uvwxyz"]
    plenty = language.Scorer(model)
    want = [plenty.predict(t) for t in texts]
    monkeypatch.setattr(language, "MEMORY", 40)
    learned.clear()
    tight = language.Scorer(model)
    for at in range(0, len(texts), 2):
        tight.learn(texts[at : at + 2])
        got = [tight.predict(t) for t in texts[at : at + 2]]
        assert [x for x, _ in got] == [x for x, _ in want[at : at + 2]]
        assert np.allclose([x for _, x in got], [x for _, x in want[at : at + 2]])
        assert len(tight.known) == len(tight.rows) == len(tight.used) <= 40 + 26
    assert learned.count(b" the") == 1 and len(learned) == 600 + 3


def test_nulls_repeats_clashes_and_no_rows(spark, model):
    rows = [(1, None, "en", 0), (2, "12 !!", "en", 0), (3, "the and of", "de", 1), (3, "the and of", "de", 1)]
    rows += [(None, "Straße und der", None, 2), (5, "é" * 3000, None, 2), (6, "", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    out = language.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert got[1] == got[2] == got[6] == "und" and got[3] == "en" and got[None] == "de" and got[5] != "und"
    assert out.count() == len(rows)
    assert language.digest_rows(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in language.digest_rows(docs.select("doc_id", "text", docs.lang.substr(9, 1).alias("lang")).filter("doc_id = 1")).collect()} == {"und"}
