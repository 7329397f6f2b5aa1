"""Encoding, decoding and counting against the public libraries."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from waymark.llm import bpe, counts
from waymark.llm.pretokens import MATCHES, Parts

BITS = ["a", "b", " ", "  ", "\n", "\r\n", "\t", "é", "日本", "'s", "'ll", "1", "²", "!", "<|endoftext|>", "\x85", "\xa0"]
BITS += ["\x1c", "　", "🙂", "the", " the", "_", "٣", "ing"]


@pytest.fixture(scope="module")
def coder():
    return bpe.codec(public_tokenizers.path(bpe.MULTI_50K))


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(counts.JSON_50K))


def texts(n=4000):
    r = random.Random(5)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_ids_are_the_librarys_and_decode(coder, library):
    for text in texts():
        ids = coder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_counts_are_the_librarys(tokenizer):
    count = counts.counter(public_tokenizers.path(counts.JSON_50K)).count
    for text in texts():
        assert count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, "é" * 5000, "thing" * 4000, "!" * 3000, " " * 3000])
def test_very_long_pretokens(coder, library, tokenizer, text):
    assert coder.encode(text).tolist() == library.encode_ordinary(text)
    count = counts.counter(public_tokenizers.path(counts.JSON_50K)).count
    assert count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_a_full_memory_starts_afresh():
    parts = Parts(lambda m: [m], lambda found: sum(found, []), words=3, runs=2)
    text = "one two, three four five. six\n\n seven  one two"
    for _ in range(3):
        assert "".join(sum(parts.values(text), [])) == text
    assert len(parts.words) <= 3 and len(parts.runs) <= 2


def test_round_trip_of_rows(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    texts_ = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts_.keys()
    for key, text in texts_.items():
        ids = library.encode_ordinary(text)
        assert rows[key].n_tokens == len(ids)
        assert rows[key].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_repeats_clashes_and_no_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 7), (None, None, 8), (1, "a b", 7), (2, "", None)], "doc_id long, text string, ids int"
    )
    coded = bpe.decode(bpe.encode(docs))
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    rows = [(r.doc_id, r.ids, bytes(r.decoded)) for r in coded.collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, [64, 272], b"a b"), (1, [64, 272], b"a b"), (None, [], b""), (2, [], b"")], key=str
    )
    counted = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in counts.token_counts(docs, limit=1).collect()]
    assert sorted(counted, key=str) == sorted([(1, 3, 2, True)] * 2 + [(None, 0, 0, False), (2, 0, 0, False)], key=str)
    none = docs.limit(0)
    assert bpe.round_trip(none).collect() == bpe.encode(none).collect() == counts.token_counts(none).collect() == []


def test_marks_behind_letters_are_read_as_the_pattern_reads_them():
    rng = random.Random(5)
    signs = ["ab", "É", "7", "'s", "'", " ", "\n", "  ", *'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~', "—", "́"]
    parts = Parts(lambda match: [match], lambda found: [m for f in found for m in f])
    for _ in range(4000):
        text = "".join(rng.choices(signs, k=rng.randint(1, 12)))
        assert [m for found in parts.values(text) for m in found] == MATCHES(text), text


def test_first_pairs_come_from_a_table_of_bytes(coder, library):
    """A merge looks up two pairs; the pairs of a pre-token's bytes take no look-up of their own."""
    asked = []

    class Counted(dict):
        def get(self, *key):
            asked.append(key)
            return super().get(*key)

    merges = bpe.Merges(coder.ranks)
    merges.joined = [Counted(x) for x in merges.joined]
    r = random.Random(8)
    for n in (1, 2, 9, 60, 600):
        piece = "".join(r.choices("ab", k=n)) + "q" * n
        asked.clear()
        ids = merges.merge(piece.encode())
        assert ids == library.encode_ordinary(piece)
        assert len(asked) <= 2 * (len(piece) - len(ids))
    assert not any(merges.words) and not any(b is not None for b in merges.buckets)
