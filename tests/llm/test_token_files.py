"""Files of token ids: the library's ids come back, found through the index."""

import struct
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from waymark.llm import token_files
from waymark.llm.frames import stage


def plain(rows):
    """doc_id, start, n_tokens and crc by the library, document after document."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.JSON_50K))
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def read(files):
    return sorted((tuple(r) for r in token_files.digests(files).collect()), key=lambda r: r[1])


def test_files_hold_the_librarys_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    files = stage(token_files.segments(docs, segment_ids=20_000), "token_files")
    assert files.count() > 3
    assert read(files) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_keyed_access(spark):
    docs = spark.createDataFrame([(k * 7, "x " * k) for k in range(50)], "doc_id long, text string")
    files = stage(token_files.segments(docs, segment_ids=100), "token_files")
    found = {r.doc_id: len(r.ids) for r in token_files.fetch(files, [0, 14, 343, 344, -5]).collect()}
    assert found.keys() == {0, 14, 343}
    assert found[0] == 1


def test_special_strings_nulls_repeats_and_no_rows(spark):
    rows = [(3, "a<|endoftext|> b"), (None, None), (3, "q"), (1, ""), (-4, "🙂 é")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, payload string")
    files = stage(token_files.segments(docs), "token_files")
    got, want = read(files), plain(rows)
    assert [(k, n) for k, _, n, _ in got if k != 3] == [(k, n) for k, _, n, _ in want if k != 3]
    assert sorted((n, c) for k, _, n, c in got if k == 3) == sorted((n, c) for k, _, n, c in want if k == 3)
    empty = stage(token_files.segments(docs.limit(0)), "token_files")
    assert read(empty) == [] and token_files.fetch(empty, [1]).collect() == []


def test_hash_is_minimal_and_perfect():
    keys = np.unique(np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 5000))
    index = token_files.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert index.slots(np.array([], dtype=np.int64)).tolist() == []


def test_a_document_longer_than_a_segment(spark):
    docs = spark.createDataFrame([(1, "a " * 500), (2, "b"), (3, "c " * 700)], "doc_id long, text string")
    files = stage(token_files.segments(docs, segment_ids=50), "token_files")
    assert read(files) == plain([(r.doc_id, r.text) for r in docs.collect()])
