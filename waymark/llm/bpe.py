"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list. For every merge rank that occurs there is a bucket
with the list positions whose pair has it, and a two-level bitmap tells which buckets
hold something: the first set bit of each level gives the lowest rank in constant time. A
position whose pair has changed meanwhile is stale and skipped. The cost is nearly
linear in the pre-token, also for one of many thousand bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
import struct
from collections.abc import Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waymark.llm.frames import hold, map_batches, own_names, strings
from waymark.llm.pretokens import Parts

MULTI_50K = "byte_bpe_multi_50k.tiktoken"
#: Ranks per word of the lower bitmap, as a power of two; Python's integers are the words.
_BITS = 8
_LOW = (1 << _BITS) - 1
_BIT = [1 << b for b in range(1 << 12)]
#: Single matches and runs of several that a worker remembers.
KEPT = (400_000, 80_000)
#: Ids handled at a time when digests are made.
BLOCK = 1 << 18


class Merges:
    """The merge table of a rank file, and the rank queue.

    The queue counts ranks downward, ``top - rank``, so that the first rank is the highest
    set bit, which Python's integers tell at once. Queue and bitmap are empty between
    pre-tokens, so one of each serves all of them.
    """

    def __init__(self, ranks: Mapping[bytes, int]):
        self.top = top = max(ranks.values())
        self.ranks = ranks
        self.byte = [ranks[bytes([b])] for b in range(256)]
        #: For each id, the ids that may follow it and ``top`` less the rank, which is the id, of the two as one.
        self.joined: list[dict[int, int]] = [{} for _ in range(top + 1)]
        for word, rank in ranks.items():
            for k in range(1, len(word)):
                if word[:k] in ranks and word[k:] in ranks:
                    self.joined[ranks[word[:k]]][ranks[word[k:]]] = top - rank
        #: The same of every two bytes, -1 for none.
        self.first = [[self.joined[a].get(b, -1) for b in self.byte] for a in self.byte]
        #: List positions whose pair has the rank: none, one, or a heap of several.
        self.buckets: list[int | list[int] | None] = [None] * (top + 1)
        #: Which of 256 ranks have a bucket.
        self.words = [0] * ((top >> _BITS) + 1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank, leftmost first, merges until none is left."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, top, joined, buckets, words = len(piece), self.top, self.joined, self.buckets, self.words
        byte, first = self.byte, self.first
        part = [byte[b] for b in piece]  # id that begins here; -1 for one merged away, and at the end
        part.append(-1)
        after = list(range(1, n + 2))
        before = list(range(-1, n + 1))
        pair = [first[b][c] for b, c in itertools.pairwise(piece)]  # the queue's place of the pair that begins here, -1 for none
        filled = 0  # which words are not empty
        for i, place in enumerate(pair):
            if place >= 0:
                bucket = buckets[place]
                if bucket is None:
                    buckets[place] = i
                    high = place >> _BITS
                    words[high] |= _BIT[place & _LOW]
                    filled |= _BIT[high]
                elif type(bucket) is int:
                    buckets[place] = [bucket, i]
                else:
                    bucket.append(i)  # ascending, so a heap
        pair += (-1, -1)
        while filled:
            high = filled.bit_length() - 1
            word = words[high]
            low = word.bit_length() - 1
            place = high << _BITS | low
            i = buckets[place]
            if type(i) is list and len(i) > 1:
                i = heapq.heappop(i)
            else:
                if type(i) is list:
                    i = i[0]
                buckets[place] = None
                words[high] = word = word ^ _BIT[low]
                if not word:
                    filled ^= _BIT[high]
            if pair[i] != place:
                continue  # stale: merged away, or the pair has changed
            rank = top - place
            middle = after[i]
            end, left = after[middle], before[i]
            part[i], part[middle], pair[middle] = rank, -1, -1
            after[i], before[end] = end, i
            pair[i] = place = joined[rank].get(part[end], -1)
            # Written out for the pairs on both sides: this is the inner loop.
            if place >= 0:
                bucket = buckets[place]
                if bucket is None:
                    buckets[place] = i
                    high = place >> _BITS
                    words[high] |= _BIT[place & _LOW]
                    filled |= _BIT[high]
                elif type(bucket) is int:
                    buckets[place] = [bucket, i] if bucket < i else [i, bucket]
                else:
                    heapq.heappush(bucket, i)
            if left >= 0:
                pair[left] = place = joined[part[left]].get(rank, -1)
                if place >= 0:
                    bucket = buckets[place]
                    if bucket is None:
                        buckets[place] = left
                        high = place >> _BITS
                        words[high] |= _BIT[place & _LOW]
                        filled |= _BIT[high]
                    elif type(bucket) is int:
                        buckets[place] = [bucket, left] if bucket < left else [left, bucket]
                    else:
                        heapq.heappush(bucket, left)
        return [p for p in part if p >= 0]


class Spelling:
    """The bytes written for each id, gathered for many ids at once."""

    def __init__(self, words: list[bytes]):
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(words), dtype=np.uint8)

    def write(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        return self.letters[np.arange(total) + np.repeat(self.starts[ids] - ends + lengths, lengths)].tobytes()

    def blocks(self, ids: np.ndarray):
        for at in range(0, len(ids), BLOCK):
            yield self.write(ids[at : at + BLOCK])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: Mapping[bytes, int]):
        self.ranks, merge = ranks, Merges(ranks).merge
        words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            words[rank] = word
        self.spelling = Spelling(words)
        self.decimals = Spelling([b"%d," % i for i in range(len(words))])
        self.parts = Parts(lambda m: _packed(merge(m.encode())), b"".join, *KEPT)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts.values(text)), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.spelling.blocks(ids))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    with open(path, "rb") as lines:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def _held(path: str | None) -> Codec:
    """This worker's codec; its memory is the only one held."""
    path = path or public_tokenizers.path(MULTI_50K)
    hold(__name__, ("bpe", path), codec(path).parts.forget)
    return codec(path)


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, path: str | None = None, checked: str | None = None) -> DataFrame:
    """``docs`` plus ``ids`` (array of int), the tokens of the whole text.

    ``path`` is a rank file every worker can open. ``checked`` names a boolean column to
    add: whether the ids decode to the text's bytes. A null text counts as empty and has no
    ids; own columns with the added names are replaced; rows that repeat are encoded each.
    """
    added = ["ids", *([checked] if checked else [])]
    docs = own_names(docs, added)
    schema = _with(docs, "ids", T.ArrayType(T.IntegerType()))
    if checked:
        schema = schema.add(checked, T.BooleanType())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _held(path)
        texts = strings(batch.column("text"))
        found = [coder.encode(t) for t in texts]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))]
        if checked:
            columns.append(pa.array([coder.decode(x) == t.encode() for x, t in zip(found, texts, strict=True)]))
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    return map_batches(docs, run, schema)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` plus ``decoded`` (binary), the bytes that ``ids`` stand for; null ids give none."""
    rows = own_names(rows, ["decoded"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _held(path)
        lists = [np.array([] if x is None else x.values.to_numpy(), dtype=np.int64) for x in batch.column("ids")]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([coder.decode(x) for x in lists], pa.binary())], [*batch.schema.names, "decoded"]
        )

    return map_batches(rows, run, _with(rows, "decoded", T.BinaryType()))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document's ids and decoded bytes.

    The ids are digested in the task that makes them, in blocks, so they are not moved. A
    null text counts as empty; rows that repeat are digested each; a null doc_id stays
    null; other columns are not carried.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _held(path)
        counts, digests, decoded = [], [], []
        for text in strings(batch.column("text")):
            ids = coder.encode(text)
            counts.append(len(ids))
            spelled, written = hashlib.sha256(), hashlib.sha256()
            last = (len(ids) - 1) // BLOCK
            for k, block in enumerate(coder.decimals.blocks(ids)):
                spelled.update(block[:-1] if k == last else block)
            for block in coder.spelling.blocks(ids):
                written.update(block)
            digests.append(spelled.hexdigest())
            decoded.append(written.hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
