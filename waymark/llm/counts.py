"""Token counts by heap-and-linked-list byte-pair merging; no ids are made.

The symbols of a pre-token form a linked list and its adjacent pairs a heap by merge rank
and position. Each pop merges one pair, so the count is the initial symbols minus the merges.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Mapping

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from waymark.llm.frames import hold, map_batches, strings
from waymark.llm.pretokens import Parts

JSON_50K = "byte_bpe_50k.json"
LIMIT = 512


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the letters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b if b in shown else 0x100 + hidden.index(b)) for b in range(256)]


Merges = Mapping[tuple[int, int], tuple[int, int]]


def count_pretoken(symbols: list[int], merges: Merges) -> int:
    """Tokens left of ``symbols`` (ids of the bytes) after all merges."""
    n = len(symbols)
    if n < 2:
        return n
    symbols = list(symbols)
    following = list(range(1, n + 1))
    preceding = list(range(-1, n - 1))
    heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
    heapq.heapify(heap)
    merged = 0
    while heap:
        _, i, made = heapq.heappop(heap)
        j = following[i]
        if symbols[i] < 0 or j == n or (m := merges.get((symbols[i], symbols[j]))) is None or m[1] != made:
            continue  # stale
        merged += 1
        symbols[i], symbols[j] = made, -1
        k = following[i] = following[j]
        if k < n:
            preceding[k] = i
            if m := merges.get((made, symbols[k])):
                heapq.heappush(heap, (m[0], i, m[1]))
        h = preceding[i]
        if h >= 0 and (m := merges.get((symbols[h], made))):
            heapq.heappush(heap, (m[0], h, m[1]))
    return n - merged


class Counter:
    """Counts tokens as one vocabulary file gives them, special strings in the text included."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        ids: dict[str, int] = described["model"]["vocab"]
        self.byte_ids = [ids[letter] for letter in byte_letters()]
        self.merges = {
            (ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(described["model"]["merges"])
        }
        self.special = [t["content"] for t in described["added_tokens"]]
        self.parts = Parts(self._match, sum)

    def _match(self, match: str) -> int:
        return count_pretoken([self.byte_ids[b] for b in match.encode()], self.merges)

    def count(self, text: str) -> int:
        """A special string is one token, and the text on either side is read by itself."""
        sections, n = [text], 0
        for special in self.special:
            cut = [s.split(special) for s in sections]
            n += sum(len(c) - 1 for c in cut)
            sections = [s for c in cut for s in c]
        return n + sum(sum(self.parts.values(s)) for s in sections)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every document.

    ``path`` is a byte-level BPE vocabulary file every worker can open. A null text counts
    as empty: no bytes, no tokens. Rows that repeat are counted each; other columns are
    not carried.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path or public_tokenizers.path(JSON_50K))
        hold(__name__, own, own.parts.forget)
        count = own.count
        texts = strings(batch.column("text"))
        tokens = [count(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
