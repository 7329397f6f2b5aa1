"""Periodic runs of words by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton. Its suffix-link tree is kept as a
link-cut tree whose preferred paths are segments with one last-occurrence end. Appending
word i walks from its prefix state to the root and gives the whole path the end i. A
segment met on the way that ended last at j, and whose longest word sequence has length L,
says that the last L words also ended at j: with d = i - j <= L that is a square of period
d ending at i, and L + d words up to i have that period. A run shows such a square at each
of its places from its second period on, so squares of one period at consecutive places
are put together to the run, which begins where the first of them does.

The automaton is given only stretches of words that can hold a run: all sequences of k
words inside a long enough run occur in it twice, so runs lie within maximal stretches of
places whose next k words occur again in the text (:func:`stretches`).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Hashable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from waymark.llm.frames import map_batches

#: A run has at least so many words, and at least so many periods.
WORDS, TIMES = 24, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)

Run = tuple[int, int, int]  # start, length, period


class Automaton:
    """A suffix automaton that grows by words; :meth:`append` returns the squares that end there.

    State 0 is the empty sequence and no node of the link-cut tree. A preferred path is a
    splay tree; the end its nodes share is stored at the splay tree's root.
    """

    def __init__(self) -> None:
        self.longest = [0]
        self.link = [-1]
        self.next: list[dict[Hashable, int]] = [{}]
        self.last = 0
        self.up, self.left, self.right, self.end = [0], [0], [0], [-1]

    def _state(self, longest: int, link: int, following: dict[Hashable, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.next.append(following)
        self.up.append(link)
        self.left.append(0)
        self.right.append(0)
        self.end.append(-1)
        return len(self.longest) - 1

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree."""
        up, left, right, end = self.up, self.left, self.right, self.end
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            inner = z and (left[z] == y or right[z] == y)
            if inner:
                # Two steps: turn the parent first where both lean to one side.
                v = y if (left[y] == x) == (left[z] == y) else x
                for w in (v, x):
                    p = up[w]
                    g = up[p]
                    if left[p] == w:
                        b = left[p] = right[w]
                        right[w] = p
                    else:
                        b = right[p] = left[w]
                        left[w] = p
                    if b:
                        up[b] = p
                    if g:
                        if left[g] == p:
                            left[g] = w
                        elif right[g] == p:
                            right[g] = w
                    if end[p] >= 0:
                        end[w], end[p] = end[p], -1
                    up[p], up[w] = w, g
            else:
                if left[y] == x:
                    b = left[y] = right[x]
                    right[x] = y
                else:
                    b = right[y] = left[x]
                    left[x] = y
                if b:
                    up[b] = y
                if end[y] >= 0:
                    end[x], end[y] = end[y], -1
                up[y], up[x] = x, z
            y = up[x]

    def _extend(self, word: Hashable) -> int:
        following, link, longest = self.next, self.link, self.longest
        own = self._state(longest[self.last] + 1, 0, {})
        p = self.last
        while p >= 0 and word not in following[p]:
            following[p][word] = own
            p = link[p]
        if p >= 0:
            q = following[p][word]
            if longest[p] + 1 < longest[q]:
                # The copy stands for the shorter sequences of q and last ended where they did,
                # so it joins q's preferred path, directly above q.
                copy = self._state(longest[p] + 1, link[q], dict(following[q]))
                while p >= 0 and following[p].get(word) == q:
                    following[p][word] = copy
                    p = link[p]
                self._splay(q)
                above = self.left[q]
                self.left[copy] = above
                if above:
                    self.up[above] = copy
                self.left[q] = copy
                self.up[copy] = q
                link[q] = q = copy
            link[own] = self.up[own] = q
        self.last = own
        return own

    def append(self, word: Hashable, i: int) -> list[tuple[int, int]]:
        """(d, n): the n words up to place i have period d, and n >= 2 * d; n is the most for this d."""
        x, below, squares = self._extend(word), 0, []
        up, right, end, longest = self.up, self.right, self.end, self.longest
        while x:
            self._splay(x)
            j = end[x]
            if j >= 0 and i - j <= longest[x]:
                squares.append((i - j, longest[x] + i - j))
            deeper = right[x]
            if deeper:
                end[deeper] = j
            end[x] = -1
            right[x] = below
            below, x = x, up[x]
        end[below] = i
        return squares


def runs(words: Sequence[Hashable], least: int = WORDS, times: int = TIMES) -> list[Run]:
    """Every run (start, length, smallest period) with length >= max(least, times * period); ``times`` >= 2."""
    automaton, found = Automaton(), []
    open_: dict[int, list[int]] = {}  # period: start, last place seen
    for i, word in enumerate(words):
        squares = automaton.append(word, i)
        if squares or open_:
            for d, n in squares:
                run = open_.get(d)
                if run is None:
                    open_[d] = [i - n + 1, i]
                else:
                    run[1] = i
            for d in [d for d, run in open_.items() if run[1] < i]:
                start, last = open_.pop(d)
                found.append((start, last - start + 1, d))
    found += [(start, last - start + 1, d) for d, (start, last) in open_.items()]
    return sorted((r for r in found if r[1] >= max(least, times * r[2])), key=lambda r: (r[0], r[2]))


def gram_size(least: int = WORDS, times: int = TIMES) -> int:
    """The most words k such that all k words in a row inside any run occur in it twice (0 if none).

    A run of n words with period q holds them twice if n >= 2 * q + k. Its length is at
    least ``least``, and ``times * q``, which is more from a period of ``least / times`` on.
    """
    even = least // times
    return max(0, min(least - 2 * even, (times - 2) * (even + 1)))


def stretches(ids: np.ndarray, least: int = WORDS, times: int = TIMES) -> Iterator[tuple[int, int]]:
    """(start, end) of the maximal stretches of ``ids`` that may hold runs; every run lies in one."""
    k, n = gram_size(least, times), len(ids)
    if n < least:
        return
    if k < 2:
        yield 0, n
        return
    # Hashes of k words in a row from those of half as many; equal hashes of different words only add work.
    with np.errstate(over="ignore"):
        grams, size = ids.astype(np.uint64), 1
        while size < k:
            step = min(size, k - size)
            grams = (grams[:-step] * _BASE + grams[step:] + np.uint64(1)) * _MIX
            grams ^= grams >> np.uint64(29)
            size += step
    order = np.argsort(grams, kind="stable")
    equal = grams[order[1:]] == grams[order[:-1]]
    if not equal.any():
        return
    again = np.zeros(len(grams) + 2, dtype=np.int8)
    again[order[1:][equal] + 1] = 1
    again[order[:-1][equal] + 1] = 1
    edges = np.flatnonzero(np.diff(again))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if end - start + k - 1 >= least:
            yield start, end + k - 1


def text_runs(words: Sequence[Hashable], least: int = WORDS, times: int = TIMES) -> list[Run]:
    """:func:`runs` of a whole text, by its stretches."""
    if len(words) < least:
        return []
    numbers: dict[Hashable, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = []
    for start, end in stretches(ids, least, times):
        found += [(start + s, n, q) for s, n, q in runs(ids[start:end].tolist(), least, times)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], found: Sequence[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not found:
        return list(words)
    kept = bytearray(b"\x01") * len(words)
    for start, n, q in found:
        kept[start + q : start + n] = bytes(n - q)
    return [w for w, k in zip(words, kept, strict=True) if k]


def longest_of(found: Sequence[Run]) -> Run | None:
    """The run with the greatest exact length / period; ties go to the smallest start, then period."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words with a periodic end planted by the document's number: in one of ten documents, from a number on."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return words[:a] + words[a : a + p] * whole + words[a : a + rest]


DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def digest_rows(docs: DataFrame, planted: bool = False) -> DataFrame:
    """doc_id, n_runs, the run of most periods, and digests of all runs and of the text without repeats.

    Words are runs of anything but ASCII white space. A text that is null or has no words
    has no runs, and four nulls for its run; so has any text without one. Rows that repeat
    are judged each; other columns are not carried. A null doc_id stays null. ``planted``
    first gives one of ten documents (by its doc_id; none without one) a periodic tail.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = (text or "").encode().split()
            if planted:
                words = repeated_tail(words, doc_id)
            found = text_runs(words)
            best = longest_of(found)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
            values = (
                len(found),
                *(best or (None, None, None)),
                best and 1000 * best[1] // best[2],
                hashlib.sha256(listed).hexdigest(),
                hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], [f.split()[0] for f in DIGESTS.split(", ")])

    return map_batches(docs.select("doc_id", "text"), run, DIGESTS)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with text cut to the words outside repeats, joined by one space, where a run was found.

    Texts without a run, null ones included, and all other columns stay as they are.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text in batch.column("text").to_pylist():
            words = (text or "").encode().split()
            found = text_runs(words)
            texts.append(b" ".join(collapsed(words, found)).decode() if found else text)
        at = batch.schema.get_field_index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return map_batches(docs, run, docs.schema)
