"""Splitting a text into pre-tokens, with a bounded memory of what each part gave.

Byte-pair merges never cross the matches of the tokenizer's pattern, and a match never
reaches over a blank between two visible characters. So a text is cut at those blanks, a
part's value depends on the part alone, and a part met again is looked up.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

import public_tokenizers
import regex

V = TypeVar("V")

MATCHES = regex.compile(public_tokenizers.PATTERN).findall
#: Single matches, and runs of several, kept per Python worker: about 200 MB with short
#: words. Half of them are young; when those are full they become the old ones, and what
#: is met again among the old is young again, so only parts not met for long are lost.
WORDS, RUNS = 800_000, 150_000
#: Longer parts are not kept, so that the memory is bounded in bytes too.
LONGEST_KEPT = 64
#: Marks that are one match together behind letters, since no contraction begins with them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
WHITE = frozenset(c for c in map(chr, range(0x3001)) if regex.match(r"\s", c))
#: What a piece begins with that does not close the one before.
SHUT = WHITE | {""}


def _opens(piece: str) -> bool:
    return bool(piece) and piece[0] not in WHITE


def _closed(piece: str) -> bool:
    return bool(piece) and piece[-1] not in WHITE


class Memory(dict[str, V]):
    """Values by text in two generations of bounded size; ``old`` is looked at by :meth:`find` alone."""

    def __init__(self, most: int):
        super().__init__()
        self.half = max(1, most // 2)
        self.old: dict[str, V] = {}

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def find(self, text: str) -> V | None:
        value = self.get(text)
        if value is None and (value := self.old.get(text)) is not None:
            self.keep(text, value)
        return value

    def keep(self, text: str, value: V) -> None:
        if len(text) <= LONGEST_KEPT:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[text] = value


class Parts(Generic[V]):
    """``values(text)``: the values of the parts of a text, in order.

    ``of_match`` gives the value of one match of the pattern, ``join`` that of several in
    a row. A value is never None.
    """

    def __init__(self, of_match: Callable[[str], V], join: Callable[[list[V]], V], words: int = WORDS, runs: int = RUNS):
        self.of_match, self.join = of_match, join
        self.words: Memory[V] = Memory(words)  # read after a blank, which is left out of the key
        self.runs: Memory[V] = Memory(runs)  # likewise
        self.others: Memory[V] = Memory(runs)  # as they are

    def forget(self) -> None:
        for store in (self.words, self.runs, self.others):
            store.forget()

    def _match(self, match: str) -> V:
        after_blank = len(match) > 1 and match[0] == " " and match[1] not in WHITE
        store, key = (self.words, match[1:]) if after_blank else (self.others, match)
        value = store.get(key)
        if value is None:
            value = store.find(key)
        if value is None:
            value = self.of_match(match)
            store.keep(key, value)
        return value

    def _run(self, text: str) -> V:
        found = MATCHES(text)
        return self._match(found[0]) if len(found) == 1 else self.join([self._match(m) for m in found])

    def _letters(self, text: str, blank: str) -> V | None:
        """Value of letters, with or without marks after them, behind a blank or none; else nothing."""
        if text.isalpha():
            return self._match(blank + text)
        word = text.rstrip(MARKS)
        if word.isalpha():
            return self.join([self._match(blank + word), self._match(text[len(word) :])])
        return None

    def _plain(self, piece: str) -> V | None:
        """Value of a piece after a blank that needs no pattern: marks after letters are a match of their own,
        and so is a line break between two visible characters."""
        words, word = self.words, piece.rstrip(MARKS)
        if word.isalpha():
            marks = self._match(piece[len(word) :])
            value = words.get(word)
            if value is None:
                return self.join([self._match(" " + word), marks])
            value = self.join([value, marks])
            words.keep(piece, value)
            return value
        first, line, second = piece.partition("\n")
        if line and (one := self._letters(first, " ")) is not None and (two := self._letters(second, "")) is not None:
            return self.join([one, self._match(line), two])
        return None

    def values(self, text: str) -> list[V]:
        if not text:
            return []
        words = self.words
        pieces = text.split(" ")
        known = list(map(words.get, pieces))
        last = len(pieces)
        pieces.append(".")  # the end closes the last piece as a visible character does
        known[0] = None  # words are kept as they read after a blank, and this one has none
        result: list[V] = []
        done = seen = 0
        while True:
            try:
                at = known.index(None, seen)
            except ValueError:
                return result + known[done:] if result else known[done:]
            if at and pieces[at + 1][:1] not in SHUT:
                piece = pieces[at]
                value = words.get(piece)  # met earlier in this text
                if value is None and (value := words.old.get(piece)) is not None:
                    words.keep(piece, value)
                elif value is None:
                    if piece.isalpha():  # letters alone are one match
                        value = self.of_match(" " + piece)
                        words.keep(piece, value)
                    else:
                        value = self._plain(piece)
                if value is not None:
                    known[at] = value
                    seen = at + 1
                    continue
            # A piece that begins or ends with white space, or is empty, is read with its neighbours.
            start = at - 1 if at > done and not _opens(pieces[at]) else at
            end = at + 1
            while end < last and not (_closed(pieces[end - 1]) and _opens(pieces[end])):
                end += 1
            result += known[done:start]
            run = " ".join(pieces[start:end])
            if start:
                value = self.runs.find(run)
                if value is None:
                    value = self._run(" " + run)
                    if run not in self.words:
                        self.runs.keep(run, value)
                result.append(value)
            elif run:
                result.append(self._run(run))
            done = seen = end
