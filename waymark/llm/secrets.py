"""Secret scans: base patterns, and a linear-chain conditional random field that adds spans.

The field tags each token of a text as beginning a secret, inside one or outside, from the
token's shape, its neighbours' shapes and how much of the file looks like data. It is
trained by its exact likelihood on invented lines made from a fixed seed, and decoded by
Viterbi. A token whose outside score leads by more than transitions could ever give back
is outside on the best path, so the decoder only walks the runs of tokens between those.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from waymark.llm.frames import hold, map_batches, strings

#: Fixed values of the query: kind, pattern, and the group and length that a match needs.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LONG_HEX = re.compile(r"[0-9a-f]{16}[0-9a-f]*")
LEAST = {"assign": 12, "access": 18, "hex": 16}

OUT, BEGIN, INSIDE = 0, 1, 2
#: Tokens whose shape is remembered per Python worker, and tokens tagged at a time.
MEMORY, BLOCK = 400_000, 1 << 18

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) in code points of the base patterns' matches that are long enough."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A run of 16 letters that begins a match reaches to the end of the whole run, so no shorter run is lost.
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# --- shapes -------------------------------------------------------------------------------

_EDGES = "\"'`,;:.()[]{}<>!?|"
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_NUMBER = re.compile(r"[+-]?[\d.,:/()%-]+")
_LOWER_HEX = re.compile(r"(?=.*\d)[0-9a-f]+|(?=.*\d)[0-9A-F]+")
_CODE = re.compile(r"[A-Za-z0-9+/_=.~-]+")
_LINK = re.compile(r"https?://|www\.|[^@\s]+@[^@\s]+\.[a-z]+$", re.IGNORECASE)
_KEYWORD = re.compile(
    r"passw|passphrase|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|credential|bearer|authoriz",
    re.IGNORECASE,
)
#: Sorts of token, lengths up to which a length class goes, and the number of codes.
SORTS = ("edge", "word", "upper", "number", "link", "hex", "code", "mixed", "prefix", "other")
LENGTHS = (3, 7, 11, 15, 23, 39)
JOINS = ("none", "ends", "inside")
CODES = 1 + len(SORTS) * (len(LENGTHS) + 1) * 2 * len(JOINS)
DATA_SORTS = ("hex", "code", "mixed", "prefix")


def shape(token: str) -> int:
    """Code of a token's sort, length class, key word and ``=`` or ``:``; 0 is the edge of a text."""
    core = token.strip(_EDGES)
    keyword = bool(_KEYWORD.search(core))
    join = "ends" if token[-1] in "=:" else "inside" if re.search(r"[=:]", core) and not _LINK.match(core) else "none"
    value = re.split(r"[=:]", core, maxsplit=1)[1].strip(_EDGES) if join == "inside" else core
    if not value:
        sort = "edge"
    elif _WORD.fullmatch(value):
        sort = "upper" if value.isupper() and len(value) > 3 else "word"
    elif _NUMBER.fullmatch(value):
        sort = "number"
    elif _LINK.match(value):
        sort = "link"
    elif _LOWER_HEX.fullmatch(value):
        sort = "hex"
    elif _CODE.fullmatch(value):
        digits = sum(c.isdigit() for c in value)
        cased = value.lower() != value and value.upper() != value
        if re.match(r"[A-Za-z]{2,5}[_-][A-Za-z0-9_-]{12}", value) and digits > 1:
            sort = "prefix"
        else:
            sort = "mixed" if digits > 1 and cased else "code" if digits else "other"
    else:
        sort = "other"
    size = sum(len(value) > n for n in LENGTHS)
    return 1 + ((SORTS.index(sort) * (len(LENGTHS) + 1) + size) * 2 + keyword) * len(JOINS) + JOINS.index(join)


@functools.cache
def _parts() -> tuple[np.ndarray, int]:
    """Feature numbers of each code (sort, sort with length, key word, join, whole), and how many there are."""
    rows, names = [[0] * 5], {("edge of text",): 0}
    for code in range(1, CODES):
        rest, join = divmod(code - 1, len(JOINS))
        rest, keyword = divmod(rest, 2)
        sort, size = divmod(rest, len(LENGTHS) + 1)
        keys = [("s", sort), ("l", sort, size), ("k", keyword), ("j", join, sort), ("c", code)]
        rows.append([names.setdefault(k, len(names)) for k in keys])
    return np.array(rows), len(names)


@functools.cache
def _is_data() -> np.ndarray:
    codes = np.arange(CODES) - 1
    sorts = codes // len(JOINS) // 2 // (len(LENGTHS) + 1)
    return (codes >= 0) & np.isin(sorts, [SORTS.index(s) for s in DATA_SORTS])


#: Shares of data-like tokens in a file that part its classes.
FILE_CLASSES = (0.002, 0.02, 0.2)


def file_class(codes: np.ndarray) -> int:
    share = _is_data()[codes].mean() if len(codes) else 0.0
    return sum(share > s for s in FILE_CLASSES)


# --- the field ----------------------------------------------------------------------------


class Field:
    """Scores of the three tags by code of a token, of the one before and of the one after, and by file class."""

    def __init__(self, own: np.ndarray, before: np.ndarray, after: np.ndarray, file: np.ndarray, moves: np.ndarray):
        self.own, self.before, self.after, self.file, self.moves = own, before, after, file, moves
        m = moves
        # The most that transitions can favour another tag over OUT at one place.
        self.slack = max(
            m[a, b] + m[b, c] - m[a, OUT] - m[OUT, c] for a in range(3) for c in range(3) for b in (BEGIN, INSIDE)
        )

    def scores(self, codes: np.ndarray, files: np.ndarray) -> np.ndarray:
        """``codes`` begins and ends with the edge code; scores are for the tokens between."""
        return self.own[codes[1:-1]] + self.before[codes[:-2]] + self.after[codes[2:]] + self.file[files]

    def tags(self, codes: np.ndarray, files: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first, last) token of each secret; texts in ``codes`` are parted by edge codes, always OUT."""
        scores = self.scores(codes, files)
        lead = scores[:, OUT] - np.maximum(scores[:, BEGIN], scores[:, INSIDE])
        unsure = np.flatnonzero((lead <= self.slack) & (codes[1:-1] != 0))
        if not len(unsure):
            return
        for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
            start = None
            for at, tag in zip(run.tolist(), self._viterbi(scores[run]), strict=True):
                if tag != INSIDE and start is not None:
                    yield start, at - 1
                    start = None
                if tag == BEGIN or tag == INSIDE and start is None:
                    start = at
            if start is not None:
                yield start, int(run[-1])

    def _viterbi(self, scores: np.ndarray) -> list[int]:
        """Best tags of a run with OUT on both sides."""
        best, back = self.moves[OUT] + scores[0], []
        for row in scores[1:]:
            reach = best[:, None] + self.moves
            back.append(reach.argmax(axis=0))
            best = reach.max(axis=0) + row
        tag = int((best + self.moves[:, OUT]).argmax())
        path = [tag]
        for pointers in reversed(back):
            tag = int(pointers[tag])
            path.append(tag)
        return path[::-1]


# --- training -----------------------------------------------------------------------------

SEED, LINES, EPOCHS, STEP, DECAY = 7, 800, 100, 0.1, 1e-3
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_FIRST = "the of and sur mit para être über niño auf les con was is it by".split()


def _word(r: random.Random) -> str:
    if r.random() < 0.3:
        return r.choice(_FIRST)
    word = "".join(r.choice(["th", "er", "on", "an", "é", "ü", "ch", "ung", "ci", "ón", "re", "st"]) for _ in range(r.randint(1, 7)))
    word = word.title() if r.random() < 0.15 else word.upper() if r.random() < 0.04 else word
    return word + r.choice([""] * 8 + [",", ".", "!!", "###"])


def _chars(r: random.Random, letters: str, low: int, high: int) -> str:
    return "".join(r.choice(letters) for _ in range(r.randint(low, high)))


def _secret(r: random.Random) -> list[str]:
    hexes, upper = "0123456789abcdef", _LETTERS.upper() + "0123456789"
    every = _LETTERS + upper
    value = r.choice(
        [
            lambda: _chars(r, hexes, 16, 64),
            lambda: _chars(r, every, 20, 48),
            lambda: _chars(r, every + "+/", 24, 64) + "=",
        ]
    )()
    kind = r.randrange(8)
    name = r.choice("password passwd secret token api_key apikey pwd client_secret access_key private_key".split())
    quote = r.choice(['"', "'", ""])
    if kind == 0:
        return ["AKIA" + _chars(r, upper, 16, 16)]
    if kind == 1:
        return [f"{name}={quote}{value}{quote}"]
    if kind == 2:
        return [name, r.choice("=:"), f"{quote}{value}{quote}"]
    if kind == 3:
        return [f"{name}:", f"{quote}{value}{quote}"]
    if kind == 4:
        return ["Authorization:", "Bearer", "eyJ" + _chars(r, every, 20, 40) + "." + _chars(r, every, 20, 40)]
    if kind == 5:
        return [r.choice(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + _chars(r, every, 24, 40)]
    if kind == 6:
        return [_chars(r, hexes, 32, 64)]
    return [name, "is", value]


def _other(r: random.Random) -> list[str]:
    """Tokens with digits or signs that are no secrets."""
    return r.choice(
        [
            lambda: [f"{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}"],
            lambda: [f"+1 ({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"],
            lambda: [f"{r.randint(1, 31)}.{r.randint(1, 12)}.{r.randint(1980, 2030)}"],
            lambda: [f"https://www.example.com/{_chars(r, _LETTERS, 3, 9)}/{r.randint(1, 99999)}"],
            lambda: [f"{_chars(r, _LETTERS, 3, 9)}{r.randint(1, 99)}@example.com"],
            lambda: [_word(r) + "=" + str(r.randint(1, 99))],
            lambda: [r.choice("password token secret key".split()), _word(r)],
            lambda: [_chars(r, _LETTERS, 12, 30)],
            lambda: [_chars(r, _LETTERS, 2, 6) + str(r.randint(1, 9999))],
            lambda: [_word(r) + "-" + _word(r) + "-" + _word(r)],
            lambda: [str(r.randint(10**9, 10**12))],
            lambda: ["$$$"] + [_word(r) + "%%%"] + ["|"],
        ]
    )()


def training_lines(seed: int = SEED, lines: int = LINES) -> list[tuple[list[int], int, list[int]]]:
    """(codes, file class, tags) of invented lines."""
    r = random.Random(seed)
    out = []
    for _ in range(lines):
        tokens: list[str] = []
        tags: list[int] = []
        for _ in range(r.randint(1, 3)):
            words = [_word(r) for _ in range(r.randint(0, 8))]
            tokens, tags = tokens + words, tags + [OUT] * len(words)
            if r.random() < 0.45:
                made = _secret(r)
                tags += [BEGIN] + [INSIDE] * (len(made) - 1)
            else:
                made = " ".join(_other(r)).split()
                tags += [OUT] * len(made)
            tokens += made
        out.append(([shape(t) for t in tokens], r.randrange(len(FILE_CLASSES) + 1), tags))
    return out


@functools.lru_cache(maxsize=1)
def trained(seed: int = SEED, lines: int = LINES) -> Field:
    """The field of greatest penalised likelihood on the invented lines, by adaptive gradient steps."""
    data = training_lines(seed, lines)
    longest = max(len(c) for c, _, _ in data)
    parts, n = _parts()
    codes = np.zeros((len(data), longest + 2), dtype=np.int64)
    real = np.zeros((len(data), longest), dtype=bool)
    gold = np.zeros((len(data), longest), dtype=np.int64)
    files = np.array([f for _, f, _ in data])
    for k, (c, _, t) in enumerate(data):
        codes[k, 1 : len(c) + 1], real[k, : len(c)], gold[k, : len(t)] = c, True, t
    # Features of every place: its own parts, those before and after, and the file's class.
    places = np.concatenate(
        [parts[codes[:, 1:-1]], n + parts[codes[:, :-2]], 2 * n + parts[codes[:, 2:]]], axis=2
    )
    places = np.concatenate([places, np.broadcast_to(3 * n + files[:, None, None], (*gold.shape, 1))], axis=2)
    weights, moves = np.zeros((3 * n + len(FILE_CLASSES) + 1, 3)), np.zeros((3, 3))
    seen_w, seen_m = np.full(weights.shape, 1e-8), np.full(moves.shape, 1e-8)
    onehot = np.eye(3)[gold] * real[..., None]
    pairs = real[:, 1:] & real[:, :-1]
    gold_moves = np.einsum("bti,btj,bt->ij", onehot[:, :-1], onehot[:, 1:], pairs)

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(EPOCHS):
        scores = weights[places].sum(axis=2) * real[..., None]
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, longest):
            step = log_sum(forward[:, t - 1, :, None] + moves, 1) + scores[:, t]
            forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = log_sum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], step, 0.0)
        total = log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        joint = np.exp(
            forward[:, :-1, :, None] + moves + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
        )
        gradient = np.zeros_like(weights)
        np.add.at(gradient, places, np.broadcast_to((marginal - onehot)[:, :, None, :], (*places.shape, 3)))
        gradient = gradient / len(data) + DECAY * weights
        move_gradient = ((joint * pairs[..., None, None]).sum(axis=(0, 1)) - gold_moves) / len(data) + DECAY * moves
        seen_w += gradient**2
        seen_m += move_gradient**2
        weights = weights - STEP * gradient / np.sqrt(seen_w)
        moves = moves - STEP * move_gradient / np.sqrt(seen_m)

    by_code = [weights[k * n + parts].sum(axis=1) for k in range(3)]
    return Field(*by_code, weights[3 * n :], moves)


# --- scanning -----------------------------------------------------------------------------


class Scanner:
    """Base and added spans of many texts."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, int] = {}

    def _codes(self, tokens: list[str]) -> np.ndarray:
        codes = list(map(self.known.get, tokens))
        if None in codes:
            if len(self.known) > MEMORY:
                self.known.clear()
            for k, code in enumerate(codes):
                if code is None:
                    codes[k] = code = shape(tokens[k])
                    if len(tokens[k]) <= 64:
                        self.known[tokens[k]] = code
        return np.array(codes, dtype=np.int16)

    def added(self, texts: list[str]) -> Iterator[tuple[int, int, int]]:
        """(text, first token, last token) of the field's secrets, in blocks of texts."""
        block: list[tuple[int, np.ndarray]] = []
        held = 0
        for k, text in enumerate(texts):
            codes = self._codes(text.split())
            block.append((k, codes))
            held += len(codes)
            if held >= BLOCK:
                yield from self._tagged(block)
                block, held = [], 0
        yield from self._tagged(block)

    def _tagged(self, block: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
        if not block:
            return
        edge = np.zeros(1, np.int16)
        lengths = np.array([len(c) + 1 for _, c in block])
        starts = np.cumsum(lengths) - lengths
        codes = np.concatenate([edge, *(x for _, c in block for x in (c, edge)), edge])
        files = np.repeat([file_class(c) for _, c in block], lengths)
        for first, last in self.field.tags(codes, files):
            k = int(np.searchsorted(starts, first, side="right")) - 1
            yield block[k][0], int(first - starts[k]), int(last - starts[k])

    def scan(self, texts: list[str]) -> list[list[Span]]:
        """All spans of each text, by start, then kind."""
        found = [base_spans(t) for t in texts]
        tokens: dict[int, list[tuple[int, int]]] = {}
        for k, first, last in self.added(texts):
            tokens.setdefault(k, []).append((first, last))
        for k, runs in tokens.items():
            places = [(m.start(), m.end()) for m in re.finditer(r"\S+", texts[k])]
            base = list(found[k])
            for first, last in runs:
                start, end = places[first][0], places[last][1]
                while start < end and texts[k][start] in _EDGES:
                    start += 1
                while start < end and texts[k][end - 1] in _EDGES:
                    end -= 1
                if start < end and not any(s < end and start < e for s, e, _ in base):
                    found[k].append((start, end, "crf"))
            found[k].sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return found


_SCANNERS: dict[bytes, Scanner] = {}


def scanner(field: Field) -> Scanner:
    """This worker's scanner for a field; tokens it has met stay known from task to task."""
    return _SCANNERS.setdefault(field.own.tobytes(), Scanner(field))


def _spelled(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPANS = "array<struct<start: long, end: long, kind: string>>"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of (start, end, kind), of every document's whole text.

    Places are code points, ends exclusive. ``kind`` is assign, access or hex for the base
    patterns, crf for spans the field adds where no base span lies. A null text counts as
    empty and has no spans. Rows that repeat are scanned each; other columns are not carried.
    """

    field = trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = scanner(field)
        hold(__name__, own, own.known.clear)
        found = own.scan(strings(batch.column("text")))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        spans = [[{"start": s, "end": e, "kind": k} for s, e, k in doc] for doc in found]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id long, spans {SPANS}")


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of base spans by kind, their digest, and all spans as text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc in batch.column("spans").to_pylist():
            spans = [(s["start"], s["end"], s["kind"]) for s in doc]
            base = [s for s in spans if s[2] != "crf"]
            counts = [sum(s[2] == k for s in base) for k in KINDS[:3]]
            rows.append((*counts, hashlib.sha256(_spelled(base).encode()).hexdigest(), _spelled(spans)))
        types = [pa.int64()] * 3 + [pa.string()] * 2
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *columns], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        )

    return map_batches(
        scan(docs),
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
