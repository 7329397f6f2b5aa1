"""Language ID by segmentation-marginalised unigrams.

A word's probability in a language is the sum, over all ways of cutting it into pieces of
a fixed public vocabulary, of the product of the pieces' probabilities; a forward pass
adds them up. A text's score is the product over its words. The piece probabilities are
learned by expectation maximisation, with the same forward pass and its mirror.
"""

from __future__ import annotations

import dataclasses
import functools
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.frames import hold, map_batches, own_names, stage, strings

PIECES = "piece_bpe_32k.model"
UNKNOWN = "und"
#: Labelled documents learned from in each language, about; chosen by a hash of doc_id.
MAX_DOCS = 1000
ROUNDS = 2
#: Longest piece in bytes; longer words are scored in cuts of ``LONGEST_WORD`` bytes.
LONGEST_PIECE, LONGEST_WORD = 16, 40
#: Shares of the pooled and of the even distribution in each language's.
POOLED, EVEN = 0.05, 0.01
#: Words whose score is remembered per Python worker, and words scored at a time.
MEMORY, BLOCK = 150_000, 1 << 15
LETTERS = re.compile(r"[^\W\d_]+")
_BASE, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
#: Bits of a hash looked at before it is searched for.
LEADING = 17


def _leading(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _SPREAD >> np.uint64(64 - LEADING)).astype(np.int64)


class Vocabulary:
    """Pieces as bytes, a blank marking the start of a word, found by a hash for each length."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        whole = {
            model.id_to_piece(i).replace("▁", " ").lower().encode()
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        self.pieces = sorted({p for p in whole if len(p) <= LONGEST_PIECE} | {bytes([b]) for b in range(256)})
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, LONGEST_PIECE + 1):
            own = np.array([i for i, p in enumerate(self.pieces) if len(p) == length], dtype=np.int64)
            letters = np.array([list(self.pieces[i]) for i in own], dtype=np.uint64).reshape(len(own), length)
            hashes = np.zeros(len(own), dtype=np.uint64)
            for k in range(length):
                hashes = hashes * _BASE + letters[:, k] + np.uint64(1)
            order = np.argsort(hashes)
            self.tables.append((hashes[order], own[order]))
        #: For each length, which leading bits a piece's spread hash has; most places have none.
        self.leading = []
        for hashes, _ in self.tables:
            there = np.zeros(1 << LEADING, dtype=bool)
            there[_leading(hashes)] = True
            self.leading.append(there)

    def spans(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, pieces): for words of one length, the piece that begins at each place, or -1."""
        n, size = words.shape
        hashes = np.zeros((n, size), dtype=np.uint64)
        for length in range(1, min(size, LONGEST_PIECE) + 1):
            places = size - length + 1
            hashes = hashes[:, :places] * _BASE + words[:, length - 1 :].astype(np.uint64) + np.uint64(1)
            known, ids = self.tables[length - 1]
            if not len(known):
                continue
            maybe = np.flatnonzero(self.leading[length - 1][_leading(hashes.ravel())])
            wanted = hashes.ravel()[maybe]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            found = np.full(hashes.size, -1)
            found[maybe] = np.where(known[at] == wanted, ids[at], -1)
            yield length, found.reshape(hashes.shape)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def cuts(word: str) -> list[bytes]:
    """The bytes of a word after its marking blank, in cuts of bounded length."""
    text = b" " + word.lower().encode()
    return [text[i : i + LONGEST_WORD] for i in range(0, len(text), LONGEST_WORD)]


def by_length(words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, letters) of the words of each length."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        yield places, np.frombuffer(b"".join(words[i] for i in places), np.uint8).reshape(len(places), length)


def forward(letters: np.ndarray, table: list[tuple[int, np.ndarray]], probabilities: np.ndarray) -> np.ndarray:
    """(word, place, language): summed probability of all segmentations of each beginning."""
    n, size = letters.shape
    sums = np.zeros((size + 1, n, probabilities.shape[1]))
    sums[0] = 1.0
    # By length, the words with a piece at each place and these pieces; long ones are few.
    ending: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(size + 1)]
    for length, pieces in table:
        places, words = np.nonzero(pieces.T >= 0)
        ids = pieces[words, places]
        cut = np.searchsorted(places, np.arange(pieces.shape[1] + 1))
        for start in range(pieces.shape[1]):
            low, high = cut[start], cut[start + 1]
            if high > low:
                ending[start + length].append((start, words[low:high], ids[low:high]))
    for end, pieces_here in enumerate(ending):
        for start, words, ids in pieces_here:
            if len(words) == n:
                sums[end] += sums[start] * probabilities.take(ids, axis=0)
            else:
                sums[end][words] += sums[start].take(words, axis=0) * probabilities.take(ids, axis=0)
    return sums.transpose(1, 0, 2)


def backward(letters: np.ndarray, table: list[tuple[int, np.ndarray]], probabilities: np.ndarray) -> np.ndarray:
    """The same of each rest."""
    n, size = letters.shape
    sums = np.zeros((n, size + 1, probabilities.shape[1]))
    sums[:, size] = 1.0
    for start in range(size - 1, -1, -1):
        for length, pieces in table:
            if start + length <= size:
                sums[:, start] += sums[:, start + length] * probabilities[pieces[:, start]]
    return sums


def word_scores(words: Sequence[bytes], vocab: Vocabulary, probabilities: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language. ``probabilities`` ends with a row of zeros, for no piece."""
    out = np.zeros((len(words), probabilities.shape[1]))
    for places, letters in by_length(words):
        out[places] = np.log(forward(letters, list(vocab.spans(letters)), probabilities)[:, -1])
    return out


def expected(words: Sequence[bytes], counts: np.ndarray, vocab: Vocabulary, probabilities: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations; ``counts`` is (word, language)."""
    uses = np.zeros((len(vocab.pieces) + 1, probabilities.shape[1]))
    for places, letters in by_length(words):
        table = list(vocab.spans(letters))
        ahead, behind = forward(letters, table, probabilities), backward(letters, table, probabilities)
        weight = counts[places] / ahead[:, -1]
        for length, pieces in table:
            for start in range(pieces.shape[1]):
                ids = pieces[:, start]
                share = ahead[:, start] * probabilities[ids] * behind[:, start + length] * weight
                np.add.at(uses, ids, share)
    return uses[:-1]


@dataclasses.dataclass
class Model:
    languages: list[str]
    #: (piece, language), with a last row of zeros that index -1 finds
    probabilities: np.ndarray
    path: str


def _normed(uses: np.ndarray) -> np.ndarray:
    pieces = len(uses)
    own = uses / np.maximum(uses.sum(axis=0), 1e-12)
    pooled = uses.sum(axis=1, keepdims=True) / max(uses.sum(), 1e-12)
    mixed = (1 - POOLED - EVEN) * own + POOLED * pooled + EVEN / pieces
    return np.concatenate([mixed, np.zeros((1, uses.shape[1]))])


def held_out() -> Column:
    """Documents never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, path: str | None = None, rounds: int = ROUNDS) -> Model:
    """Learn from labelled documents that are not held out, about ``max_docs`` of each language.

    Word counts are made by Spark, and the expectations of each round too; the driver gets
    one number for each piece and language.
    """
    path = path or public_tokenizers.path(PIECES)
    labelled = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    vocab = vocabulary(path)
    if not languages:
        return Model([], np.zeros((len(vocab.pieces) + 1, 0)), path)
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, max_docs / sizes[lang]))]), F.col("lang")
    )
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    tokens = chosen.select("lang", F.explode(F.split("text", r"\s+")).alias("token"))
    counts = stage(tokens.groupBy("lang", "token").agg(F.count("*").alias("n")), "words")
    column = {lang: k for k, lang in enumerate(languages)}
    probabilities = np.full((len(vocab.pieces) + 1, len(languages)), 1 / len(vocab.pieces))
    probabilities[-1] = 0.0

    for _ in range(rounds):
        current = probabilities

        def run(batch: pa.RecordBatch, current: np.ndarray = current) -> pa.RecordBatch:
            words: list[bytes] = []
            rows: list[tuple[int, int]] = []
            for lang, token, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "token", "n")), strict=True):
                for run_ in LETTERS.findall(token):
                    for cut in cuts(run_):
                        words.append(cut)
                        rows.append((column[lang], n))
            weights = np.zeros((len(words), len(column)))
            for k, (lang, n) in enumerate(rows):
                weights[k, lang] = n
            uses = expected(words, weights, vocabulary(path), current)
            pieces, langs = np.nonzero(uses)
            return pa.RecordBatch.from_arrays(
                [pa.array(pieces), pa.array(langs), pa.array(uses[pieces, langs])], ["piece", "lang", "uses"]
            )

        sums = map_batches(counts, run, "piece long, lang long, uses double").groupBy("piece", "lang")
        uses = np.zeros((len(vocab.pieces), len(languages)))
        for row in sums.agg(F.sum("uses").alias("uses")).toLocalIterator():
            uses[row["piece"], row["lang"]] = round(row["uses"], 6)
        probabilities = _normed(uses)
    return Model(languages, probabilities, path)


class Scorer:
    """Scores texts with one model; the score of a word met before is looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.vocab = vocabulary(model.path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages)))
        #: When each row was last looked up, in lookups.
        self.used = np.zeros(0, dtype=np.int64)
        self.now = 0

    def _make_room(self) -> None:
        """Keep the half of a full memory that was looked up last."""
        if len(self.known) <= MEMORY:
            return
        kept = self.used >= np.sort(self.used)[-(MEMORY // 2)]
        if kept.sum() > MEMORY:
            kept[:] = False
        # Rows are numbered in the order of the words.
        self.known = {w: k for k, w in enumerate(itertools.compress(self.known, kept.tolist()))}
        self.rows, self.used = self.rows[kept], self.used[kept]

    def _learn(self, fresh: list[str]) -> None:
        words: dict[bytes, int] = {}
        owners: list[int] = []
        places: list[int] = []
        for k, word in enumerate(fresh):
            for cut in cuts(word):
                owners.append(k)
                places.append(words.setdefault(cut, len(words)))
        scores = np.zeros((len(fresh), len(self.model.languages)))
        if words:
            found = word_scores(list(words), self.vocab, self.model.probabilities)[places]
            if len(owners) == len(fresh):
                scores = found
            else:
                np.add.at(scores, owners, found)
        self.known.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh)), strict=True))
        self.rows = np.concatenate([self.rows, scores])
        self.used = np.concatenate([self.used, np.full(len(fresh), self.now, dtype=np.int64)])

    def sums(self, words: list[str]) -> np.ndarray:
        """Summed log probability of a text's words in each language."""
        total = np.zeros(len(self.model.languages))
        for at in range(0, len(words), BLOCK):
            block = words[at : at + BLOCK]
            places = list(map(self.known.get, block))
            if None in places:
                self._make_room()
                self._learn(list(dict.fromkeys(w for w in block if w not in self.known)))
                places = list(map(self.known.get, block))
            index = np.array(places, dtype=np.int64)
            self.now += 1
            self.used[index] = self.now
            total += np.add.reduce(self.rows.take(index, axis=0))
        return total

    def learn(self, texts: list[list[str]]) -> None:
        """Meet the words of many texts at once, which is quicker than text by text."""
        self._make_room()
        fresh: dict[str, None] = {}
        for words in texts:
            fresh.update(dict.fromkeys(itertools.filterfalse(self.known.__contains__, words)))
            if len(fresh) > BLOCK:
                self._learn(list(fresh))
                fresh = {}
        if fresh:
            self._learn(list(fresh))

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return UNKNOWN, 0.0
        total = self.sums(words)
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


_SCORERS: dict[bytes, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """This worker's scorer of a model; words it has met stay known from task to task."""
    key = model.probabilities.tobytes()
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model)
    return _SCORERS[key]


OWN = ["held_out", "lang_pred", "score"]
#: Texts whose new words are scored together, and their bytes, about.
GROUP, GROUP_BYTES = 100, 1 << 20


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus lang_pred (a learned language) and score (its posterior, 0 to 1).

    Only the text is looked at. A text that is null or has no letter is ``und`` with score
    0; so is every text when nothing could be learned. Of languages that tie the first by
    name is taken. Rows that repeat are scored each; own columns with the added names are
    replaced.
    """
    docs = own_names(docs, OWN)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = scorer(model)
        hold(__name__, own, own.forget)
        found = []
        # A group of texts at a time is taken out of the batch, so that it is not held twice.
        group = max(1, min(GROUP, batch.num_rows * GROUP_BYTES // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, group):
            texts = [LETTERS.findall(t) for t in strings(batch.column("text").slice(at, group))]
            own.learn(texts)
            found += [own.predict(t) for t in texts]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
            [*batch.schema.names, "lang_pred", "score"],
        )

    schema = docs.limit(0).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return map_batches(docs, run, schema)


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, by a model learned from the same table."""
    model = fit(docs)
    rows = predict(docs.select("doc_id", "text", held_out().alias("__out")), model)
    return rows.select("doc_id", F.col("__out").alias("held_out"), "lang_pred", "score")
