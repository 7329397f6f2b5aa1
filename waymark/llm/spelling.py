"""Spelling variants: words one edit apart, found through an index of variable-length grams.

The gram dictionary holds the frequent beginnings of grams: a gram that occurs at more than
``threshold`` places of the vocabulary is too common to tell words apart, so it grows by
another letter. A word is decomposed into one gram for each place, the shortest one that is
no frequent beginning, up to the longest allowed. Whether a gram ends is seen from its own
letters alone, so an edit changes only the grams it touches, and the most grams that any
one edit can touch (:func:`affected`) is known for each word.

Two words one edit apart therefore share all but so many grams, at the same place before the
edit and at the same distance from the end after it. With grams ordered from rare to common
both hold a shared one among their first ``affected + 1``; only those lists are merged.
Words of m letters meet in frame m, where grams have at most m / 2 letters, with each other
and with words of m + 1 letters. Every pair that meets is verified.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.frames import map_batches, stage

#: Words to group: letters and occurrences at least; a form occurs so many times as often.
LETTERS, OCCURRENCES, TIMES = 6, 5, 5
WORD = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One in so many occurrences loses a letter where typos are planted.
TYPOS = 199
#: Letters of a gram; a gram with more places than FREQUENT grows. The dictionary has at
#: most DICTIONARY frequent beginnings of each length, whatever the vocabulary.
SHORTEST, LONGEST, FREQUENT, DICTIONARY = 2, 8, 50, 20_000


def _planted(run: Column, doc_id: Column) -> Column:
    """``run`` without one letter, in those occurrences that a hash of document and run picks."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    typo = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % TYPOS == 0, typo).otherwise(run)


def word_counts(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, planted: bool = False) -> DataFrame:
    """word and n of every word with enough letters and occurrences in all texts.

    Words are maximal runs of Latin letters (up to U+00FF) with only A-Z lower-cased. A
    null text has none; rows that repeat count each; other columns are not looked at.
    ``planted`` first takes a letter out of some occurrences (none without a doc_id).
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("run"))
    long_runs = runs.filter(F.length("run") >= letters)  # a typo only shortens
    word = F.translate("run", UPPER, LOWER)
    words = long_runs.select((_planted(word, F.col("doc_id")) if planted else word).alias("word"))
    counted = words.filter(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= occurrences)


@dataclasses.dataclass(frozen=True)
class Dictionary:
    """Frequent beginnings of grams, with the places that have them."""

    places: Mapping[str, int]
    longest: int = LONGEST

    def decompose(self, word: str, longest: int) -> list[tuple[str, bool]]:
        """The gram at each place, and whether it would grow if the word went on."""
        n, frequent, out = len(word), self.places, []
        for p in range(n - SHORTEST + 1):
            most = min(n, p + longest)
            end = p + SHORTEST
            while end < most and word[p:end] in frequent:
                end += 1
            gram = word[p:end]
            out.append((gram, end == n and len(gram) < longest and gram in frequent))
        return out

    def lists(self, word: str, frame: int) -> list[tuple[int, str]]:
        """(place, gram) of the lists to merge for ``word`` in a frame: the rarest, one more than an edit affects."""
        grams = self.decompose(word, longest_in(frame, self.longest))
        rare_first = sorted((self.places.get(g, 0), g, p) for p, (g, _) in enumerate(grams))
        return [(p, g) for _, g, p in rare_first[: affected(grams, len(word)) + 1]]


def longest_in(frame: int, longest: int = LONGEST) -> int:
    """Letters of a gram in a frame: few enough that one edit never touches all grams of a word."""
    return max(SHORTEST, min(longest, frame // 2))


def affected(grams: list[tuple[str, bool]], letters: int) -> int:
    """The most of a word's ``grams`` that one deleted, replaced or inserted letter changes.

    A deleted or replaced letter changes the grams that hold it. An inserted one changes
    those it comes to stand in, and at the word's end those that would have grown.
    """
    held, grown = [0] * letters, 0
    for p, (gram, open_) in enumerate(grams):
        grown += open_
        for i in range(p, p + len(gram)):
            held[i] += 1
    return max(grown, *held)  # a gram around an inserted letter also holds the letter before it


def dictionary(words: DataFrame, frequent: int = FREQUENT, most: int = DICTIONARY, longest: int = LONGEST) -> Dictionary:
    """The dictionary of a vocabulary. What comes to the driver has at most ``most`` entries of each length."""
    letters = F.length("word")
    total = words.agg(F.coalesce(F.sum(letters - (SHORTEST - 1)), F.lit(0)).alias("n")).first()["n"]
    threshold = max(frequent, total // most)

    def cuts(size: int) -> Column:
        places = F.sequence(F.lit(1), letters - (size - 1))
        found = F.transform(places, lambda p: F.substr(F.col("word"), p, F.lit(size)))
        return F.when(letters >= size, found).otherwise(F.array().cast("array<string>"))

    each = [cuts(size) for size in range(SHORTEST, longest)]
    grams = words.select(F.explode(F.flatten(F.array(*each))).alias("gram"))
    held = grams.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > threshold).toArrow()
    return Dictionary(dict(zip(held["gram"].to_pylist(), held["n"].to_pylist(), strict=True)), longest)


def _keys(word: str, grams: Dictionary, letters: int) -> tuple[list[str], list[str]]:
    """Lists of a word among words of its own length, and as one that is a letter longer."""
    n = len(word)
    own = [f"{n}:{p}:{g}" for p, g in grams.lists(word, n)]
    longer = [f"{n - 1}:{at}:{g}" for p, g in grams.lists(word, n - 1) for at in (p, p - 1)] if n > letters else []
    return own, longer


def _mask(word: str) -> int:
    """A bit for each letter that occurs; an edit changes at most two."""
    mask = 0
    for letter in set(word):
        mask |= 1 << ord(letter) % 63
    return mask


def postings(words: DataFrame, grams: Dictionary, letters: int) -> DataFrame:
    """word, n, mask, and the keys of its lists as ``own`` and ``longer``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("word").to_pylist()
        both = [_keys(w, grams, letters) for w in texts]
        kind = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("word"),
                batch.column("n"),
                pa.array([_mask(w) for w in texts], pa.int64()),
                pa.array([k[0] for k in both], kind),
                pa.array([k[1] for k in both], kind),
            ],
            ["word", "n", "mask", "own", "longer"],
        )

    return map_batches(words.select("word", "n"), run, "word string, n long, mask long, own array<string>, longer array<string>")


def near_words(words: DataFrame, letters: int = LETTERS, grams: Dictionary | None = None) -> DataFrame:
    """word, n, other, other_n: every pair of ``words`` (word, n) exactly one edit apart, in both directions.

    Words are distinct, not null and have at least ``letters`` letters (4 or more).
    """
    if letters < 2 * SHORTEST:
        raise ValueError(f"words need at least {2 * SHORTEST} letters")
    words = words.select("word", F.col("n").cast("long").alias("n"))
    held = stage(postings(words, grams or dictionary(words), letters), "grams")

    def lists(of: str, longer: bool, names: list[str]) -> DataFrame:
        rows = held.select(F.explode(of).alias("key"), "word", "n", "mask").withColumn("key", F.xxhash64("key"))
        return rows.toDF(*names).withColumn(f"{names[0]}_longer", F.lit(longer))

    left = lists("own", False, ["k", "word", "n", "mask"]).drop("k_longer")
    names = ["k2", "other", "other_n", "mask2"]
    right = lists("own", False, names).unionByName(lists("longer", True, names))
    meet = (F.col("k") == F.col("k2")) & (F.col("k2_longer") | (F.col("word") < F.col("other")))
    alike = F.bit_count(F.col("mask").bitwiseXOR(F.col("mask2"))) <= 2
    near = F.levenshtein("word", "other", 1) == 1
    pairs = left.join(right, meet & alike & near).select("word", "n", "other", "other_n").distinct()
    pairs = stage(pairs, "near")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form): the end of each chain of forms, by doubling the steps taken.

    A form occurs more often than its word, so chains have no circles; each round is written.
    """
    reached = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("w"), F.col("root").alias("further"))
        step = reached.join(onward, F.col("root") == F.col("w"), "left")
        step = stage(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def variants(words: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every one of ``words`` (word, n).

    ``n_near`` counts the words one edit apart. ``form`` is the most frequent of them
    (ties: the first in code-point order) if it occurs at least ``times`` as often as the
    word, else null, and ``form_n`` its occurrences. ``root`` is where the forms lead in
    the end, the word itself if it has none. No words give no rows.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    judged = near_words(words, letters).groupBy("word").agg(F.max("n").alias("own"), F.count("*").alias("n_near"), best.alias("b"))
    enough = -F.col("b.less") >= times * F.col("own")
    judged = judged.select(
        F.col("word").alias("w"), "n_near", F.when(enough, F.col("b.form")).alias("form"), F.when(enough, -F.col("b.less")).alias("form_n")
    )
    judged = stage(judged, "judged")
    ends = roots(judged.filter("form IS NOT NULL").select(F.col("w").alias("word"), "form"))
    ends = ends.select(F.col("word").alias("e"), "root")
    return (
        words.join(judged, F.col("word") == F.col("w"), "left")
        .join(ends, F.col("word") == F.col("e"), "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    )
