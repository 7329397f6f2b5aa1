"""MinHash near-dedup: one-permutation hashing with optimal densification, bands, star edges.

A document's word shingles are hashed once. The hash picks a bin and the least hash of
each bin is kept; an empty bin takes the value of the first filled bin along its own
random probe sequence. Bands of bins give bucket keys. Equal sets are one class and enter
once. In a bucket only the pairs of one centre with the others are candidates, so a bucket
of any size gives fewer pairs than it has members. Candidates are confirmed on the full
sets. Buckets whose members are not yet one component are taken up again with other
centres, until a round finds few new links or after a few. What is left of them is then joined
exactly: of two similar sets the rarest shingles, as many as may be missing, have one in common.

Bands of 4 of 96 bins find a pair of similarity 0.8 with probability 1 - 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.components import components, joined, parts
from waymark.llm.frames import map_batches, stage

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
#: Words in a shingle; links need 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 80
#: Centres each unfinished bucket gets in a later round; pairs confirmed in one task, about.
CENTRES, PAIRS_EACH = 2, 10_000
#: Later rounds at most, and pairs a link may cost; what they leave is joined exactly, so more of them change no result.
ROUNDS, PAIRS_A_LINK = 4, 1000
#: Counters, as a power of two, that say how common a shingle is.
COUNTER_BITS = 18
#: Bytes of text hashed at a time.
GROUP = 1 << 20
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTERS = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, _BASE, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, arithmetic wraps around."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.full(2 * n, _BASE, dtype=np.uint64))
    return _POWERS


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of UTF-8 bytes; words are parted by ASCII white space."""
    letters = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SPACES[letters], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    # Sum of letter values times powers of the place in the word.
    at = np.flatnonzero(inside[1:-1])
    lengths = ends - starts
    places = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = _LETTERS[letters[at]] * _powers(int(lengths.max()))[places]
    return starts, mix(np.add.reduceat(values, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def _hash_in_blocks(data: bytes) -> np.ndarray:
    """Word hashes of a long text, block by block, cut at white space."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + GROUP)
        while end < len(data) and not _SPACES[data[end]]:
            end += 1
        found.append(word_hashes(data[at:end])[1])
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _shingled(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    if not len(words):
        return words
    width = min(size, len(words))
    out = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for k in range(width):
        out = mix(out * _BASE + words[k : len(words) - width + 1 + k] + np.uint64(1))
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def shingle_sets(texts: Sequence[str | None], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; short texts are hashed together."""
    with np.errstate(over="ignore"):
        group: list[bytes] = []
        held = 0
        for text in texts:
            data = (text or "").encode().lower()  # bytes: A-Z only
            if len(data) > GROUP:
                yield from _group_sets(group, size)
                group, held = [], 0
                yield _shingled(_hash_in_blocks(data), size)
                continue
            group.append(data)
            held += len(data)
            if held > GROUP:
                yield from _group_sets(group, size)
                group, held = [], 0
        yield from _group_sets(group, size)


def _group_sets(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not group:
        return
    starts, hashes = word_hashes(b"\n".join(group))
    begins = np.cumsum([0, *(len(d) + 1 for d in group)])
    cut = np.searchsorted(starts, begins)
    for k in range(len(group)):
        yield _shingled(hashes[cut[k] : cut[k + 1]], size)


def sketches(sets: Sequence[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One row of ``bins`` values for each set; all sets have members."""
    out = np.zeros((len(sets), bins), dtype=np.uint64)
    filled = np.zeros((len(sets), bins), dtype=bool)
    for k, members in enumerate(sets):
        place = ((members >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        out[k, place[first]] = members[first]
        filled[k, place[first]] = True
    rows, empty = np.nonzero(~filled)
    attempt = 0
    while len(rows):
        attempt += 1
        probe = (mix(empty.astype(np.uint64) + np.uint64(attempt * bins)) % np.uint64(bins)).astype(np.int64)
        hit = filled[rows, probe]
        out[rows[hit], empty[hit]] = out[rows[hit], probe[hit]]
        rows, empty = rows[~hit], empty[~hit]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit bucket key for each band, different from band to band."""
    n, bins = sketch.shape
    keys = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=np.uint64), (n, bins // rows)).copy()
    for k in range(rows):
        keys = mix(keys * _BASE + sketch[:, k::rows])
    return keys


def _longs(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def sketch_table(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the set and its band keys; none for an empty set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(batch.column("text").to_pylist(), words))
        with np.errstate(over="ignore"):
            full = [k for k, s in enumerate(sets) if len(s)]
            bands: list[list[int] | None] = [None] * len(sets)
            if full:
                for k, keys in zip(full, _longs(band_keys(sketches([sets[k] for k in full]))), strict=True):
                    bands[k] = keys.tolist()
            d1 = [int(_longs(mix(s + _BASE).sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0 for s in sets]
            d2 = [int(_longs(mix(s ^ _BASE).sum(dtype=np.uint64, keepdims=True))[0]) if len(s) else 0 for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(d1, pa.int64()),
                pa.array(d2, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "d1", "d2", "bands"],
        )

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def _set_table(docs: DataFrame, words: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), words)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["id", "members"])

    return map_batches(docs.select("doc_id", "text"), run, "id long, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (centre, rep) whose full sets are similar enough, as links (a, b)."""
    of_rep = pairs.join(sets.withColumnRenamed("members", "m1"), F.col("rep") == F.col("id")).drop("id")
    both = of_rep.join(sets.withColumnRenamed("members", "m2"), F.col("centre") == F.col("id")).drop("id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for one, two in zip(batch.column("m1"), batch.column("m2"), strict=True):
            x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            shared = int((large[at] == small).sum())
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        mask = pa.array(keep, pa.bool_())
        return pa.RecordBatch.from_arrays(
            [batch.column("centre").filter(mask), batch.column("rep").filter(mask)], ["a", "b"]
        )

    return map_batches(both, run, "a long, b long")


def _sizes_allow(n1: str, n2: str, percent: int):
    """Sets of too different sizes cannot be similar enough."""
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _slots(members: np.ndarray, bits: int) -> np.ndarray:
    return (members >> np.uint64(64 - bits)).astype(np.int64)


def _commonness(sets: DataFrame, bits: int) -> np.ndarray:
    """How many sets hold a shingle of each counter; a table of one size, whatever the input."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = _slots(np.frombuffer(b"".join(batch.column("members").to_pylist()), np.uint64), bits)
        found, n = np.unique(slots, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["slot", "n"])

    summed = map_batches(sets.select("members"), run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << bits, np.int64)
    counts[summed["slot"].to_numpy()] = summed["n"].to_numpy()
    return counts


def _prefixes(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """rep, comp, size and the rarest shingles of (id, comp, members), as many as a similar set may lack and one more."""
    bits = len(counts).bit_length() - 1

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, rarest = [], []
        for one in batch.column("members"):
            members = np.frombuffer(one.as_py(), np.uint64)
            order = np.lexsort((members, counts[_slots(members, bits)]))
            sizes.append(len(members))
            rarest.append(_longs(members[order[: len(members) + percent * len(members) // -100 + 1]]))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("comp"), pa.array(sizes, pa.int64()), pa.array(rarest, pa.list_(pa.int64()))],
            ["rep", "comp", "size", "rarest"],
        )

    return map_batches(sets.select("id", "comp", "members"), run, "rep long, comp long, size long, rarest array<long>")


def _rest(placed: DataFrame, sets: DataFrame, percent: int, files: int) -> DataFrame:
    """Every pair (centre, rep) that may be similar among the members of unfinished buckets, across components.

    Shingles have one order, rare ones first. Two sets that share enough have their first
    common shingle so early in both that enough follow it; pairs are those of such a shingle.
    """
    # The first round has compared both members of a bucket of two.
    spread = placed.groupBy(F.col("key").alias("k")).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("m"))
    unfinished = stage(spread.filter("low <> high AND m > 2").select("k").coalesce(files), "unfinished")
    left = placed.join(unfinished, F.col("key") == F.col("k")).select("rep", "comp").distinct()
    left = stage(sets.join(left, F.col("id") == F.col("rep")).select("id", "comp", "members").coalesce(files), "left")
    held = stage(_prefixes(left, _commonness(left, COUNTER_BITS), percent), "prefixes")
    rows = held.select("rep", "comp", "size", F.posexplode("rarest").alias("at", "shingle"))
    # A shingle of one component alone links nothing.
    common = rows.groupBy(F.col("shingle").alias("s")).agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    common = stage(common.filter("low <> high").select("s").coalesce(files), "common")
    rows = stage(rows.join(common, F.col("shingle") == F.col("s")).drop("s").coalesce(files), "postings")
    # The smaller set of a pair may lack fewer.
    small = rows.filter((F.col("size") - F.col("at")) * (100 + percent) >= F.col("size") * (2 * percent))
    large = rows.select(*[F.col(c).alias(f"{c}2") for c in rows.columns])
    follow = F.least(F.col("size") - F.col("at"), F.col("size2") - F.col("at2"))
    enough = follow * (100 + percent) >= (F.col("size") + F.col("size2")) * percent
    ordered = F.expr("size < size2 OR size = size2 AND rep < rep2")
    met = small.join(large, (F.col("shingle") == F.col("shingle2")) & (F.col("comp") != F.col("comp2")) & ordered & enough)
    return met.select(F.least("rep", "rep2").alias("centre"), F.greatest("rep", "rep2").alias("rep")).distinct()


def _again(placed: DataFrame, round_: int, percent: int, files: int) -> DataFrame:
    """Pairs (centre, rep) of other centres, each its own, for buckets that are not one component yet.

    The first centre, ``star``, has met every member, so a bucket's other members alone take
    part: one of ``m`` members gives at most ``CENTRES * (m - 2)`` rows, one of two none.
    """
    others = placed.filter("rep <> star")
    member = F.struct("rep", "n", "comp")
    tried = [
        F.min(F.struct(F.xxhash64("rep", "key", F.lit(CENTRES * round_ + k)).alias("o"), member.alias("m"))).alias(f"c{k}")
        for k in range(CENTRES)
    ]
    centres = others.groupBy(F.col("key").alias("k")).agg(*tried, F.min("comp").alias("low"), F.max("comp").alias("high"))
    chosen = F.explode(F.array_distinct(F.array(*[F.col(f"c{k}.m") for k in range(CENTRES)]))).alias("c")
    centres = centres.filter("low <> high").select("k", chosen)
    centres = stage(
        centres.select("k", F.col("c.rep").alias("centre"), F.col("c.n").alias("cn"), F.col("c.comp").alias("cc")).coalesce(files),
        "centres",
    )
    met = others.join(centres, F.col("key") == F.col("k")).filter("comp <> cc").filter(_sizes_allow("n", "cn", percent))
    return met.select(F.least("centre", "rep").alias("centre"), F.greatest("centre", "rep").alias("rep"))


def link_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The sketch table, and (node, component) of the class representatives that are linked.

    Rows without words or doc_id are in the table and link with nothing; equal sets, and so
    repeated rows, are one class; other columns are not carried.
    """
    table = stage(sketch_table(docs, words), "sketches")
    known = table.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = known.join(classes.select("rep", F.col("d1").alias("e1"), F.col("d2").alias("e2")), F.col("doc_id") == F.col("rep"))
    reps = reps.filter("d1 = e1 AND d2 = e2").select("rep", F.col("n_shingles").alias("n"), "bands")
    rows = reps.select("rep", "n", F.explode("bands").alias("key"))
    # Star edges: the smallest representative of each bucket with the others.
    centres = stage(
        rows.groupBy(F.col("key").alias("k"))
        .agg(F.min(F.struct("rep", "n")).alias("c"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("k", F.col("c.rep").alias("centre"), F.col("c.n").alias("cn")),
        "centres",
    )
    buckets = stage(rows.join(centres, F.col("key") == F.col("k")).drop("k"), "buckets")
    files = parts(buckets.count())
    pairs = buckets.filter(_sizes_allow("n", "cn", percent)).filter("rep <> centre").select("centre", "rep").distinct()
    pairs = stage(pairs.coalesce(files), "pairs")
    wanted = buckets.select(F.col("rep").alias("w")).distinct()
    sets = stage(_set_table(docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("w"), "left_semi"), words), "sets")
    links = stage(_confirmed(pairs, sets, percent).coalesce(parts(pairs.count(), PAIRS_EACH)), "links")
    found = stage(components(links).coalesce(files), "found")

    def place(found: DataFrame) -> DataFrame:
        rows = buckets.select("key", "rep", "n", "centre").join(found, F.col("rep") == F.col("node"), "left")
        return stage(rows.select("key", "rep", "n", F.col("centre").alias("star"), F.coalesce("component", "rep").alias("comp")), "placed")

    placed = place(found)
    for round_ in range(1, ROUNDS + 1):
        again = _again(placed, round_, percent, files)
        fresh = stage(again.distinct().join(pairs, ["centre", "rep"], "left_anti").coalesce(files), "pairs")
        count = fresh.count()
        more = stage(_confirmed(fresh, sets, percent).coalesce(parts(count, PAIRS_EACH)), "links")
        pairs = pairs.unionByName(fresh)
        linked = more.count()
        if linked:
            found = stage(joined(found, more).coalesce(files), "found")
            placed = place(found)
        if linked * PAIRS_A_LINK <= count:
            break
    # Other members of unfinished buckets were no centres yet.
    rest = stage(_rest(placed, sets, percent, files).join(pairs, ["centre", "rep"], "left_anti").coalesce(files), "pairs")
    more = stage(_confirmed(rest, sets, percent).coalesce(parts(rest.count(), PAIRS_EACH)), "links")
    if more.count():
        found = stage(joined(found, more).coalesce(files), "found")
    return table, found


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of ``words`` words, or with fewer words the whole sequence. Documents with
    ``100 * intersection >= percent * union`` are linked; ``component_id`` is the smallest
    doc_id that links reach and ``kept`` says that it is the document's own. A document
    without words, null text included, is linked with nothing. A null doc_id cannot name a
    component: such a row has none and stays. Rows that repeat an id are judged each by
    its own text.
    """
    table, found = link_classes(docs, words, percent)
    classes = stage(
        table.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes"
    )
    named = classes.join(found, F.col("rep") == F.col("node"), "left")
    named = stage(named.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "rep").alias("comp")), "named")
    same = (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("n_shingles") > 0)
    rows = table.select("doc_id", "n_shingles", "d1", "d2").join(named, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without all but the smallest doc_id of every component.

    An id whose rows hold several texts stays if one of them does.
    """
    judged = near_duplicates(docs, words, percent).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("k"))
    gone = stage(judged.filter("NOT k").select(F.col("doc_id").alias("__gone")), "gone")
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
