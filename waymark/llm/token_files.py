"""Token ids in binary shards with a minimal perfect hash index from document keys to offsets.

Documents are range-partitioned and sorted by key, so shards hold consecutive keys. A
shard is a run of segments of bounded size, each one row of a Parquet table:

=============  ==================================================================
shard, segment place in ascending key order
first, last    smallest and largest key
n_docs, n_ids  documents and ids in the segment
payload        the raw ids one after another, little-endian, ``width`` bytes each
offsets        n_docs + 1 unsigned 64-bit positions in the payload, in ids
keys           the documents' keys (signed 64-bit), ascending
levels         bits of each level of the hash; ``bits`` holds the levels packed
rows, marks    for each hash slot the first row of its key and a 32-bit fingerprint
=============  ==================================================================

The hash keeps, level by level, one bit per key that falls alone into its place; keys that
collide go to the next level. A key's slot is the number of bits before its own, so slots
are dense and a lookup takes a constant number of steps.

A null key is written as the smallest 64-bit integer. Rows that repeat a key are stored
each and found together. Spark's commit protocol makes a segment appear once, also after a
lost executor.
"""

from __future__ import annotations

import array
import functools
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waymark.llm.counts import JSON_50K, byte_letters
from waymark.llm.frames import hold, map_batches, strings, workers_import
from waymark.llm.pretokens import Parts

END_ID = 0
NULL_KEY = -(2**63)
#: Ids after which a segment is closed; a single longer document gets one of its own.
SEGMENT_IDS = 1 << 20
#: Places per key in each level of the hash, and seeds of its hash functions.
SPREAD, MARK_SEED = 2, 99
SEGMENT = (
    "shard int, segment int, first long, last long, n_docs long, n_ids long, width int, payload binary, "
    "offsets binary, keys binary, levels binary, bits binary, rows binary, marks binary"
)


class LibraryEncoder:
    """Ids as the tokenizers library gives them, remembered by part of the text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = dict(enumerate(byte_letters()))
        self.blank = self.letters[ord(" ")]
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.parts = Parts(self._ids, b"".join)

    def _ids(self, match: str) -> bytes:
        # The match as the library's byte-level step writes it, for the library's model.
        if match.isascii() and match.isprintable():  # visible characters stand for themselves
            letters = match.replace(" ", self.blank)
        else:
            letters = match.encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit integers."""
        # A special string is one token, and the text on either side is read by itself.
        sections: list[str | bytes] = [text]
        for special, token in self.special.items():
            cut: list[str | bytes] = []
            for section in sections:
                parts = section.split(special) if isinstance(section, str) else [section]
                for k, part in enumerate(parts):
                    cut += [token, part] if k else [part]
            sections = cut
        ids = [v for s in sections for v in ([s] if isinstance(s, bytes) else self.parts.values(s))]
        return b"".join(ids)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit keys for each seed; arithmetic wraps around."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slot of each of a set of distinct keys; other keys may get any slot or none (-1)."""

    def __init__(self, levels: Sequence[int], bits: np.ndarray):
        self.levels = np.asarray(levels, dtype=np.int64)
        self.bits = bits
        self.before = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, maps, left = [], [], keys
        while len(left):
            size = SPREAD * len(left)
            places = (_mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(size)
            maps.append(alone)
            left = left[~alone[places]]
        return cls(levels, np.concatenate(maps) if maps else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, dtype=np.int64)
        base = 0
        for level, size in enumerate(self.levels):
            open_ = np.flatnonzero(found < 0)
            places = base + (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[places]
            found[open_[hit]] = self.before[places[hit]]
            base += int(size)
        return found


def _segment(shard: int, number: int, keys: list[int], ids: list[bytes], width: int) -> pa.RecordBatch:
    ordered = np.array(keys, dtype=np.int64)
    distinct, first_rows = np.unique(ordered, return_index=True)
    index = PerfectHash.build(distinct)
    slots = index.slots(distinct)
    rows, marks = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    rows[slots] = first_rows
    marks[slots] = _mix(distinct, MARK_SEED) >> np.uint64(32)
    offsets = (np.cumsum([0, *map(len, ids)]) // 4).astype("<u8")
    row = {
        "shard": shard,
        "segment": number,
        "first": keys[0],
        "last": keys[-1],
        "n_docs": len(keys),
        "n_ids": int(offsets[-1]),
        "width": width,
        "payload": np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes(),
        "offsets": offsets.tobytes(),
        "keys": ordered.astype("<i8").tobytes(),
        "levels": index.levels.astype("<i8").tobytes(),
        "bits": np.packbits(index.bits).tobytes(),
        "rows": rows.tobytes(),
        "marks": marks.tobytes(),
    }
    types = [pa.int32()] * 2 + [pa.int64()] * 4 + [pa.int32()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))


def segments(docs: DataFrame, path: str | None = None, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """The table of segments for ``docs`` (doc_id, text), to be written as Parquet.

    Ids are the tokenizers library's for the byte-level BPE file ``path``, without special
    tokens added, with id 0 at the end of each document. A null text counts as empty.
    Other columns are not carried.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    workers_import(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        encode = encoder(path or public_tokenizers.path(JSON_50K))
        hold(__name__, encode, encode.parts.forget)
        shard, number = TaskContext.get().partitionId(), 0
        keys: list[int] = []
        ids: list[bytes] = []
        held = 0
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
                found = encode.encode(text) + end
                if keys and held + len(found) > 4 * segment_ids:
                    yield _segment(shard, number, keys, ids, encode.width)
                    keys, ids, held, number = [], [], 0, number + 1
                keys.append(NULL_KEY if key is None else key)
                ids.append(found)
                held += len(found)
        if keys:
            yield _segment(shard, number, keys, ids, encode.width)

    return ordered.mapInArrow(run, SEGMENT)


class Reader:
    """One segment, opened."""

    def __init__(self, row: dict):
        self.payload = np.frombuffer(row["payload"], f"<u{row['width']}")
        self.offsets = np.frombuffer(row["offsets"], "<u8").astype(np.int64)
        self.keys = np.frombuffer(row["keys"], "<i8")
        levels = np.frombuffer(row["levels"], "<i8")
        self.index = PerfectHash(levels, np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(levels.sum())))
        self.index.bits = self.index.bits.astype(bool)
        self.rows = np.frombuffer(row["rows"], "<u4")
        self.marks = np.frombuffer(row["marks"], "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First row of each key, -1 where the slot's fingerprint is another's."""
        slots = self.index.slots(keys)
        same = (slots >= 0) & (self.marks[slots] == (_mix(keys, MARK_SEED) >> np.uint64(32)).astype(np.uint32))
        return np.where(same, self.rows[slots], -1)

    def ids(self, row: int) -> np.ndarray:
        return self.payload[self.offsets[row] : self.offsets[row + 1]]

    def found(self, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """(key, row) of every stored row of ``keys``."""
        for key, row in zip(keys.tolist(), self.find(keys).tolist(), strict=True):
            while 0 <= row < len(self.keys) and self.keys[row] == key:
                yield key, row
                row += 1


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[dict, Reader]]:
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
        yield row, Reader(row)


def fetch(files: DataFrame, keys: Sequence[int]) -> DataFrame:
    """doc_id and ids of the documents with the given keys (a list the caller bounds).

    Only segments whose key range holds one of them are read; unknown keys give no row.
    """
    wanted = sorted(set(keys))
    near = F.lit(False)
    for key in wanted:
        near = near | ((F.col("first") <= key) & (F.col("last") >= key))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(key, r.ids(i).tolist()) for _, r in _opened(batch) for key, i in r.found(np.array(wanted, np.int64))]
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int32()))],
            ["doc_id", "ids"],
        )

    return map_batches(files.filter(near), run, "doc_id long, ids array<int>")


def directory(files: DataFrame) -> DataFrame:
    """shard, segment and ``base``: the ids of all segments before it in key order."""
    sizes = files.select("shard", "segment", "n_ids")
    # One row per shard meets in one task; segments are added up within their shard.
    totals = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return placed.join(shards, "shard").select("shard", "segment", (F.col("shard_base") + F.col("before")).alias("base"))


def digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, found through the index.

    ``files`` is a written table of segments: it is read twice, and shards are numbered as written.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for row, reader in _opened(batch):
            written = memoryview(reader.payload.astype("<u4").tobytes())
            offsets = reader.offsets.tolist()
            for key, i in reader.found(np.unique(reader.keys)):
                start, end = offsets[i], offsets[i + 1]
                crc = zlib.crc32(written[4 * start : 4 * end])
                out.append((row["shard"], row["segment"], None if key == NULL_KEY else key, start, end - start, crc))
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["shard", "segment", "doc_id", "offset", "n_tokens", "ids_crc32"]
        columns = zip(*out, strict=True) if out else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    rows = map_batches(
        files, run, "shard int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return rows.join(directory(files), ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(path)
