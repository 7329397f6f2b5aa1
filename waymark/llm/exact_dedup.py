"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut after sentence ends, so equal passages give equal chunks wherever they stand.
Every distinct chunk is moved once, to verify that no two different chunks share an
identifier; from then on a document is its recipe, the ordered list of its chunks'
identifiers (8 bytes for about a thousand characters). Documents are equal when their
recipes are, and long texts are not moved again to compare them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.frames import own_names, stage

#: A chunk ends at the first sentence end after 1023 characters, or after 4096 characters.
CHUNK = r"(?s).{1023,4095}?[.!?\n]|.{1,4096}"

Digest = Callable[[Column], Column]
#: Identifiers to try: 64 bits, 256 bits, and the chunk itself, which cannot clash.
DIGESTS: tuple[Digest, ...] = (F.xxhash64, lambda c: F.sha2(c, 256), lambda c: c)
OWN = ["keep_id", "group_size", "kept"]


def chunks(text: Column) -> Column:
    """The chunks of a text in order; joined, they are the text. A null text has none, like an empty one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(0))


def verified_digest(docs: DataFrame, digests: Sequence[Digest] = DIGESTS, text: str = "text") -> Digest:
    """The first digest that tells all distinct chunks of ``docs`` apart.

    Equal chunks are combined before the shuffle, so a passage that many documents share
    is moved once for each task.
    """
    for digest in digests[:-1]:
        distinct = docs.select(F.explode(chunks(F.col(text))).alias("c")).select("c", digest(F.col("c")).alias("id"))
        shared = distinct.distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
        if shared.count() == 0:
            return digest
    return digests[-1]


def exact_dedup(docs: DataFrame, digests: Sequence[Digest] = DIGESTS, text: str = "text") -> DataFrame:
    """``docs`` plus keep_id, group_size and kept: of equal texts the largest doc_id stays.

    Texts are equal when their characters are; null counts as empty. A null doc_id comes
    below all others; if a group has no other, all its rows stay. Rows that repeat the id
    as well as the text are one document: each counts in ``group_size`` and they stay or
    go together. Own columns with the added names are replaced. ``text`` may name a field
    of a structure.
    """
    docs = own_names(docs, OWN)
    digest = verified_digest(docs, digests, text)
    rows = docs.withColumn("__recipe", F.transform(chunks(F.col(text)), lambda c: digest(c)))
    # One row per group of copies: counts are combined before the shuffle, single texts left out.
    # As a written table, its size is known, and adaptive execution may split a large group in the join.
    groups = stage(
        rows.groupBy(F.col("__recipe").alias("__same"))
        .agg(F.max("doc_id").alias("__largest"), F.count("*").alias("__n"))
        .filter("__n > 1"),
        "groups",
    )
    joined = rows.join(groups, F.col("__recipe") == F.col("__same"), "left")
    keep = F.when(F.col("__n").isNull(), F.col("doc_id")).otherwise(F.col("__largest"))
    return joined.select(
        *docs.columns,
        keep.alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
    )


def digest_rows(docs: DataFrame, digests: Sequence[Digest] = DIGESTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document, dropped ones too.

    Nulls and repeated rows are taken as in :func:`exact_dedup`; other columns are not carried.
    """
    hashed = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return exact_dedup(hashed, digests).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
