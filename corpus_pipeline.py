"""From raw documents to token ids: language, exact copies, near copies, mix, tokens.

Every stage is written to the shared folder before the next one reads it, so a lost
executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import bpe, exact_dedup, language, mixing, near_dedup
from waymark.llm.frames import documents, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carried(docs: DataFrame, *inputs: str) -> DataFrame:
    """An operator's inputs beside the whole row, so that columns called like the operator's own survive."""
    return docs.select(*inputs, F.struct("*").alias("__row"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which a language is predicted, however short; those without letters, null texts included, go.

    Rows that repeat and null ids are judged each by their text; all columns stay.
    """
    predicted = language.predict(_carried(docs, "text"), language.fit(docs))
    return predicted.filter(F.col("lang_pred") != language.UNKNOWN).select("__row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id.

    Null texts are equal to empty ones. Rows that repeat id and text stay or go together;
    of a group without any id all rows stay. All columns stay.
    """
    return exact_dedup.exact_dedup(_carried(docs, "doc_id"), text="__row.text").filter("kept").select("__row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more.

    Texts without words and rows without an id stay, and so does an id with one row that
    stays. All columns stay.
    """
    return near_dedup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's weight asks for, from none to three.

    A null source is a source, the last; a text without words has size 0 and is judged by
    its source's rate. Copies are whole rows with all columns.
    """
    copies = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    rows = mixing.mix(_carried(docs, "doc_id", "source"), text=F.col("__row.text"))
    return rows.withColumn("__copy", copies).select("__row.*")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every copy; ``exact`` says that the ids decode to the text.

    A null text counts as empty; null ids, languages and sources stay null; other columns
    are not carried.
    """
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), checked="exact")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "exact")


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", tokenized),
]

#: Byte-pair merging and the language model cannot be said in SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
