"""The operators on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import (
    bpe,
    chat,
    counts,
    embedding_dedup,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    periodic,
    secrets,
    spelling,
    token_files,
    url_filter,
)
from waymark.llm.frames import documents, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(documents(spark, folder))


@query
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.digest_rows(documents(spark, folder))


ORACLE_SQL["op2_exact_dedup"] = exact_dedup.SQL


@query
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.digest_rows(documents(spark, folder))


@query
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(documents(spark, folder))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest_rows(documents(spark, folder))


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder), words=2)


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.digests(stage(token_files.segments(documents(spark, folder)), "token_files"))


@query
def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query
def op11_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest_rows(turns.unionByName(chat.awkward_turns(spark)))


ORACLE_SQL["op11_chat"] = chat.checking_sql()


@query
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(documents(spark, folder), planted=True))


@query
def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digest_rows(documents(spark, folder), planted=True)
