"""Exact dedup against SQL, and with identifiers that clash."""

import random

import duckdb
from pyspark.sql import functions as F

from waymark.llm import exact_dedup


def test_same_rows_as_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = exact_dedup.digest_rows(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(exact_dedup.SQL).fetchall())


def test_chunks_join_to_the_text_and_resynchronise(spark):
    r = random.Random(1)
    body = " ".join(f"Sentence number {k} {'of this text ' * r.randint(0, 8)}ends." for k in range(600))
    rows = [("",), (body,), ("One more before. " + body,), ("x" * 9000,), ("🙂é\n" * 3000,)]
    got = spark.createDataFrame(rows, "text string").select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in got)
    assert len(set(got[1].c) & set(got[2].c)) >= len(got[1].c) // 2


def test_clashing_identifiers_are_given_up(spark):
    docs = spark.createDataFrame([(k, f"text {k % 5}") for k in range(20)], "doc_id long, text string")
    clashing = lambda c: F.xxhash64(c) % 2
    digests = (clashing, lambda c: F.length(c), lambda c: c)
    assert exact_dedup.verified_digest(docs, digests) is digests[2]
    kept = exact_dedup.exact_dedup(docs, digests).filter("kept").select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [15, 16, 17, 18, 19]


def test_nulls_repeats_clashes_and_no_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a", 5), (4, "a", 6), (4, "a", 6), (None, "a", 7), (2, None, 8), (3, "", 9), (None, "z", 1)],
        "doc_id long, text string, kept int",
    )
    out = exact_dedup.exact_dedup(docs)
    assert out.columns == ["doc_id", "text", "keep_id", "group_size", "kept"]
    rows = sorted(((r.doc_id, r.text, r.keep_id, r.group_size, r.kept) for r in out.collect()), key=str)
    assert rows == sorted(
        [
            (1, "a", 4, 4, False),
            (4, "a", 4, 4, True),
            (4, "a", 4, 4, True),
            (None, "a", 4, 4, False),
            (2, None, 3, 2, False),
            (3, "", 3, 2, True),
            (None, "z", None, 1, True),
        ],
        key=str,
    )
    assert exact_dedup.exact_dedup(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = exact_dedup.digest_rows(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
