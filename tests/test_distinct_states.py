"""Bitmaps of distinct entities against plain distinct counts."""

from pyspark.sql import functions as F

from waymark.operators import distinct_roll_up, distinct_states

TESTS = {"all_of_them": "true", "even": "n % 2 = 0", "never": "n < 0"}


def _conditions():
    return {name: F.expr(text) for name, text in TESTS.items()}


def _plain(df, keys):
    return df.groupBy(*keys).agg(
        *[F.countDistinct(F.when(c, F.col("person"))).alias(name) for name, c in _conditions().items()]
    )


def _same(found, wanted):
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_more_people_than_a_block_in_overlapping_groups(spark):
    df = spark.range(150_000).selectExpr("id % 70001 AS person", "id AS n", "id % 3 AS a", "CASE WHEN id % 5 > 0 THEN id % 5 END AS b")
    states = distinct_states(df, ["a", "b"], "person", _conditions()).persist()
    for keys in (["a", "b"], ["b"], ["a"], []):
        _same(distinct_roll_up(states, keys, list(TESTS)), _plain(df, keys))
    assert states.count() < 150
    states.unpersist()


def test_missing_people_groups_and_rows(spark):
    rows = [(None, 1, 1, "x"), (None, 2, 2, "y"), ("p", 2, None, "x"), ("p", 2, None, "x"), ("q", None, 3, None), ("", 4, 3, None)]
    df = spark.createDataFrame(rows, "person string, n int, a int, b string")
    for part in (df, df.filter("person is null"), df.filter("false")):
        states = distinct_states(part, ["a", "b"], "person", _conditions())
        for keys in (["a", "b"], ["b"], []):
            _same(distinct_roll_up(states, keys, list(TESTS)), _plain(part, keys))
