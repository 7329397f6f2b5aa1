"""Page visits kept up by deliveries: late rows, repeats, missing keys, a stopped load, what is read."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from waymark.operators import keep_first
from waymark.plans import increments, web
from waymark.sources.cells import CELL, CellTable
from waymark.sources.sinks import stage as write_stage

SCHEMA = "domain string, visitor_id string, session_id string, visit_start_time timestamp, page_visit_id string, url string"


def at(day, hour):
    return dt.datetime(2024, 1, day, hour)


def page(day, hour, visit, visitor="v", session="s", url="u"):
    return ("d", visitor, session, at(day, hour), visit, url)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def load(spark, path, *rows, schema=SCHEMA, **kw):
    return increments.load_pages(spark.createDataFrame(rows, schema), path, buckets=2, **kw)


def places(spark, path):
    found = increments.loaded_pages(spark, path, "day")
    return {r.page_visit_id: (r.rank_from_start, r.rank_from_end, r.flg_new_vs_returned) for r in found.collect()}


def test_a_late_row_reopens_its_session_alone(spark, path):
    first = load(spark, path, page(1, 9, "a"), page(1, 10, "b"), page(1, 9, "x", "w", "t"))
    load(spark, path, page(2, 9, "c", "v", "s2"))
    latest = CellTable(spark, path).latest()
    late = load(spark, path, page(1, 8, "early"))
    assert len(late) == 1 and late[0] in first
    after = CellTable(spark, path).latest()
    assert {c for c in after if after[c] != latest[c]} == set(late)
    assert places(spark, path) == {
        "early": (1, 3, "New"),
        "a": (2, 2, "New"),
        "b": (3, 1, "New"),
        "x": (1, 1, "New"),
        "c": (1, 1, "Returned"),
    }


def test_a_session_over_midnight_is_one(spark, path):
    load(spark, path, page(1, 23, "a"))
    load(spark, path, page(2, 0, "b"))
    found = {r.page_visit_id: r for r in increments.loaded_pages(spark, path).collect()}
    assert found["a"].visit_end_time == at(2, 0) and found["a"].visit_length == 3600
    assert (found["a"].is_entrance, found["a"].is_exit) == ("True", "False")
    assert (found["b"].is_entrance, found["b"].is_exit) == ("False", "True")


def test_a_late_first_visit_changes_the_flag_without_rewriting(spark, path):
    load(spark, path, page(3, 9, "a"))
    assert places(spark, path)["a"][2] == "New"
    cells = load(spark, path, page(1, 9, "b", "v", "other"))
    assert all(c.startswith("2024-01-01") for c in cells)
    assert places(spark, path) == {"a": (1, 1, "Returned"), "b": (1, 1, "New")}


def test_repeated_deliveries_and_rows_count_once_and_the_stored_row_stays(spark, path):
    rows = [page(1, 9, "a"), page(1, 9, "a"), page(1, 10, "b")]
    load(spark, path, *rows)
    load(spark, path, *rows, page(1, 9, "a", url="other"))
    assert places(spark, path) == {"a": (1, 2, "New"), "b": (2, 1, "New")}
    assert {r.url for r in increments.loaded_pages(spark, path).collect()} == {"u"}


def test_missing_keys_and_times(spark, path):
    load(spark, path, page(1, 9, "a", None, None), page(1, 10, "b", None, None))
    load(spark, path, page(2, 9, "c", None, None), ("d", "v", None, None, "n", None))
    assert places(spark, path) == {
        "a": (1, 3, "None"),
        "b": (2, 2, "None"),
        "c": (3, 1, "None"),
        "n": (1, 1, "None"),
    }


def test_an_empty_delivery_changes_nothing(spark, path):
    assert load(spark, path) == []
    load(spark, path, page(1, 9, "a"))
    before = CellTable(spark, path).latest()
    assert load(spark, path) == []
    assert CellTable(spark, path).latest() == before


def test_nothing_loaded_is_said(spark, path):
    with pytest.raises(ValueError):
        increments.loaded_pages(spark, path)


def test_a_new_column_is_null_in_earlier_loads(spark, path):
    load(spark, path, page(1, 9, "a"))
    load(spark, path, (*page(1, 10, "b"), "en"), (*page(5, 10, "c", "z"), "de"), schema=SCHEMA + ", language string")
    # A later load without it keeps it.
    load(spark, path, page(1, 11, "d"))
    found = {r.page_visit_id: r.language for r in increments.loaded_pages(spark, path).collect()}
    assert found == {"a": None, "b": "en", "c": "de", "d": None}


def test_a_stopped_load_shows_nowhere_and_runs_again(spark, path):
    load(spark, path, page(1, 9, "a"))
    before = places(spark, path)

    def stopped(df, name):
        if name == "events":
            raise RuntimeError("stopped")
        return df

    with pytest.raises(RuntimeError):
        load(spark, path, page(1, 10, "b"), stage=stopped)
    assert places(spark, path) == before

    # Stopped between the rows and the list that ends a load.
    number = max(CellTable(spark, path).latest().values()) + 1
    side = spark.createDataFrame([("d", "q", "q", "2024-01-01.0000")], f"domain string, visitor_id string, session_id string, {CELL} string")
    side.write.parquet(f"{path}/sessions/__load={number}")
    spark.createDataFrame([(*page(1, 9, "ghost"), 1, 1, None, None, "2024-01-01.0000")], SCHEMA
        + f", rank_from_start long, rank_from_end long, visit_end_time timestamp, visit_length long, {CELL} string"
    ).write.partitionBy(CELL).parquet(f"{path}/rows/__load={number}")
    assert places(spark, path) == before
    load(spark, path, page(1, 10, "b"))
    assert places(spark, path) == {"a": (1, 2, "New"), "b": (2, 1, "New")}


def test_only_touched_cells_are_read(spark, path):
    for day in (1, 2):
        load(spark, path, *[page(day, 9, f"{day}-{i}", f"v{i}", f"{day}-{i}") for i in range(8)])
    table = CellTable(spark, path)
    latest = table.latest()
    one = sorted(latest)[0]
    part = table.rows(latest, [one]).withColumn("file", F.input_file_name())
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert len(latest) > 2 and all(f"{CELL}={one}/" in r.file for r in part.collect())
    assert "PartitionFilters" in plan and one in plan[plan.index("PartitionFilters") :]


def test_same_as_one_build(spark, path):
    rows = [page(1 + i % 9, (i * 7) % 24, f"{i:03}", f"v{i % 5}", f"s{i % 11}") for i in range(200)]
    for n in range(7):
        load(spark, path, *[r for i, r in enumerate(rows) if (i * 31) % 7 == n])
    whole = web.sequence_pages(spark.createDataFrame(rows, SCHEMA), increments.SESSION_KEYS)
    columns = whole.columns
    found = increments.loaded_pages(spark, path).select(*columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_cells_too_large_for_a_task_are_cut_with_the_same_rows(spark, path):
    staged = []

    def noted(df, name):
        staged.append(name)
        return write_stage(df, name)

    rows = [page(1 + i % 3, (i * 7) % 24, f"{i:03}", f"v{i % 5}", None if i % 4 == 0 else f"s{i % 7}") for i in range(120)]
    for n in range(3):
        # Late and repeated rows; cells of more than nine rows go the other way.
        load(spark, path, *[r for i, r in enumerate(rows) if i % 3 in (n, n - 1)], hot_rows=9, stage=noted)
    whole = web.sequence_pages(spark.createDataFrame(rows, SCHEMA), increments.SESSION_KEYS)
    found = increments.loaded_pages(spark, path).select(*whole.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert "large_cells" in staged


def test_rows_that_lie_together_are_shuffled_once(spark):
    rows = [("c", *page(1, 9, "a")), ("c", *page(1, 9, "a")), ("c", *page(1, 10, "b"))]
    together = spark.createDataFrame(rows, f"cell string, {SCHEMA}").repartition("cell")
    keys = ["cell", *increments.SESSION_KEYS]
    once = keep_first(together, [*keys, "page_visit_id"], ["visit_start_time"])
    found = web.sequence_pages(once, keys, hot_rows=None)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((r.page_visit_id, r.rank_from_start, r.rank_from_end, r.visit_length) for r in found.collect()) == [
        ("a", 1, 2, 3600),
        ("b", 2, 1, None),
    ]
