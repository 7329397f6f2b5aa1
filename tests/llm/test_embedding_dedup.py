"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import embedding_dedup


def plain(rows, cosine=0.9):
    ids = [k for k, _ in rows]
    units = np.array([np.array(v) / np.linalg.norm(v) for _, v in rows])
    near = units @ units.T >= cosine
    least = np.array(ids)
    while True:
        new = np.array([least[row].min() for row in near])
        if (new == least).all():
            break
        least = new
    return {k: (int(near[i].sum()) - 1, int(least[i])) for i, k in enumerate(ids)}


def made(seed, groups, singles, size=16, noise=0.05):
    r = np.random.default_rng(seed)
    rows = [r.normal(size=size) for _ in range(singles)]
    for n in groups:
        centre = r.normal(size=size)
        rows += [centre + noise * np.linalg.norm(centre) * r.normal(size=size) for _ in range(n)]
    order = r.permutation(len(rows))
    return [(int(k), [float(np.float32(x)) for x in rows[i]]) for k, i in enumerate(order)]


def judged(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = embedding_dedup.near_duplicates(df).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return {r.vec_id: (r.n_links, r.component_id) for r in out}


def agreement(got, want):
    found = sum(min(got[k][0], want[k][0]) for k in want)
    assert all(got[k][0] <= want[k][0] for k in want)  # none below the threshold
    return found / max(1, sum(n for n, _ in want.values()))


def test_groups_among_random_vectors(spark):
    rows = made(1, [2, 3, 40, 7, 2, 2], 400)
    assert agreement(judged(spark, rows), plain(rows)) >= 0.97


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 150)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 60)
    rows = made(2, [2, 2, 5, 150], 500, noise=0.03)
    got, want = judged(spark, rows), plain(rows)
    assert agreement(got, want) >= 0.95
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.98 * len(want)


def test_equal_vectors_are_one_node(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(300)] + [(900, [1.0, 2.0, 3.1]), (901, [-1.0, 0.0, 0.5])]
    got = judged(spark, rows)
    assert got == plain(rows) and got[0] == (300, 0)


def test_unusable_vectors_repeats_and_no_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0])]
    rows += [(7, [2.0, 0.0]), (7, [2.0, 0.0]), (None, [1.0, 0.0]), (8, [1.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0]), (11, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, m string")
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    want = [(k, 0, k, True) for k in (2, 3, 4, 5, 6, 8, 11)] + [(1, 2, 1, True), (None, 0, None, True)]
    want += [(7, 2, 1, False)] * 2 + [(9, 1, 9, True), (10, 1, 9, False)]
    assert got == sorted(want, key=str)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_audit_measures_recall(spark):
    rows = made(3, [20, 5], 100)
    index = embedding_dedup.build(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert index.recall >= 0.95
    blind = index.links.withColumn("n", index.links.n * 0)
    assert embedding_dedup.audit(index.nodes, blind, len(rows)) == 0.0


def test_audit_sees_small_groups_beside_a_large_one(spark):
    rows = made(3, [60] + [2] * 15, 100)
    index = embedding_dedup.build(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    n = index.links.n
    blind = index.links.withColumn("n", F.when(n > 10, n).otherwise(0))
    assert index.recall >= 0.95 and embedding_dedup.audit(index.nodes, blind, len(rows)) < 0.9


def test_a_recall_out_of_reach_is_reported(spark):
    df = spark.createDataFrame(made(3, [20, 5], 100), "vec_id long, embedding array<float>")
    with pytest.warns(UserWarning, match="are wanted"):
        assert embedding_dedup.build(df, recall=1.5).recall <= 1


def test_pruned_lists_keep_the_nearest():
    units = embedding_dedup.unit(np.random.default_rng(0).normal(size=(200, 8)))
    lists = embedding_dedup.robust_prune(units)
    cosines = units @ units.T - 2 * np.eye(200)
    assert (lists[:, 0] == cosines.argmax(axis=1)).all()
    assert embedding_dedup.robust_prune(units[:1]).tolist() == [[-1]]


@pytest.mark.parametrize("n", [2, 30])
def test_walks_find_the_nearest(n):
    units = embedding_dedup.unit(np.random.default_rng(n).normal(size=(n, 8)))
    lists = embedding_dedup.robust_prune(units)
    found = embedding_dedup.greedy(units, lists, embedding_dedup.medoid(units), np.arange(n))
    assert (found[:, 0] == np.arange(n)).all()
