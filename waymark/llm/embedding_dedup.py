"""Embedding near-dedup on a robust-pruned flat graph.

Vectors are dealt to the shards of their nearest centroids, several each, so that shards
overlap. In every shard each vector keeps a robust-pruned list of neighbours; the lists a
vector gets in its shards are united. The search walks greedily from the shard's medoid
towards a query, and from every vector within the range it expands on along the lists as
long as it meets vectors in range. Each hit is a cosine in double precision, so no pair
below the threshold is ever linked. An audit compares the links of a sample of vectors
with brute force; below the wanted recall the index is built again with twice the overlap.

Equal vectors are one node with a weight. Links are counted where both vectors meet first,
so pairs are never written: a shard gives one row per node, its link count and the
smallest node it reaches there. A shard of very many rows is cut into blocks that meet two
at a time.
"""

from __future__ import annotations

import dataclasses
import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.llm.frames import map_batches, stage, workers_import

COSINE = 0.9
#: Vectors the centroids are fitted on, at most about; centroids, at most.
SAMPLE, MAX_CENTROIDS, FIT_ROUNDS = 20_000, 4096, 4
#: Shards per vector, rows a shard aims at, and rows of a block of a larger one.
OVERLAP, SHARD_ROWS, BLOCK_ROWS = 6, 2000, 3000
#: Robust pruning: nearest candidates looked at, random ones added, list length, and slack.
CANDIDATES, FAR, DEGREE, ALPHA = 48, 8, 20, 1.2
#: Greedy search: beam width; queries walked together; pairs compared together.
BEAM, QUERIES, PAIRS = 12, 512, 1 << 16
#: Vectors audited, about, and the recall to reach.
AUDITED, RECALL = 1000, 0.97


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


# --- the index of one shard -----------------------------------------------------------------


def robust_prune(units: np.ndarray, seed: int = 0) -> np.ndarray:
    """(row, DEGREE) neighbours, -1 where a list is shorter.

    From the nearest candidates on, one is kept and those that are nearer to it than,
    with slack, to the vector itself are passed over.
    """
    n = len(units)
    if n < 2:
        return np.full((n, 1), -1)
    random = np.random.default_rng(seed)
    take = min(CANDIDATES, n - 1)
    near = np.zeros((n, take), dtype=np.int64)
    for at in range(0, n, QUERIES):
        cosines = units[at : at + QUERIES] @ units.T
        cosines[np.arange(len(cosines)), np.arange(at, at + len(cosines))] = -2.0
        near[at : at + QUERIES] = np.argpartition(-cosines, take - 1, axis=1)[:, :take]
    far = random.integers(0, n, (n, FAR))
    pool = np.concatenate([near, far], axis=1)
    lists = np.full((n, DEGREE), -1)
    for at in range(0, n, QUERIES):
        own = units[at : at + QUERIES]
        rows = np.arange(len(own))
        block = pool[at : at + QUERIES]
        away = 1 - np.einsum("nd,ncd->nc", own, units[block])
        order = np.argsort(away, axis=1, kind="stable")
        block, away = np.take_along_axis(block, order, 1), np.take_along_axis(away, order, 1)
        alive = block != (rows + at)[:, None]
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            chosen = block[rows, first]
            lists[at + rows[some], k] = chosen[some]
            between = 1 - np.einsum("nd,ncd->nc", units[chosen], units[block])
            alive &= ALPHA * between > away
            alive[rows, first] = False
    return lists


def medoid(units: np.ndarray) -> int:
    return int((units @ units.mean(axis=0)).argmax())


def greedy(units: np.ndarray, lists: np.ndarray, start: int, queries: np.ndarray) -> np.ndarray:
    """(query, BEAM) best rows met on the walks from ``start``; -1 fills up."""
    n = len(queries)
    rows = np.arange(n)
    own = units[queries]
    beam = np.full((n, BEAM), -1)
    beam[:, 0] = start
    score = np.full((n, BEAM), -2.0)
    score[:, 0] = own @ units[start]
    walked = np.zeros((n, BEAM), dtype=bool)
    walked[:, 1:] = True
    while not walked.all():
        at = np.where(walked, -3.0, score).argmax(axis=1)
        open_ = ~walked[rows, at]
        node = np.where(open_, beam[rows, at], -1)
        walked[rows, at] = True
        ahead = np.where(node[:, None] >= 0, lists[node], -1)
        cosine = np.where(ahead >= 0, np.einsum("nd,ncd->nc", own, units[ahead]), -2.0)
        met = (ahead[:, :, None] == beam[:, None, :]).any(axis=2)
        cosine[met] = -2.0
        all_nodes, all_scores = np.concatenate([beam, ahead], 1), np.concatenate([score, cosine], 1)
        all_walked = np.concatenate([walked, cosine <= -2.0], 1)
        best = np.argsort(-all_scores, axis=1, kind="stable")[:, :BEAM]
        beam, score = np.take_along_axis(all_nodes, best, 1), np.take_along_axis(all_scores, best, 1)
        walked = np.take_along_axis(all_walked, best, 1)
    return np.where(score > -2.0, beam, -1)


def in_range(units: np.ndarray, lists: np.ndarray, queries: np.ndarray, found: np.ndarray, cosine: float) -> np.ndarray:
    """(query, row) booleans: rows within range, reached from the walk's ends and the query along rows in range."""
    seen = np.zeros((len(queries), len(units)), dtype=bool)
    hits = np.zeros_like(seen)
    rows = np.arange(len(queries))
    hits[rows, queries] = seen[rows, queries] = True
    q, node = np.nonzero(found >= 0)
    pairs = np.stack([q, found[q, node]], axis=1)
    pairs = np.concatenate([pairs, *(np.stack([rows, lists[queries, k]], axis=1) for k in range(lists.shape[1]))])
    while len(pairs):
        pairs = pairs[pairs[:, 1] >= 0]
        key = np.unique(pairs[:, 0] * len(units) + pairs[:, 1])
        q, node = key // len(units), key % len(units)
        new = ~seen[q, node]
        q, node = q[new], node[new]
        seen[q, node] = True
        near = np.zeros(len(q), dtype=bool)
        for at in range(0, len(q), PAIRS):
            part = slice(at, at + PAIRS)
            near[part] = np.einsum("nd,nd->n", units[queries[q[part]]], units[node[part]]) >= cosine
        q, node = q[near], node[near]
        hits[q, node] = True
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *(np.stack([q, lists[node, k]], 1) for k in range(lists.shape[1]))])
    return hits


def _smallest_reached(links: np.ndarray) -> np.ndarray:
    """Smallest row each row reaches by links (a symmetric matrix with a full diagonal)."""
    least = links.argmax(axis=1)
    while True:
        over = np.array([least[row].min() for row in links])
        over = np.minimum(over, over[over])
        if (over == least).all():
            return least
        least = over


# --- the jobs -------------------------------------------------------------------------------


@dataclasses.dataclass
class Index:
    #: rep, m (rows with this vector), v (its components)
    nodes: DataFrame
    #: rep, m, v, shards
    dealt: DataFrame
    #: rep, n (weight of linked nodes), component
    links: DataFrame
    recall: float
    overlap: int


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the vectors that can be compared."""
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL"
    )
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    # Adding 0 makes a negative zero a plain one.
    rows = rows.filter(~bad & some).select("vec_id", F.transform("v", lambda x: x + 0.0).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def centroids(nodes: DataFrame, count: int, wanted: int, sample: int = SAMPLE) -> np.ndarray:
    """Unit centroids by spherical k-means on a bounded sample, chosen by a hash of the id."""
    share = min(1.0, sample / max(count, 1))
    chosen = nodes.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("rep")
    table = chosen.select("v").toArrow()
    if not table.num_rows:
        table = nodes.orderBy("rep").limit(1).select("v").toArrow()
    units = unit(_matrix(table["v"]))
    random = np.random.default_rng(0)
    centres = units[random.permutation(len(units))[:wanted]]
    for _ in range(FIT_ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def _deal(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        units = unit(_matrix(batch.column("v")))
        shards = np.zeros((len(units), overlap), dtype=np.int64)
        for at in range(0, len(units), QUERIES):
            shards[at : at + QUERIES] = np.argsort(-(units[at : at + QUERIES] @ centres.T), axis=1, kind="stable")[:, :overlap]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.sort(shards, axis=1).tolist(), pa.list_(pa.int64()))],
            [*batch.schema.names, "shards"],
        )

    return map_batches(nodes, run, "rep long, m long, v array<double>, shards array<long>")


def _build(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("rep")
    reps = table["rep"].to_numpy()
    lists = robust_prune(unit(_matrix(table["v"])))
    near = [[int(reps[k]) for k in row if k >= 0] for row in lists]
    return pa.table({"rep": pa.array(reps, pa.int64()), "near": pa.array(near, pa.list_(pa.int64()))})


def _search(cosine: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, one, two = (k.as_py() for k in key)
        table = table.sort_by("rep")
        reps = table["rep"].to_numpy()
        units = unit(_matrix(table["v"]))
        weight, block = table["m"].to_numpy(), table["block"].to_numpy()
        shards = _matrix(table["shards"]).astype(np.int64)
        n = len(reps)
        near = table["near"].combine_chunks()
        lengths = np.diff(near.offsets.to_numpy())
        flat = near.flatten().to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(reps, flat), n - 1)
        lists = np.full((n, max(1, int(lengths.max()))), -1)
        rows = np.repeat(np.arange(n), lengths)
        lists[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.where(
            reps[place] == flat, place, -1
        )
        start = medoid(units)
        hits = np.zeros((n, n), dtype=bool)
        for at in range(0, n, QUERIES):
            queries = np.arange(at, min(n, at + QUERIES))
            hits[queries] = in_range(units, lists, queries, greedy(units, lists, start, queries), cosine)
        hits |= hits.T
        least = reps[_smallest_reached(hits)]
        # A pair counts in the first shard that both vectors are in, and there where their blocks meet.
        counts = np.zeros(n, dtype=np.int64)
        for row in range(n):
            others = np.flatnonzero(hits[row])
            others = others[others != row]
            if one != two:
                others = others[block[others] != block[row]]
            common = (shards[others][:, :, None] == shards[row]).any(axis=2)
            first = np.where(common, shards[others], np.iinfo(np.int64).max).min(axis=1) if len(others) else others
            counts[row] = weight[others[first == shard]].sum()
        return pa.table({"rep": pa.array(reps), "n": pa.array(counts), "least": pa.array(least)})

    return run


def _link(dealt: DataFrame, cosine: float) -> DataFrame:
    """rep, n and component of every node that was dealt."""
    workers_import(dealt)
    copies = dealt.select("rep", "m", "v", "shards", F.explode("shards").alias("shard"))
    sizes = stage(
        copies.groupBy(F.col("shard").alias("s")).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks")), "shards"
    )
    placed = copies.join(sizes, F.col("shard") == F.col("s")).drop("s")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    lists = placed.select("shard", "block", "rep", "v").groupBy("shard", "block").applyInArrow(
        _build, "rep long, near array<long>"
    )
    # A node has a list from each of its shards, so the union is bounded.
    united = stage(lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o)).alias("other")
    rows = placed.select("*", meets).select(
        "shard",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        *("rep", "m", "v", "shards", "block"),
    )
    rows = rows.join(united.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")).drop("r")
    found = stage(
        rows.groupBy("shard", "one", "two").applyInArrow(_search(cosine), "rep long, n long, least long"), "found"
    )
    joined = components(found.filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    linked = counts.join(joined, F.col("rep") == F.col("node"), "left")
    return stage(linked.select("rep", "n", F.coalesce("component", "rep").alias("component")), "linked")


def audit(nodes: DataFrame, links: DataFrame, count: int, cosine: float = COSINE, audited: int = AUDITED) -> float:
    """Share of the true links of a bounded sample of nodes that were found; brute force, in blocks.

    The lesser of the share of all their links and the mean of each linked node's own share:
    a large group has nearly all links, and must not hide what small groups miss.
    """
    chosen = nodes.filter(F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 20)) < int(min(1.0, audited / max(count, 1)) * (1 << 20)))
    table = chosen.select("rep", "v").toArrow()
    if not table.num_rows:
        return 1.0
    queries, ids = unit(_matrix(table["v"])), table["rep"].to_numpy()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = unit(_matrix(batch.column("v"))) @ queries.T >= cosine
        near &= batch.column("rep").to_numpy()[:, None] != ids
        sums = (near * batch.column("m").to_numpy()[:, None]).sum(axis=0)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums)], ["q", "true"])

    true = map_batches(nodes, run, "q long, true long").groupBy("q").agg(F.sum("true").alias("true"))
    got = F.least("n", "true")
    own = F.when(F.col("true") > 0, got / F.col("true"))
    both = true.join(links, F.col("q") == F.col("rep"))
    both = both.agg(F.sum("true").alias("t"), F.sum(got).alias("n"), F.avg(own).alias("mean")).first()
    return min(both["n"] / both["t"], both["mean"]) if both["t"] else 1.0


def build(embeddings: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP, recall: float = RECALL) -> Index:
    """Index and link all usable vectors; widen the overlap until the audit is content."""
    nodes = usable(embeddings).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    nodes = stage(nodes.select("rep", "m", "v"), "nodes")
    count = nodes.count()
    while True:
        shards = max(1, min(MAX_CENTROIDS, math.ceil(count * overlap / SHARD_ROWS))) if count else 1
        if count:
            centres = centroids(nodes, count, shards)
            each = min(overlap, len(centres))
            dealt = stage(_deal(nodes, centres, each), "dealt")
        else:
            each, dealt = 1, nodes.withColumn("shards", F.array(F.lit(0).cast("long")))
        links = _link(dealt, cosine)
        found = audit(nodes, links, count, cosine)
        if found >= recall or each >= shards:
            if found < recall:
                warnings.warn(f"the audit found {found:.4f} of the links, {recall} are wanted; every shard holds all vectors", stacklevel=2)
            return Index(nodes, dealt, links, found, each)
        overlap *= 2


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors with a cosine of ``cosine`` or more are linked, whatever their labels.
    ``n_links`` counts the other rows linked directly, equal vectors included;
    ``component_id`` is the smallest vec_id that links reach. A vector that is null, zero,
    of another length than most, or that holds null or non-finite components is linked
    with nothing. A null vec_id cannot name a component: such a row has none and stays.
    """
    index = build(embeddings, cosine)
    joined = index.nodes.select(F.col("rep"), "m", F.col("v").alias("__v")).join(
        index.links.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r"), "left"
    )
    known = stage(joined.select("__v", "m", F.coalesce("n", F.lit(0)).alias("n"), "component"), "known")
    rows = embeddings.select(
        "vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0).alias("__own")
    )
    found = rows.join(known, (F.col("__own") == F.col("__v")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce(F.col("m") - 1 + F.col("n"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
