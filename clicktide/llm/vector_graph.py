"""Embedding near-duplicates by a robust-pruned flat graph.

Copies of a vector are one node. Nodes are dealt to overlapping shards, each to its ``OVERLAP``
nearest of a set of cluster centres; an overfull cell is tiled, so that any two of its nodes meet
in a tile. Each shard builds a graph: a node's nearest rows are its candidates, and robust pruning
keeps a candidate only if no kept one is nearer to it, by the factor ``ALPHA``, than the node is;
back edges are added. The adjacency lists of all shards are united. Every node is then a query in
its shards: a greedy search from the shard's medoid and the node itself expands the best node
seen; after ``EXPANSIONS`` steps it goes on only while the best node left is within range. Pairs
found are verified by their cosine in double precision, and a pair that meets in several shards
counts in the first of them. Recall is audited on a sample of nodes against all others, and with
too little of it the search is done anew over more overlapping shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.components import connected_components
from clicktide.llm.topk import usable
from clicktide.operators.ordered import join_per_key
from clicktide.session import materialize

THRESHOLD = 0.9
SHARD_ROWS, OVERLAP = 2048, 3
#: Bounds of the sample and number of centres, which are sent to every task.
MAX_CENTRES, SAMPLE_PER_CENTRE, MAX_SAMPLE = 4096, 32, 20_000
DEGREE, CANDIDATES, ALPHA = 24, 48, 1.2
EXPANSIONS = 24
QUERY_ROWS = 256
AUDIT_QUERIES, MIN_RECALL, AUDIT_ROUNDS = 200, 0.95, 3


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, against overflow."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _stack(column: pd.Series) -> np.ndarray:
    return _unit(np.stack([np.asarray(x, dtype=float) for x in column]))


def fit_centres(sample: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means over a bounded sample, seeded by its first rows."""
    centres = sample[:k].copy()
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def _assigner(centres: dict[int, np.ndarray], overlap: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby(frame["v"].map(len)):
                c = centres[dim]
                take = min(overlap, len(c))
                similar = _stack(own["v"]) @ c.T
                near = np.argpartition(-similar, take - 1, axis=1)[:, :take]
                yield pd.DataFrame(
                    {"node": own["node"].to_numpy(), "cells": [(dim << 32 | x).tolist() for x in near.astype(np.int64)]}
                )

    return run


def shards_of(nodes: DataFrame, overlap: int) -> DataFrame:
    """(node, shards): the shards each node lies in, as sorted arrays."""
    total = nodes.count()
    k = int(min(MAX_CENTRES, max(1, -(-total * overlap * 2 // SHARD_ROWS))))
    size = min(MAX_SAMPLE, k * SAMPLE_PER_CENTRE)
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(size).select("v").collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    for r in nodes.select("v").groupBy(F.size("v")).agg(F.first("v").alias("v")).collect():
        by_dim.setdefault(len(r["v"]), []).append(r["v"])  # one row for each length
    centres = {
        dim: fit_centres(s := _unit(np.array(v, dtype=float)), min(k, len(s))) for dim, v in by_dim.items()
    }
    cells = materialize(
        nodes.select("node", "v")
        .mapInPandas(_assigner(centres, overlap), "node bigint, cells array<bigint>")
        .select("node", F.explode("cells").alias("cell")),
        "cells",
    )
    # A cell of over SHARD_ROWS nodes becomes g parts, and a tile for every two parts. There are
    # at most MAX_CENTRES cells for each length of vectors.
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") * 2 / SHARD_ROWS)).cast("int")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("cell", F.when(F.col("n") <= SHARD_ROWS, 1).otherwise(parts).alias("g"))
    part = F.pmod(F.xxhash64("node", F.lit(5)), F.col("g"))
    other = F.sequence(F.lit(0), F.col("g") - 1)
    tiles = F.when(F.col("g") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(
        F.transform(
            F.filter(other, lambda o: o != F.col("part")),
            lambda o: F.least(o, F.col("part")) * (1 << 20) + F.greatest(o, F.col("part")),
        )
    )
    tiled = (
        join_per_key(cells, sizes, ["cell"], "inner")
        .withColumn("part", part)
        .withColumn("tile", F.explode(tiles))
        .withColumn("shard", F.xxhash64("cell", "tile"))
    )
    lists = tiled.groupBy("node").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    return materialize(lists, "shards")


def robust_prune(vectors: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists over the rows: robust pruning of near rows, with back edges."""
    n = len(vectors)
    if n < 2:
        return [np.empty(0, dtype=np.int64)] * n
    take = min(CANDIDATES, n - 1)
    near = np.empty((n, take), dtype=np.int64)
    for at in range(0, n, 512):
        similar = vectors[at : at + 512] @ vectors.T
        similar[np.arange(len(similar)), np.arange(at, at + len(similar))] = -np.inf
        some = np.argpartition(-similar, take - 1, axis=1)[:, :take]
        order = np.argsort(-np.take_along_axis(similar, some, axis=1), axis=1, kind="stable")
        near[at : at + 512] = np.take_along_axis(some, order, axis=1)
    kept = np.full((n, DEGREE), -1, dtype=np.int64)
    count = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    for c in range(take):
        candidate = near[:, c]
        away = 1 - np.einsum("ij,ij->i", vectors, vectors[candidate])
        between = 1 - np.einsum("ikj,ij->ik", vectors[np.maximum(kept, 0)], vectors[candidate])
        # Squared distances are twice these, so the factor is squared.
        covered = ((ALPHA**2 * between < away[:, None]) & (kept >= 0)).any(axis=1)
        add = rows[~covered & (count < DEGREE)]
        kept[add, count[add]] = candidate[add]
        count[add] += 1
    source = np.repeat(rows, count)
    target = kept[kept >= 0]
    pairs = np.unique(np.concatenate([source * n + target, target * n + source]))
    a, b = pairs // n, pairs % n
    order = np.lexsort((-np.einsum("ij,ij->i", vectors[a], vectors[b]), a))
    a, b = a[order], b[order]
    begin = np.searchsorted(a, np.arange(n + 1))
    return [b[begin[i] : begin[i + 1]][: 2 * DEGREE] for i in range(n)]


def range_search(
    vectors: np.ndarray, lists: np.ndarray, queries: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """(query row, found row) of all rows met with cosine >= ``least``; ``queries`` are rows.

    ``lists`` holds neighbours by row, filled up with -1.
    """
    n, q = len(vectors), len(queries)
    medoid = int((vectors @ vectors.mean(axis=0)).argmax())
    similar = np.full((q, n), -np.inf)
    closed = np.zeros((q, n), dtype=bool)
    who = np.arange(q)
    similar[who, medoid] = vectors[queries] @ vectors[medoid]
    similar[who, queries] = np.einsum("ij,ij->i", vectors[queries], vectors[queries])
    steps = 0
    while len(who):
        open_ = np.where(closed[who], -np.inf, similar[who])
        best = open_.argmax(axis=1)
        value = open_[np.arange(len(who)), best]
        on = (value > -np.inf) & ((value >= least) | (steps < EXPANSIONS))
        who, best = who[on], best[on]
        closed[who, best] = True
        nearby = lists[best]
        row, column = np.nonzero(nearby >= 0)
        at, to = who[row], nearby[row, column]
        new = similar[at, to] == -np.inf
        at, to = at[new], to[new]
        similar[at, to] = np.einsum("ij,ij->i", vectors[queries[at]], vectors[to])
        steps += 1
    found_at, found = np.nonzero(similar >= least)
    other = found != queries[found_at]
    return queries[found_at[other]], found[other]


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    lists = robust_prune(_stack(frame["v"]))
    node = frame["node"].to_numpy()
    return pd.DataFrame({"node": node, "near": [node[x].tolist() for x in lists]})


def _searcher(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        vectors, node = _stack(frame["v"]), frame["node"].to_numpy()
        n, shard = len(node), int(frame["shard"].iloc[0])
        order = np.argsort(node)
        lists = []
        for near in frame["near"]:
            near = np.asarray(near, dtype=np.int64)
            at = np.minimum(np.searchsorted(node[order], near), n - 1)
            lists.append(order[at[node[order][at] == near]])  # neighbours in other shards wait there
        width = max(map(len, lists), default=0)
        table = np.full((n, max(width, 1)), -1, dtype=np.int64)
        for i, near in enumerate(lists):
            table[i, : len(near)] = near
        met = np.zeros((n, n), dtype=bool)
        for at in range(0, n, QUERY_ROWS):
            a, b = range_search(vectors, table, np.arange(at, min(at + QUERY_ROWS, n)), threshold)
            met[a, b] = met[b, a] = True
        a, b = np.nonzero(met)
        most = max(map(len, frame["shards"]))
        shards = np.full((n, most), np.iinfo(np.int64).max)
        for i, own in enumerate(frame["shards"]):
            shards[i, : len(own)] = own
        copies, links = frame["copies"].to_numpy(), np.zeros(n, dtype=np.int64)
        for at in range(0, len(a), 1 << 16):
            i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            common = (shards[i][:, :, None] == shards[j][:, None, :]).any(axis=2)
            first = np.where(common, shards[i], np.iinfo(np.int64).max).min(axis=1)
            np.add.at(links, i[first == shard], copies[j[first == shard]])
        root = np.arange(n)
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            low = low[low]
            if np.array_equal(low, root):
                break
            root = low
        return pd.DataFrame({"node": node, "links": links, "root": node[root]})

    return run


def _nodes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: node number, vector, number of copies, smallest vec_id."""
    longest = F.array_max(F.transform("embedding", lambda c: F.abs(c)))
    return materialize(
        vectors.where(usable("embedding") & (longest > 0))
        .groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
        .select(F.monotonically_increasing_id().alias("node"), F.col("embedding").alias("v"), "copies", "first_id"),
        "nodes",
    )


def search_links(nodes: DataFrame, threshold: float, overlap: int) -> DataFrame:
    """(node, links, root) per node and shard."""
    lists = shards_of(nodes, overlap)
    placed = join_per_key(nodes.select("node", "v", "copies"), lists, ["node"], "inner")
    placed = materialize(placed.withColumn("shard", F.explode("shards")), "placed")
    adjacency = (
        placed.select("shard", "node", "v")
        .groupBy("shard")
        .applyInPandas(lambda f: _build(f), "node bigint, near array<bigint>")
        .groupBy("node")
        .agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    )
    searched = (
        placed.join(adjacency, "node")
        .groupBy("shard")
        .applyInPandas(_searcher(threshold), "node bigint, links bigint, root bigint")
    )
    return materialize(searched, "links")


def audit(nodes: DataFrame, per_node: DataFrame, threshold: float) -> float:
    """Share of the true links of a sample of nodes that was found; 1.0 if they have none."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit(9)), "node").limit(AUDIT_QUERIES).collect()
    of_dim: dict[int, list] = {}
    for r in sample:
        of_dim.setdefault(len(r["v"]), []).append(r)
    asked = {
        dim: (np.array([r["node"] for r in rows]), _unit(np.array([r["v"] for r in rows], dtype=float)))
        for dim, rows in of_dim.items()
    }

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby(frame["v"].map(len)):
                if dim not in asked:
                    continue
                ids, queries = asked[dim]
                close = queries @ _stack(own["v"]).T >= threshold
                close &= ids[:, None] != own["node"].to_numpy()[None]
                yield pd.DataFrame({"node": ids, "true": close @ own["copies"].to_numpy()})

    true = nodes.select("node", "v", "copies").mapInPandas(run, "node bigint, true bigint")
    row = (
        true.groupBy("node").agg(F.sum("true").alias("true"))
        .join(per_node.select("node", "links"), "node")
        .agg(F.sum("true"), F.sum(F.least("true", "links")))
        .first()
    )
    return row[1] / row[0] if row[0] else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id that
    links reach. Vectors that are null, zero, or hold null or non-finite components link with
    nothing, and vectors of different lengths never do. Rows that repeat a vec_id are rows of their
    own; a null vec_id is never the smallest, and its row is kept only if its component has no id.
    Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    nodes = _nodes(rows)
    overlap = OVERLAP
    for _ in range(AUDIT_ROUNDS):
        found = search_links(nodes, threshold, overlap)
        per_node = found.groupBy("node").agg(F.sum("links").alias("links"))
        if audit(nodes, per_node, threshold) >= MIN_RECALL:
            break
        overlap *= 2
    roots = connected_components(found.where("node <> root"), "node", "root")
    labelled = nodes.select("node", "first_id").join(roots, "node", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "node"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = (
        nodes.select("node", F.col("v").alias("embedding"), "copies")
        .join(per_node, "node")
        .join(labelled.select("node", "root"), "node")
        .join(smallest, "root")
        .select("embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    )
    result = materialize(result, "vector-components")
    joined = join_per_key(rows, result, ["embedding"], "left")
    single = F.col("n_links").isNull()
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.when(single, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
