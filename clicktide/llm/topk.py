"""Exact top-k inner-product search by ball trees, one per shard.

Vectors become integers floor(256 * x). Each Arrow batch of the table is a shard; a task builds the
shard's ball tree and searches it for a block of queries. No vector of a ball with centre c and
radius r has an inner product above q.c + |q| r with a query q. Leaves are visited in the order of
that bound (of the leaf and of all balls around it) until it falls below the query's k-th score so
far. The k-th score is shared: it starts from a sample of the candidates that every block has seen,
goes on through all shards that a task searches for the block, and ties with it are still looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.session import materialize

SCALE = 256.0
K = 5
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4096, 1024, 128
#: Candidates whose scores give each query its first k-th score.
SEED_ROWS = 2048
_EXACT = 2.0**53
_LONG = 2**63 - 1


def usable(embedding: str) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite components."""
    x = F.col(embedding)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return x.isNotNull() & ~odd


class BallTree:
    """Nodes of one shard; leaves hold slices of the reordered rows."""

    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.arange(len(rows))
        self.centres, self.radii, self.leaves = [], [], []
        self.path: list[list[int]] = []  # nodes from the root to each leaf
        stack = [(0, len(rows), [])]
        while stack:
            low, high, above = stack.pop()
            own = rows[self.order[low:high]]
            centre = own.mean(axis=0)
            self.centres.append(centre)
            self.radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
            path = [*above, len(self.centres) - 1]
            if high - low <= LEAF_ROWS:
                self.leaves.append((low, high))
                self.path.append(path)
                continue
            # Split at the median along the line between two far rows.
            a = own[((own - centre) ** 2).sum(axis=1).argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            along, middle = (own @ (b - a)), (high - low) // 2
            self.order[low:high] = self.order[low:high][np.argpartition(along, middle)]
            stack += [(low, low + middle, path), (low + middle, high, path)]
        self.rows = rows[self.order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of each query's inner products with each leaf, with room for rounding."""
        length = np.sqrt((queries**2).sum(axis=1))
        reach = length[:, None] * self.radii[None]
        room = 1e-9 * (reach + length[:, None] * np.sqrt((self.centres**2).sum(axis=1))[None] + 1)
        node = queries @ self.centres.T + reach + room
        return np.stack([node[:, p].min(axis=1) for p in self.path], axis=1)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles where these hold them, else Python integers."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)))
    if np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] < _EXACT:
        return queries @ rows.T
    whole = np.vectorize(int, otypes=[object])
    return whole(queries) @ whole(rows).T


class Best:
    """The k best of each query so far: scores falling, ties by rising id."""

    def __init__(self, query_ids: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.query_ids, self.floor, self.k = query_ids, floor, k
        self.scores = np.full((len(query_ids), k), -np.inf)
        self.ids = np.full((len(query_ids), k), _LONG, dtype=np.int64)

    def kth(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1].astype(float), self.floor)

    def offer(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        own = self.query_ids[who][:, None] == ids[None]
        scores = np.where(own, -np.inf, scores)
        promising = (scores >= self.kth()[who][:, None]).any(axis=1)
        who, scores = who[promising], scores[promising]
        if not len(who):
            return
        if scores.dtype == object:
            self.scores = self.scores.astype(object)
        all_scores = np.hstack([self.scores[who], scores])
        all_ids = np.hstack([self.ids[who], np.broadcast_to(ids, scores.shape)])
        if all_scores.dtype == object:  # whole numbers beyond what a double holds
            pairs = [sorted(range(len(i)), key=lambda c: (-s[c], i[c])) for s, i in zip(all_scores, all_ids)]
            best = np.array(pairs)[:, : self.k]
        else:
            best = np.lexsort((all_ids, -all_scores), axis=-1)[:, : self.k]
        self.scores[who] = np.take_along_axis(all_scores, best, axis=1)
        self.ids[who] = np.take_along_axis(all_ids, best, axis=1)


def search(tree: BallTree, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Visit the leaves of one shard in each query's order of bounds, best first."""
    bounds = tree.bounds(queries)
    order = np.argsort(-bounds, axis=1, kind="stable")
    open_ = np.arange(len(queries))
    for turn in range(order.shape[1]):
        leaf = order[open_, turn]
        alive = bounds[open_, leaf] >= best.kth()[open_]
        open_, leaf = open_[alive], leaf[alive]
        if not len(open_):
            return
        for one in np.unique(leaf):
            low, high = tree.leaves[one]
            who = open_[leaf == one]
            best.offer(who, products(queries[who], tree.rows[low:high]), ids[tree.order[low:high]])


def _packed(rows: DataFrame, batch_rows: int, prefix: str) -> DataFrame:
    """One row per Arrow batch: number, dimension, ids and the matrix, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8")
            vectors = batch.column("_v")
            size = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
            begin = np.concatenate([[0], np.cumsum(size)])[:-1]
            for dim in np.unique(size):  # vectors of different lengths never meet
                of_dim = np.flatnonzero(size == dim)
                for at in range(0, len(of_dim), batch_rows):
                    own = of_dim[at : at + batch_rows]
                    matrix = np.floor(SCALE * values[begin[own][:, None] + np.arange(dim)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number]), pa.array([int(dim)], pa.int32()),
                         pa.array([ids[own].tobytes()], pa.binary()),
                         pa.array([matrix.astype("<f8").tobytes()], pa.binary())],
                        [f"{prefix}_no", "dim", f"{prefix}_ids", f"{prefix}_matrix"],
                    )
                    number += 1

    return rows.select("vec_id", F.col("embedding").alias("_v")).mapInArrow(
        run, f"{prefix}_no bigint, dim int, {prefix}_ids binary, {prefix}_matrix binary"
    )


def _matrix(data: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(n, dim)


def _searcher(k: int, seed: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Searches joined rows of (block, shard); rows of one block follow each other."""

    def results(best: Best) -> pa.RecordBatch:
        found = best.scores > -np.inf
        scores = [max(-_LONG - 1, min(_LONG, int(s))) for s in best.scores[found]]
        query = np.broadcast_to(best.query_ids[:, None], best.ids.shape)[found]
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(best.ids[found]), pa.array(scores, pa.int64())],
            ["query_id", "vec_id", "score"],
        )

    def floor_of(dim: int, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        floor = np.full(len(ids), -np.inf)
        if dim in seed and len(seed[dim][0]) > k:
            first = Best(ids, floor, k)
            first.offer(np.arange(len(ids)), products(queries, seed[dim][1]), seed[dim][0])
            floor = first.kth()
        return floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, queries = None, None, None
        shard, tree, ids = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if row["block_no"] != block:
                    if best is not None:
                        yield results(best)
                    block = row["block_no"]
                    query_ids = np.frombuffer(row["block_ids"], "<i8")
                    queries = _matrix(row["block_matrix"], dim, len(query_ids))
                    best = Best(query_ids, floor_of(dim, query_ids, queries), k)
                if row["shard_no"] != shard:
                    shard = row["shard_no"]
                    ids = np.frombuffer(row["shard_ids"], "<i8")
                    tree = BallTree(_matrix(row["shard_matrix"], dim, len(ids)))
                search(tree, ids, queries, best)
        if best is not None:
            yield results(best)

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` highest inner products.

    Both tables have vec_id and embedding. Rows without an id, and vectors that are null or hold
    null or non-finite components, take no part; vectors of different lengths never meet. A query
    does not meet rows of its own id; if rows repeat a query's id, the smallest vector is the
    query. Repeated candidates are all candidates. Ties go to the smaller vec_id; a query without
    candidates has no row; scores outside the range of long are shown at its ends.
    """
    spark = vectors.sparkSession
    # Batches make the shards, and joined rows of two matrices come a few at a time.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    valid = vectors.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"
    )
    asked = (
        queries.where(usable("embedding") & F.col("vec_id").isNotNull())
        .groupBy(F.col("vec_id").cast("bigint").alias("vec_id"))
        .agg(F.min("embedding").alias("embedding"))
    )
    spark.conf.set(key, str(SHARD_ROWS))
    shards = materialize(_packed(valid, SHARD_ROWS, "shard"), "shards")
    blocks = materialize(_packed(asked, BLOCK_ROWS, "block"), "blocks")
    spark.conf.set(key, "8")
    seed: dict[int, list] = {}
    sampled = valid.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(SEED_ROWS)
    for row in sampled.collect():  # SEED_ROWS rows at most
        seed.setdefault(len(row["embedding"]), []).append(row)
    known = {
        dim: (
            np.array([r["vec_id"] for r in rows], dtype=np.int64),
            np.floor(SCALE * np.array([r["embedding"] for r in rows], dtype=float)),
        )
        for dim, rows in seed.items()
    }
    # Every block meets every shard of its dimension: shards are sent once per block.
    numbers = blocks.select("dim", "block_no").groupBy("dim").agg(F.collect_list("block_no").alias("_all"))
    met = (
        shards.join(numbers, "dim")
        .withColumn("block_no", F.explode("_all"))
        .drop("_all")
        .join(blocks.withColumnRenamed("dim", "_dim"), "block_no")
        .repartition("block_no", (F.col("shard_no") % 8).alias("_part"))
        .sortWithinPartitions("block_no", "shard_no")
        .select("block_no", "block_ids", "block_matrix", "dim", "shard_no", "shard_ids", "shard_matrix")
    )
    found = materialize(
        met.mapInArrow(_searcher(k, known), "query_id bigint, vec_id bigint, score bigint"), "found"
    )
    spark.conf.set(key, before)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
