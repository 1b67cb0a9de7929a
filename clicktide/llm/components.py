"""Connected components of a large edge table by alternating star contractions.

Each round is two aggregations and two joins over the edge table, which shrinks towards one star
per component; the number of rounds grows with the logarithm of the longest path. No group of
edges is ever gathered: minima combine before the shuffle, and a hub's edges are joined in a way
that adaptive execution can split. Every round is written to the shared folder, which cuts the
lineage; the table of the round before is then deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import delete_path
from clicktide.operators.ordered import join_per_key
from clicktide.session import scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; ``root`` is the smallest node of its component.

    Null ends, loops and repeated edges are ignored, an edge's direction has no meaning, and an
    empty table gives no rows. Nodes are bigint.
    """
    spark = edges.sparkSession
    usable = edges.select(
        F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    path, state = _write(usable.distinct())
    while state[0]:
        stars, _ = _write(_small_star(_large_star(spark.read.parquet(path))))
        delete_path(spark, path)
        path, before = stars, state
        state = _fingerprint(spark.read.parquet(path))
        if state == before:
            break
    stars = spark.read.parquet(path)
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _write(edges: DataFrame) -> tuple[str, tuple]:
    path = scratch(edges.sparkSession, "edges")
    edges.write.parquet(path)
    return path, _fingerprint(edges.sparkSession.read.parquet(path))


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: the number of edges and two sums over them."""
    row = edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node that the node touches."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    linked = join_per_key(both, least, ["u"], "inner").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_per_key(edges, least, ["u"], "inner").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where(F.col("u") != F.col("v")).distinct()
