"""Connected components of an undirected graph, and joins with a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_and_read


def small(df: DataFrame, most_rows: int, most_bytes: int = 64 << 20) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows (counted, so ``df`` should
    be a written table) in files of at most ``most_bytes``; beyond that Spark joins it by a shuffle."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most_bytes and df.limit(most_rows + 1).count() <= most_rows else df


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    Alternating large-star and small-star rounds: a round points every node's larger, then its
    smaller neighbours at its smallest one, as aggregates and joins, and is written to the shared
    folder. The edge count never grows; about log(longest path) rounds are needed. Loops, repeated
    and reversed edges are fine; edges with a null end are left out.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    e = write_and_read(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        e = write_and_read(_star(_star(e, large=True), large=False), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return e.where("u <> v").select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = now
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) with u >= v in, the same kind out."""
    if large:  # neighbours of u on both sides; those above u move to the smallest
        near = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a smallest node's own larger neighbours are already among those pairs
        return moved.union(e.where("u = v")).distinct()
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
