"""Connected components over an edge table by alternating star operations.

Every round is two equi-joins on node ids with map-side combined minima, so no
component is ever gathered in one task.  Each round's edges are written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return (both.join(low, both.a == low.n).where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    hung = down.join(low, down.a == low.n).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select(F.col("n").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (a, b: long) -> (node, root): root is the smallest node reachable.

    Self-loops, repeated and reversed edges are allowed; nodes without an edge to
    another node are not returned.  An empty edge table gives an empty result.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct())
    seen = None
    for _ in range(max_rounds):
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
        edges = materialize(_small_star(materialize(_large_star(edges))))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
