"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014), on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, table


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return attach(both, least, ["a"], "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = attach(down, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (bigint). Returns node, root for every node of an edge; root is the component's smallest node.

    Each round is written to the shared folder, so lineage stays short. Self-loops are components of their own; an
    empty table gives an empty result. The rounds grow with the logarithm of the size, and no node gathers its edges.
    """
    alone = edges.where("a = b").select(F.col("a").alias("node")).distinct()
    now, seen = table(edges.where("a <> b").select("a", "b").distinct(), "cc"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        if (state["n"], state["s"]) == seen:
            break
        seen = (state["n"], state["s"])
        now = table(_small(_large(now)), "cc")
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = out.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    return out.unionByName(alone.join(out, "node", "left_anti").select("node", F.col("node").alias("root")))
