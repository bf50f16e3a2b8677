"""Connected components in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.lineage import discard, written


def contract(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """Connected components of (a, b) edges: (node, root), root the least node; only nodes with an edge to another one.

    Nodes may be structs. Each round links every node's larger neighbours to its least neighbour, then its smaller ones
    likewise, so components become stars in rounds that grow with the logarithm of their size. All groupings are minima, combined
    before they are shuffled, and are written before they meet the links, so that Spark can split a node with very many neighbours.
    """
    spark = edges.sparkSession
    made: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        out, path = written(df)
        made.append(path)
        return out

    down = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = keep(down(edges.filter("a <> b")))
    known = None
    for _ in range(rounds):
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = keep(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(large.filter("a <> b").distinct())
        low = keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        old, made = made, []
        links = keep(down(small.unionByName(low.select("a", F.col("m").alias("b")))))
        discard(spark, old)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
