"""Connected components of a graph given as rows, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import written


def roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; both are longs.

    A large star hooks each node's larger neighbours to its smallest one, a small star its smaller ones; the edges end as
    stars around the smallest nodes, in about the logarithm of the size of the largest component rounds. Every round is
    a table in the shared folder. Minima are taken by aggregation, so a node with many links gathers in no task.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.*").where("u <> v").distinct()
        edges = written(small, "small-star")
        inner = edges.select(F.col("u").alias("v"))
        repeated = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        if not edges.join(inner, "v", "left_semi").select("u").unionAll(repeated).take(1):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
