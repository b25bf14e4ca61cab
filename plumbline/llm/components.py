"""Connected components of an undirected edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select("b", "m").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, root): root is the least node that can be reached. Nodes without an edge do not occur.

    Each round is written to the shared folder; the number of rounds is logarithmic in the longest path.
    Null ends and loops are ignored; an empty edge table gives an empty result.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).groupBy("node").agg(F.min("root").alias("root"))
        mark = state
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
