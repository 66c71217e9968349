"""Connected components of an edge table, by rounds of joins; nothing is gathered on the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm._shared import Stages


def components(edges: DataFrame, stage: Stages, most_rounds: int = 60) -> DataFrame:
    """(u, v) bigint pairs to (u, c): c is the smallest node reachable from u. Nodes without an edge, or with an edge to themselves alone, are left out.

    Alternates large-star and small-star steps, in which each node's neighbours are linked to its smallest one, until
    every node is linked to its component's smallest. A hub is handled by a partially aggregated minimum and a join
    that may be split, so no task gets all of its neighbours.
    """
    e = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    for _ in range(most_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        e = stage(small, "edges")
        # Done when each node has one link, and none leads to a node that has a link itself.
        n, nodes = e.agg(F.count("*"), F.countDistinct("u")).first()
        if n == nodes and not e.select(F.col("v").alias("u")).distinct().join(e, "u", "left_semi").limit(1).count():
            break
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    return e.select("u", F.col("v").alias("c"))
