"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum and a join on node keys; nothing is gathered.
A hub with very many edges is a hot key of a join only, which adaptive
execution splits. Steps are written to the shared folder, so lineage stays
short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): every node that has an edge, with the smallest node it is
    connected to. An empty edge table gives an empty result."""
    pair = lambda x, y: F.struct(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where(F.col("x") != F.col("y"))
    e = materialize(e.select(pair(F.col("x"), F.col("y")).alias("p")).select("p.*").distinct(), "edges")
    while True:
        # Large star: the larger neighbours of a node go to the smallest of it and its neighbours.
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: the smaller neighbours of a node, and the node, go to their smallest.
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small_low.select("u", F.col("m").alias("v")))
                 .where(F.col("u") != F.col("v")).distinct())
        new = materialize(small, "edges")
        # Done when every node has one edge, and no target has one itself.
        deep = new.groupBy("u").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1).limit(1).count()
        chained = 0 if deep else new.join(new.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").limit(1).count()
        e = new
        if not deep and not chained:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
