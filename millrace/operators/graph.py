"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import materialize


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, comp): comp is the smallest node reachable over edges (a, b).

    Alternates large-star and small-star steps until nothing changes; each is one aggregate of minima
    (combined before the shuffle) and one join on the node, and each round is written
    to shared storage. Stars settle in two or three rounds, paths of length n in
    O(log n). Only nodes with an edge to another one appear.
    """
    cur = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{tag}-e0"
    )
    digest = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"))
    stat, i = cur.agg(*digest).first(), 0
    while stat["n"]:
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        # large star: every larger neighbour v of u moves to the smallest of u's neighbourhood
        large = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        # small star: u and its smaller neighbours move to the smallest of them
        moved = large.join(low2, F.col("u") == F.col("k"))
        small = moved.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        i += 1
        cur = materialize(small.where("u <> v").distinct(), f"{tag}-e{i}")
        now = cur.agg(*digest).first()
        if now == stat:
            break
        stat = now
    return cur.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp").unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    ).groupBy("node").agg(F.min("comp").alias("comp"))
