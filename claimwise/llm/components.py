"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) -> (node, component): every node that has an edge, with the smallest node it reaches.

    Each round is a few joins and partial aggregates over the edges and is written to the shared folder; rounds
    grow with the logarithm of the longest chain.  Loops and repeated edges do no harm; no edges give no rows."""
    e = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct()
    e = stored(e, "cc")
    mark = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"))
    last = e.agg(*mark).first()
    while last["n"]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").filter("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        e = stored(small.unionAll(least.select("v", F.col("m").alias("u"))).distinct(), "cc")
        now = e.agg(*mark).first()
        if now == last:
            break
        last = now
    roots = e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(roots)
