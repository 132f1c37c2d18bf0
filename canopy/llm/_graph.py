"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm._store import Work


def components(work: Work, edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges(a, b) that isn't its component's smallest.

    Each round is joins and partial aggregates over edges dealt by node, so a hub
    is split by the join and never gathered; a written table ends its lineage.
    """
    tidy = lambda df, u, v: df.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()
    now = work.save(tidy(edges, "a", "b"), "round0")
    k, seen = 0, None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tidy(both.join(least, "u").filter("v > u").select("v", "m"), "v", "m")
        large = work.save(large, f"large{k}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = tidy(joined.select(F.explode(F.array("u", "v")).alias("n"), "m"), "n", "m")
        was, k = k, k + 1
        now = work.save(small, f"round{k}")
        work.drop(f"large{was}")
        work.drop(f"round{was}")
        print_ = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(print_) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(print_)
