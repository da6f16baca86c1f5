"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.llm.common import materialise


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links`` has long columns ``a`` and ``b``.  Each round rewires links towards
    smaller neighbours by aggregations and equi-joins; the links are written to
    the shared folder between rounds.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("n"), F.least("u", "low").alias("m"))
        large = both.where("v > u").join(nearest, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        small = large.join(low, F.col("u") == F.col("n")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()
        edges = materialise(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
