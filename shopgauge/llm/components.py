"""Connected components of links in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgauge.llm.common import store



def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node in ``links`` (two long columns ``a`` and ``b``); the smallest node names the component.

    Turns of large-star and small-star: every node is linked to the smallest
    of its neighbours, first for the larger ones, then for the smaller, until
    each component is a star. Turns grow with the logarithm of the number of
    nodes. Each is written to the shared folder, so lineage stays short. The
    smallest neighbour is merged before the shuffle, so a node with very many
    links costs one row per task. Only counts reach the driver.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = store(pairs, "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turned = store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # done when each node has one link, to a node that has none
        ends = turned.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("own")), F.struct(F.col("v").alias("node"), F.lit(0).alias("own")))).alias("e"))
        own = ends.groupBy("e.node").agg(F.sum("e.own").alias("links"), F.count_if(F.col("e.own") == 0).alias("ends"))
        if own.where("links > 1 or (links = 1 and ends > 0)").isEmpty():
            break
        pairs = turned
    tops = turned.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return turned.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
