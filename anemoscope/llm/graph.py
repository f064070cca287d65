"""Connected components of a graph given by its links."""

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoscope.llm import common


def components(links: DataFrame, staging: common.Staging) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every linked node.

    ``links`` has columns ``a`` and ``b`` of one type; direction, repeats and loops don't
    matter, and links with a null are left out. Each round links the neighbours of every
    node to the smallest of them, first the larger neighbours, then the others, so that
    every component becomes a star around its smallest node in a few rounds. Links are
    counted before they are shuffled again, and a node with very many neighbours only
    meets their minimum. Rounds go on until every component is a star, however many they take.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = staging.stage(edges.distinct(), "links")
    for step in count():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(lowest, "u")
        small = joined.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(joined.select("u", F.col("low").alias("v"))).distinct()
        after = staging.stage(small, f"links-{step}")
        # A star: nobody who has a smaller neighbour is that of another.
        unfinished = after.join(after.select(F.col("u").alias("v")), "v", "left_semi")
        twice = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        staging.discard(f"links-{step - 1}" if step else "links")
        edges = after
        if unfinished.isEmpty() and twice.isEmpty():
            found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            found = staging.stage(found.unionByName(roots.distinct()), "components")
            staging.discard(f"links-{step}")
            return found
