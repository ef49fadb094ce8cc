"""Connected components of links, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.sources import scratch


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; nodes of one component share their smallest node as root.

    Each round sends a node to its first neighbour or itself, by number or, every second round, by a hash of
    the round, and contracts the links to the images; loops vanish, so chains as well as stars shrink fast.
    Rounds are written tables. Nothing but a test for emptiness reaches the driver.
    """
    edges = scratch.materialise(links.where("a != b").select("a", "b").distinct(), "links")
    found, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if turn % 2 == 0:
            step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("root"), F.least("a", "b").alias("next"))
        else:
            first = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), "b"))
            own = F.struct(F.xxhash64("root", F.lit(turn)).alias("h"), F.col("root").alias("b"))
            step = both.groupBy(F.col("a").alias("root")).agg(first.alias("first")).select("root", F.least("first", own)["b"].alias("next"))
        step = scratch.materialise(step, "step")
        if found is None:
            found = step.select(F.col("root").alias("node"), F.col("next").alias("root"))
        else:
            found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        found = scratch.materialise(found, "roots")
        ends = edges.join(step.toDF("a", "na"), "a").join(step.toDF("b", "nb"), "b").where("na != nb")
        edges = scratch.materialise(ends.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(), "links")
        turn += 1
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    smallest = found.groupBy("root").agg(F.min("node").alias("least"))
    return found.join(smallest, "root").select("node", F.col("least").alias("root"))
