"""Connected components of links, by rounds of joins over distinct nodes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of all nodes that are linked to another one; ``links`` has two columns of longs.

    Each round every node takes the smallest root of its neighbours' roots, and roots are then followed one step
    further (pointer jumping), so long chains halve.  Rounds end when no label changes.  Each round is written to the
    shared folder; no step gathers a component, and sums are combined before they are shuffled.
    """
    sides = links.toDF("a", "b").filter("a <> b")
    edges = stored(sides.union(sides.select("b", "a")).distinct(), "links-edges")
    labels = stored(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "links-labels")
    while True:
        seen = edges.join(labels, edges.b == labels.node).select(F.col("a").alias("node"), "root")
        least = seen.union(labels).groupBy("node").agg(F.min("root").alias("root"))
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = least.join(up, "root", "left").select("node", F.least("root", "above").alias("root"))
        # a root that learns of a smaller one passes it on to all that point to it
        stepped = labels.select("node", F.col("root").alias("was")).join(step, "node")
        told = stepped.groupBy("was").agg(F.min("root").alias("new"))
        moved = stepped.join(told, "was").select("node", "was", F.least("root", "new").alias("root"))
        rounds = stored(moved, "links-labels")
        labels = rounds.select("node", "root")
        if rounds.filter("root <> was").isEmpty():
            return labels
