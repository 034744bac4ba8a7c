"""Connected components of a graph of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import written


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """node, root for every node of links (a, b): root is the smallest node that it reaches.

    Each round takes, for every node, the smallest root among its neighbours',
    and then the root of that root, so long chains shrink by powers. Minima are
    taken in each task before the shuffle; joins on hot nodes are one large
    side against one row, which adaptive execution splits. Rounds are written
    tables; they end when a round changes nothing.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct(), label)
    roots = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), label)
    while True:
        seen = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("near"))
        nearer = roots.join(seen, roots.node == seen.a).select("node", F.least("root", "near").alias("to"), "root")
        up = roots.select(F.col("node").alias("to"), F.col("root").alias("above"))
        after = nearer.join(up, "to").select("node", F.least("to", "above").alias("root"), (F.least("to", "above") < F.col("root")).alias("moved"))
        after = written(after, label)
        roots = after.select("node", "root")
        if after.filter("moved").isEmpty():
            return roots
