"""Connected components of links between numbered nodes, as Spark jobs.

Alternates the large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each node links its larger
neighbours, then its smaller ones, to the smallest it knows, until every node
hangs on the smallest of its component.  The number of links never grows, and
each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import stored


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b) but the roots.

    The root is the smallest node of the component; loops and repeated links
    don't matter; null ends are not linked.
    """
    pairs = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    pairs = stored(pairs.filter("node > root").distinct(), label)
    mark = _mark(pairs)
    while mark[0]:
        large = _star(pairs.union(pairs.select(F.col("root").alias("node"),
                                               F.col("node").alias("root"))), large=True)
        pairs = stored(_star(large, large=False), label)
        mark, last = _mark(pairs), mark
        if mark == last:
            break
    return pairs


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node to the least of them and the node itself."""
    least = pairs.groupBy("node").agg(F.min("root").alias("low"))
    least = least.withColumn("low", F.least("low", "node"))
    met = pairs.join(least, "node")
    if large:
        out = met.filter("root > node").select(F.col("root").alias("node"), F.col("low").alias("root"))
    else:
        out = met.select(F.col("root").alias("node"), F.col("low").alias("root")).filter("node > root")
        out = out.union(least.select("node", F.col("low").alias("root")).filter("node > root"))
    return out.filter("node > root").distinct()


def _mark(pairs: DataFrame) -> tuple:
    """Number and fingerprint of the links: equal marks mean an unchanged set."""
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")),
                    F.bit_xor(F.xxhash64("root", "node"))).head()
    return tuple(row)
