"""Connected components of a table of links, without bringing links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.session import discard, materialize


def connected_components(links: DataFrame, source: str = "a", target: str = "b", rounds: int = 60) -> DataFrame:
    """Rows (node, component) of all nodes with a link, component being the smallest node reachable.

    Large-star and small-star steps in turn: each node hangs its larger, then its smaller neighbours
    below the smallest one it knows, until only stars are left; the number of rounds grows with the
    logarithm of the longest path. A hub's links are summed up per task before the shuffle, and the
    join that hands its new root to them is one that Spark splits. Each round is a written table.
    Links to itself, null ends and repeated links count for nothing; no links give an empty table.
    """
    low, high = F.least(source, target), F.greatest(source, target)
    usable = F.col(source).isNotNull() & F.col(target).isNotNull() & (F.col(source) != F.col(target))
    edges = materialize(links.filter(usable).select(low.alias("v"), high.alias("u")).distinct(), "links")
    seen = _state(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        root = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(root, "u").filter(F.col("v") > F.col("u")).select(F.col("m").alias("v"), F.col("v").alias("u"))
        step = materialize(large.distinct(), "links")
        root = step.groupBy("u").agg(F.min("v").alias("m"))
        small = step.join(root, "u").filter(F.col("v") != F.col("m")).select(F.col("m").alias("v"), F.col("v").alias("u"))
        after = materialize(small.unionByName(root.select(F.col("m").alias("v"), "u")).distinct(), "links")
        now = _state(after)
        discard(step)
        discard(edges)
        edges = after
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("v", "u")
    return tuple(edges.agg(F.count("*"), F.sum(mark.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(mark, 32))).first())
