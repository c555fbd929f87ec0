"""Connected components of links between numbered rows, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonetape.llm.common import discard, written


def star(links: DataFrame, large: bool) -> DataFrame:
    """Points the neighbours of each a that are larger (or smaller and a itself) to its least neighbour."""
    # Written first: the sides of the join are then dealt anew, and a hub's links can be split.
    least = written(links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
    moved = links.join(least, "a").where(F.col("b") > F.col("a") if large else F.col("b") != F.col("least"))
    out = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every row in links (a, b), the component being its smallest row.

    Each round halves the distance to the smallest row; the links of every round are
    written, and only their number and a checksum come to the driver."""
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, seen = written(down, "links"), None
    while True:
        mark = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
        if mark == seen or not mark[0]:
            break
        seen = mark
        raised = written(star(both(current), True), "large")
        lowered = written(star(raised, False), "small")
        discard(current, raised)
        current = lowered
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
