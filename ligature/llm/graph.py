"""Connected components of a graph given as a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of a node are linked to the smallest of it and its neighbours. Small star: the
    node and its smaller neighbours are linked to the smallest one."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:  # one row for each link at most; the small star that follows makes rows distinct
        return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
    out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node that can be reached.

    Loops and repeated links change nothing; without links the table is empty. Each round is written to the shared
    folder; the driver sees only counts and sums.
    """
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    now = common.stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    seen = state(now)
    while seen[0]:
        before = now
        now = common.stage(_star(_star(now, True), False), "links")
        found = state(now)
        common.discard(before)
        if found == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select("b", "b").distinct().toDF("node", "component"))
