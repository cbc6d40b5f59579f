"""Connected components of a table of links, without bringing links or labels to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the least node around: those above it (large star), or it and those below it (small star)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    out = both.join(least, "u")
    moved = out.where("v > u") if large else out
    hooked = moved.select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        hooked = hooked.unionByName(least.select("u", F.col("low").alias("v")))
    return hooked.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v); the component is its least node.

    Large-star and small-star steps in turn until the links stay the same, which takes about log(n) steps; every step
    is a table in the shared folder, so a lost executor costs no more than the current step. Links with a null end and
    links of a node to itself say nothing and are left out; without links the result is empty.
    """
    current = stage_table(
        edges.select("u", "v").where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        current = stage_table(_star(stage_table(_star(current, large=True), "links"), large=False), "links")
