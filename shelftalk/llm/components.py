"""Connected components by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftalk.llm.common import by_merge
from shelftalk.sources.scratch import materialize


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and itself: the larger
    neighbours (``large``) or the smaller ones and the node."""
    both = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    met = both.join(by_merge(least), "u")
    if large:
        out = met.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = met.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return out.where("a < b").distinct()


def components(nodes: DataFrame, node: str, links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of every row of ``nodes``.

    ``links`` has columns ``a < b``. Each round is written to the shared folder, so it is
    never computed twice and a lost executor costs one round. Ends when no link changes: all
    links then lead to a root. The number of rounds grows with the logarithm of the longest
    path. Only a row count and a sum come to the driver.
    """
    current, before = materialize(links), None
    while True:
        sums = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        state = (sums["n"], sums["sum"])
        if state == before or not state[0]:
            break
        before = state
        current = materialize(_stars(_stars(current, True), False))
    roots = current.groupBy(F.col("b").alias(node)).agg(F.min("a").alias("_root"))
    return nodes.select(node).join(by_merge(roots), node, "left").select(
        node, F.coalesce("_root", node).alias("root")
    )
