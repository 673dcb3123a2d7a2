"""Connected components of a graph of links, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appendlake.session import persist_counted, persist_table


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) of every linked node that is not its component's smallest.

    ``links`` has two integer columns, ``a`` and ``b``. Alternates the large-star and
    small-star steps of Kiveris et al. (2014): each step hangs the neighbours of a node
    on the smallest node known there, until only stars are left. A step is a minimum
    per node, which is combined before the shuffle, and a join with it. The minima are
    written first, so that a join with a hot node has two plain inputs and adaptive
    execution can split it or broadcast the smaller one. No links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small")).distinct()
    edges, seen = _kept(edges)
    while seen["n"]:
        both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).union(edges.select("small", "big"))
        low = persist_table(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "low")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("big"), F.col("m").alias("small")).distinct()
        large = persist_table(large, "large-star")
        low = persist_table(large.groupBy("big").agg(F.min("small").alias("m")), "low")
        hung = F.when(F.col("small") == F.col("m"), F.col("big")).otherwise(F.col("small"))
        star = large.join(low, "big").select(hung.alias("big"), F.col("m").alias("small")).distinct()
        edges, now = _kept(star)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("big").alias("node"), F.col("small").alias("root"))


def _kept(edges: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Written edges with a digest of the set, taken while writing."""
    digest = F.sum(F.pmod(F.xxhash64("big", "small"), F.lit(1_000_000_007)))
    return persist_counted(edges, "stars", n=F.count(F.lit(1)), digest=digest)
