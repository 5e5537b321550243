"""Connected components of a table of links, by alternating star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.llm.common import written

MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node next to ``u``: the larger ones (large) or the smaller ones."""
    if large:
        around = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    seen = around.join(least, "u")
    if large:
        out = seen.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = seen.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.where("u <> m").select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node of ``links`` (u, v: longs).

    Each round joins nodes with the minimum of their neighbourhood, which is combined before the shuffle, so
    a node with very many links is never collected. Rounds end when the links no longer change; a count and a
    checksum tell that on the driver.
    """
    links = written(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    for _ in range(MOST_ROUNDS):
        links = written(_star(_star(links, True), False), "links")
        now = tuple(links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
