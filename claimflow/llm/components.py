"""Connected components by alternating stars, each round a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import save


def _fingerprint(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b longs): root is the smallest node it can reach.

    Large star: a node's larger neighbours are linked to its smallest one. Small star: its smaller neighbours
    are. Both keep the components and end in one star for each. The smallest neighbours are written before they
    are joined back, so a centre with very many links is split by adaptive execution and never meets in one task.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = save(links.where(F.col("a") != F.col("b")).select(a.alias("a"), b.alias("b")).distinct(), "links")
    before = _fingerprint(links)
    while before[0]:
        ends = links.select(F.col("b").alias("node"), "b").unionByName(
            links.select(F.col("a").alias("node"), "b")
        )
        low = save(ends.groupBy("node").agg(F.min("b").alias("low")), "links-low")
        centred = links.join(low, links["b"] == low["node"]).select("a", F.col("low").alias("b")).distinct()
        centred = save(centred, "links-large")
        low = save(centred.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "links-low")
        met = centred.join(low, centred["a"] == low["node"])
        small = met.select("a", F.col("low").alias("b")).unionByName(
            met.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        links = save(small.distinct(), "links-small")
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
