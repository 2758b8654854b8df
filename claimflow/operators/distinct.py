"""Distinct counts that add up: a sketch of the keys of every group, kept as a stage, united and intersected later.

Counting the different claims of three months needs the claims again; uniting three sketches does not. A sketch
holds at most 2 ** ENTRIES hashes, so a group's size does not matter. Counts below that are exact; above it the
standard error is `error()` of the united group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRIES = 14  # binary digits of the number of hashes a sketch holds


def error(entries: int = ENTRIES) -> float:
    """Standard error of a count, relative to the count; of an intersection, relative to the union of its sides."""
    return 2.0 ** (-entries / 2)


def sketches(rows: DataFrame, groups: Sequence[str], key: str, entries: int = ENTRIES) -> DataFrame:
    """One sketch of the different keys per group; NULL keys do not count."""
    text = F.col(key).cast("string")
    return rows.groupBy(*groups).agg(F.theta_sketch_agg(text, entries).alias("sketch"))


def unite(kept: DataFrame, groups: Sequence[str], entries: int = ENTRIES) -> DataFrame:
    """Sketches of coarser groups: the same as those of all their rows."""
    return kept.groupBy(*groups).agg(F.theta_union_agg("sketch", entries).alias("sketch"))


def counted(kept: DataFrame, name: str = "n") -> DataFrame:
    return kept.withColumn(name, F.theta_sketch_estimate("sketch")).drop("sketch")


def shared(a: DataFrame, b: DataFrame, on: Sequence[str], name: str = "n_shared") -> DataFrame:
    """How many keys the groups of two tables of sketches have in common, for the groups that both have."""
    other = b.select(*on, F.col("sketch").alias("__other"))
    return a.join(other, list(on)).select(*on, F.theta_sketch_estimate(F.theta_intersection("sketch", "__other")).alias(name))
