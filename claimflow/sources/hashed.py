"""Stages laid out by the hash of their key, with a tree of checksums by which two of them are compared.

A row lies in the folder of its bucket. Beside the rows lies a small table: for every bucket the number of rows and two
checksums that do not depend on their order, and the same for every group of FAN buckets, up to one for all. Two
stages are compared from the top down, and only the buckets whose checksums differ are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from claimflow.sources.tables import new_path, save_stage

FAN = 16
LEVELS = 3  # below the top: FAN ** LEVELS buckets
BUCKET = "__bucket"
TREE = "level int, node int, n long, sum decimal(38,0), mix long"
SECOND = "claimflow"  # told into the second checksum, which is then independent of the first


@dataclass(frozen=True)
class HashedStage:
    """A written stage: its rows by bucket and its tree of checksums."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: StructType
    levels: int

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c != BUCKET]

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; the folders of others are not read."""
        df = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        df = df if buckets is None else df.where(F.col(BUCKET).isin([int(b) for b in buckets]))
        return df.select(*self.columns)

    def tree(self) -> DataFrame:
        """level (0 is the top), node, n, sum, mix."""
        return self.spark.read.schema(TREE).parquet(f"{self.path}/tree")


def bucket_of(keys: Sequence[str], levels: int = LEVELS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FAN**levels)).cast("int")


def _content(columns: Sequence[str], *told: Column) -> Column:
    """Hash of a row's values; NULLs are told apart by their places."""
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(nulls, *columns, *told)


def checksums(rows: DataFrame, columns: Sequence[str], node: Column) -> DataFrame:
    """Per node the number of rows and two checksums: copies count in the sum, and the mix tells sums apart that meet."""
    first, second = _content(columns), _content(columns, F.lit(SECOND))
    return rows.groupBy(node.alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(first.cast("decimal(38,0)")).alias("sum"), F.bit_xor(second).alias("mix")
    )


def save_hashed(df: DataFrame, name: str, keys: Sequence[str], levels: int = LEVELS) -> HashedStage:
    """Write `df` by the bucket of its keys and the tree of checksums over it. Columns are compared by name, in order of it."""
    spark, path, columns = df.sparkSession, new_path(df.sparkSession, name), sorted(df.columns)
    placed = df.select(*columns, bucket_of(keys, levels).alias(BUCKET))
    # by bucket, but a heavy bucket is split over several tasks
    written = save_stage(placed.hint("rebalance", BUCKET), f"{path}/rows", [BUCKET])
    leaves = save_stage(checksums(written, columns, F.col(BUCKET)), f"{path}/leaves")
    tree = leaves.select(F.lit(levels).alias("level"), "node", "n", "sum", "mix")
    for level in range(levels):
        above = leaves.groupBy(F.expr(f"node div {FAN ** (levels - level)}").cast("int").alias("node"))
        added = above.agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,0)").alias("sum"), F.bit_xor("mix").alias("mix"))
        tree = tree.unionByName(added.select(F.lit(level).alias("level"), "node", "n", "sum", "mix"))
    save_stage(tree, f"{path}/tree")
    return HashedStage(spark, path, tuple(keys), placed.schema, levels)


def differing(a: HashedStage, b: HashedStage) -> list[int]:
    """The buckets whose rows differ, found from the top down: below nodes that agree nothing is compared.

    At most FAN ** levels numbers come to the driver, whatever the size of the stages.
    """
    if (a.keys, a.levels, a.schema.simpleString()) != (b.keys, b.levels, b.schema.simpleString()):
        raise ValueError("only stages of the same keys, columns and levels can be compared")
    left, right, nodes = a.tree(), b.tree(), [0]
    for level in range(a.levels + 1):
        parts = [t.where((F.col("level") == level) & F.col("node").isin(nodes)).drop("level") for t in (left, right)]
        met = parts[0].join(parts[1].withColumnsRenamed({c: f"{c}_b" for c in ("n", "sum", "mix")}), "node", "full")
        same = F.lit(True)
        for c in ("n", "sum", "mix"):
            same = same & F.col(c).eqNullSafe(F.col(f"{c}_b"))
        unequal = sorted(r["node"] for r in met.where(~same).select("node").collect())
        if level == a.levels or not unequal:
            return unequal
        nodes = [n * FAN + k for n in unequal for k in range(FAN)]
    return []
