"""Choosing rows within a key: first, last, best, latest date, duplicates.

`pick` keeps one row per key. Spark filters `row_number() = 1` on the map side first
(WindowGroupLimit), so a key sends at most one row per input partition, however many rows it has.
Choices that keep ties or whole groups go through per-key facts instead of a window, because a
window would gather the group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.operators.skew import join_facts, with_facts

_RN = "__rn"


def pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], where: Column | None = None) -> DataFrame:
    """The first row per key under a total order (end it with a unique or content-hash column)."""
    rows = df if where is None else df.where(where)
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def first_per(df: DataFrame, keys: Sequence[str], date: str, index: str, where: Column | None = None) -> DataFrame:
    return pick(df, keys, [F.asc(date), F.asc(index)], where)


def last_per(df: DataFrame, keys: Sequence[str], date: str, index: str, where: Column | None = None) -> DataFrame:
    return pick(df, keys, [F.desc(date), F.desc(index)], where)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows equal in `keys` are copies; the first one under `order` stays."""
    return pick(df, keys, order)


def best_per(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Rows ranked first by several measures, highest first; all tied rows stay.

    `measures` are ordering expressions where larger is better.
    """
    scored = df.withColumn("__score", F.struct(*[m.alias(f"m{i}") for i, m in enumerate(measures)]))
    best = scored.groupBy(*keys).agg(F.max("__score").alias("__best"))
    kept = join_facts(scored, best, keys, "inner", null_safe=True)
    return kept.where(F.col("__score") == F.col("__best")).drop("__score", "__best")


def at_latest(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows at the latest date of their key; all rows of that date stay."""
    dated = with_facts(df, keys, __latest=F.max(date))
    return dated.where(F.col(date) == F.col("__latest")).drop("__latest")


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the keys that have more than one row."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).drop("__n")
    return join_facts(df, several, keys, "left_semi", null_safe=True)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each group, with the size of the group in `group_size`, from one aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    groups = df.groupBy(*keys).agg(
        F.max(F.struct(*order, *rest)).alias("__last"), F.count(F.lit(1)).alias("group_size")
    )
    return groups.select(
        *[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns], "group_size"
    )
