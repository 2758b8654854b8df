"""Key-set filters, comparisons, updates and deletes between tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.skew import join_facts


def keys_of(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys without NULLs, combined on the map side."""
    out = df.select(*on)
    for c in on:
        out = out.where(F.col(c).isNotNull())
    return out.distinct()


def rows_of(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """All rows of `df` whose key occurs in `keys`; never multiplies rows."""
    return join_facts(df, keys_of(keys, on), on, "left_semi")


present_in = rows_of


def keys_only_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys of `df` that do not occur in `other`: distinct on both sides, so a plain join reuses their partitioning."""
    return keys_of(df, on).join(keys_of(other, on), list(on), "left_anti")


def missing_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `other`.

    NULL keys in `other` are ignored, so unlike `NOT IN` one of them does not empty the result.
    """
    return join_facts(df, keys_of(other, on), on, "left_anti")


def compare(a: DataFrame, b: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Matched rows of `a` with the columns of `b` next to them, suffixed `_other`. `b` has one row per key."""
    other = b.select(*on, *[F.col(c).alias(f"{c}_other") for c in columns])
    return join_facts(a, other, on, "inner")


def unique_source(df: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`df` reduced to its key and columns; a key with several rows fails the job while it runs."""
    checked = df.groupBy(*on).agg(
        F.count(F.lit(1)).alias("__n"), *[F.max(F.struct(c)).alias(f"__{c}") for c in columns]
    )
    fail = F.raise_error(F.lit(f"update source has several rows for one key {list(on)}"))
    checked = checked.where(F.when(F.col("__n") > 1, fail.cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*on, *[F.col(f"__{c}.{c}").alias(c) for c in columns])


def update_from(
    a: DataFrame,
    b: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    guard: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """Overwrite `columns` of `a` with those of the matching row of `b`, where `guard` (on `a`) holds.

    Set `unique=True` when `b` is one row per key by construction, which saves the check.
    """
    source = b.select(*on, *columns) if unique else unique_source(b, on, columns)
    source = source.select(
        *on, F.lit(True).alias("__matched"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    take = F.coalesce(F.col("__matched"), F.lit(False))
    if guard is not None:
        take = take & F.coalesce(guard, F.lit(False))
    joined = join_facts(a, source, on, "left").withColumn("__take", take)
    out = joined.withColumns(
        {c: F.when(F.col("__take"), F.col(f"__new_{c}")).otherwise(F.col(c)) for c in columns}
    )
    return out.select(*a.columns)


def set_where_in(
    df: DataFrame, keys: DataFrame, on: Sequence[str], values: Mapping[str, Column], guard: Column | None = None
) -> DataFrame:
    """Set columns on rows whose key is in `keys` and where `guard` holds."""
    flagged = join_facts(df, keys_of(keys, on).withColumn("__hit", F.lit(True)), on, "left")
    take = F.coalesce(F.col("__hit"), F.lit(False))
    if guard is not None:
        take = take & F.coalesce(guard, F.lit(False))
    flagged = flagged.withColumn("__take", take)
    return flagged.withColumns(
        {c: F.when(F.col("__take"), v).otherwise(F.col(c)) for c, v in values.items()}
    ).select(*df.columns)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where the predicate is true; rows where it is unknown stay, as in SQL DELETE."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_matching(df: DataFrame, other: DataFrame, on: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """Drop rows whose key is in `other` (and where `predicate` on the row is true)."""
    if predicate is None:
        return missing_in(df, other, on)
    flagged = join_facts(df, keys_of(other, on).withColumn("__hit", F.lit(True)), on, "left")
    doomed = F.coalesce(F.col("__hit"), F.lit(False)) & F.coalesce(predicate, F.lit(False))
    return flagged.where(~doomed).drop("__hit")


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def drill_through(df: DataFrame, keys: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Full history of the given keys, sorted. The sort is range-partitioned on all order columns."""
    return rows_of(df, keys, on).orderBy(*order)


def month_pairs(df: DataFrame, start: str, end: str, *measures: Column) -> DataFrame:
    """Collapse intervals to one row per (first month, last month).

    The number of rows is bounded by the calendar, not by the data, so whatever follows is cheap.
    """
    return (
        df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
        .groupBy(F.trunc(start, "MM").alias("first_month"), F.trunc(end, "MM").alias("last_month"))
        .agg(*measures)
    )


def expand_months(
    df: DataFrame,
    first: str,
    last: str,
    month: str = "calendar_month",
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """One row per month touched by [first, last]: the range join with the calendar as an explode.

    `since` and `until` bound the months before they are spread, so a mistyped year makes no extra rows.
    """
    begin, end = F.trunc(first, "MM"), F.trunc(last, "MM")
    if since is not None:
        begin = F.greatest(begin, F.trunc(F.lit(since).cast("date"), "MM"))
    if until is not None:
        end = F.least(end, F.trunc(F.lit(until).cast("date"), "MM"))
    valid = df.where((F.col(first) <= F.col(last)) & (begin <= end))
    return valid.withColumn(month, F.explode(F.sequence(begin, end, F.expr("interval 1 month"))))
