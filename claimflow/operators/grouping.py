"""Aggregations per key: duplicates, distinct-value tests, value lists, write-backs, monthly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.expressions import month_key
from claimflow.operators.skew import join_facts, with_facts


def duplicated_keys(df: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def having_distinct(df: DataFrame, keys: Sequence[str], column: str, test: Column) -> DataFrame:
    """Groups with their row count `n` and distinct-value count `n_distinct`, filtered by `test`.

    Built in two steps, so a large group is combined before it meets in one place.
    """
    per_value = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("copies"))
    return (
        per_value.groupBy(*keys)
        .agg(F.sum("copies").alias("n"), F.count(column).alias("n_distinct"))
        .where(test)
    )


def concat_distinct(df: DataFrame, keys: Sequence[str], column: str, sep: str = ", ", output: str = "values") -> DataFrame:
    """Sorted distinct values of a category per key as one text. NULLs are skipped."""
    per_value = df.where(F.col(column).isNotNull()).select(*keys, column).distinct()
    return per_value.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(column)), sep).alias(output))


def spelled(counts: Column, sep: str = ",") -> Column:
    """Text of a counted list [(value, copies)], every copy written out."""
    return F.array_join(
        F.flatten(F.transform(counts, lambda x: F.array_repeat(x["value"], x["copies"].cast("int")))), sep
    )


def concat_all(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    output: str = "values",
) -> DataFrame:
    """Sorted values per key with their copies, as an array of (value, copies), and their number `n_values`.

    Values are counted first, so a group never travels row by row. The column is meant to be a category: an array
    holds each of a key's values once. `spelled` turns it into text where a caller wants that.
    """
    per_value = (
        df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("copies"))
    )
    return per_value.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(column).alias("value"), "copies"))).alias(output),
        F.sum("copies").alias("n_values"),
    )


def sum_over(df: DataFrame, keys: Sequence[str], column: str, output: str | None = None) -> DataFrame:
    """The sum of the row's group written on each row."""
    total = with_facts(df, keys, __total=F.sum(column))
    return total.withColumn(output or column, F.col("__total")).drop("__total")


def monthly(df: DataFrame, date: str, *aggregates: Column, month: str = "calendar_month") -> DataFrame:
    return df.where(F.col(date).isNotNull()).groupBy(month_key(date).alias(month)).agg(*aggregates)


def impute_by_mode(df: DataFrame, key: str, column: str, missing: Column) -> DataFrame:
    """Fill a missing category with the most frequent one among rows of the same key (ties: first by name)."""
    counts = df.where(~missing).groupBy(key, column).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("rank"), F.col(column).alias("v"))).alias("m"))
    joined = join_facts(df, mode.select(key, F.col("m.v").alias("__mode")), [key], "left")
    return joined.withColumn(
        column, F.when(missing, F.coalesce(F.col("__mode"), F.col(column))).otherwise(F.col(column))
    ).drop("__mode")
