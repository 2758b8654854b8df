"""Mergeable summaries of amounts: counted buckets of a known relative width, from which quantiles are read.

An amount falls into a bucket by its leading binary digits, so a bucket is narrower than 2 ** -BITS of what it holds, and
the same amounts give the same buckets however they are split. Summaries of months and segments are kept as rows;
any set of them is merged by adding up. The number of buckets of a key is bounded by the digits of an amount, not
by its claims.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 10  # leading digits after the first that tell buckets apart: an error below 0.1 percent


def cents(amount: str | Column) -> Column:
    """A decimal amount in whole cents."""
    a = F.col(amount) if isinstance(amount, str) else amount
    return (a.cast("decimal(17,2)") * 100).cast("long")


def bucket(value: Column, bits: int = BITS) -> Column:
    """The bucket of a whole number: its sign, its number of binary digits and the leading ones of these, as one number.

    Buckets are ordered as the values. Values of up to bits + 1 digits have a bucket each.
    """
    size = F.abs(value)
    digits = F.when(size == 0, F.lit(0)).otherwise(F.length(F.bin(size)))
    dropped = F.greatest(digits - (bits + 1), F.lit(0))
    # shiftright takes its distance from a column only in SQL
    leading = F.call_function("shiftright", size, dropped)
    place = (dropped.cast("long") * (1 << (bits + 1))) + leading
    return F.when(value < 0, -place).otherwise(place)


def summarise(rows: DataFrame, keys: Sequence[str], amount: str, bits: int = BITS) -> DataFrame:
    """Per key and bucket: how many amounts it holds, the least, the largest and their sum, in cents; NULL amounts are left out."""
    valued = rows.where(F.col(amount).isNotNull()).select(*keys, cents(amount).alias("cents"))
    return valued.groupBy(*keys, bucket(F.col("cents"), bits).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("cents").alias("low"),
        F.max("cents").alias("high"),
        F.sum(F.col("cents").cast("decimal(38,0)")).alias("total"),
    )


def merge(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries added up to coarser keys: the same as a summary of all their rows."""
    return summaries.groupBy(*keys, "bucket").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").cast("decimal(38,0)").alias("total")
    )


def trailing(summaries: DataFrame, month: str, keys: Sequence[str], months: int) -> DataFrame:
    """For every month and key the merged summaries of the `months` months before it.

    A month's buckets are given to the months that follow it; months up to the last one that the summaries know.
    """
    last = summaries.agg(F.max(month).alias("__last"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(months)))
    each = summaries.withColumn("__ahead", ahead).withColumn(month, F.add_months(F.col(month), F.col("__ahead")))
    known = each.join(last, F.col(month) <= F.col("__last"))  # `last` is one row
    return merge(known, [month, *keys])


def quantiles(summaries: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Per key and share: the number of amounts and the quantile, read from merged summaries.

    The quantile is the smallest amount that at least a `share` of the amounts do not exceed. The answer is the largest
    amount of the bucket that holds it: never below it, and above it by less than 2 ** -BITS of it.
    """
    whole = Window.partitionBy(*keys)
    up_to = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = summaries.withColumns({"__upto": F.sum("n").over(up_to), "__all": F.sum("n").over(whole)})
    asked = placed.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    place = F.greatest(F.ceil(F.round(F.col("share") * F.col("__all"), 6)), F.lit(1))
    found = asked.where((F.col("__upto") - F.col("n") < place) & (place <= F.col("__upto")))
    return found.select(
        *keys, "share", F.col("__all").alias("n"), (F.col("high") / F.lit(100)).cast("decimal(15,2)").alias("amount")
    )


def cut_points(summaries: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """Per key the quantiles of ascending shares as the columns cut_1, cut_2, ..."""
    cuts = quantiles(summaries, keys, shares)
    columns = [F.max(F.when(F.col("share") == float(s), F.col("amount"))).alias(f"cut_{k}") for k, s in enumerate(shares, 1)]
    return cuts.groupBy(*keys).agg(*columns)
