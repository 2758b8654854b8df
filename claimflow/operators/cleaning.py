"""Cleaning of text-typed source tables: missing markers, money, dates, categories, keyed corrections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.expressions import (
    any_phrase,
    blank_to_null,
    is_missing,
    map_value,
    members_to_group,
    money_or_zero,
    parse_money,
)
from claimflow.functions.vocabulary import NET_SHARE
from claimflow.operators.skew import join_facts


def rows_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns is missing."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | is_missing(c)
    return df.where(hit)


def null_if_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(c) for c in columns})


def zero_if_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each amount on its own: missing -> 0."""
    return df.withColumns({c: money_or_zero(c) for c in columns})


def zero_if_any_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Amounts that only mean something together: if one is missing, all become 0."""
    amounts = [parse_money(c) for c in columns]
    broken = F.lit(False)
    for c, amount in zip(columns, amounts):
        broken = broken | is_missing(c) | amount.isNull()
    zero = F.lit(0).cast("decimal(15,2)")
    return df.withColumns({c: F.when(broken, zero).otherwise(amount) for c, amount in zip(columns, amounts)})


def label_if_missing(df: DataFrame, column: str, label: str) -> DataFrame:
    return df.withColumn(column, F.when(is_missing(column), F.lit(label)).otherwise(F.col(column)))


def fill_from(df: DataFrame, target: str, source: str, when: Column | None = None) -> DataFrame:
    """Take `source` where `target` is missing, or where `when` holds."""
    condition = is_missing(target) if when is None else when
    return df.withColumn(target, F.when(condition, F.col(source)).otherwise(F.col(target)))


def apply_patches(df: DataFrame, patches: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite single cells: `patches` holds (key, column_name, new_value) with one value per cell.

    The patch list may be long, so nothing is broadcast by force; two values for one cell fail the job.
    """
    one_value = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("several patch values for one cell")).cast("string")
    ).otherwise(F.max("new_value"))
    cells = patches.groupBy(key, "column_name").agg(one_value.alias("new_value"))
    wide = cells.groupBy(key).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("new_value"))).alias(f"__patch_{c}") for c in columns]
    )
    types = dict(df.dtypes)
    joined = join_facts(df, wide, [key], "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(f"__patch_{c}").try_cast(types[c]), F.col(c)) for c in columns}
    ).drop(*[f"__patch_{c}" for c in columns])


def translate(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, str],
    unmatched: str | None = None,
    keep: bool = False,
    output: str | None = None,
) -> DataFrame:
    return df.withColumn(output or column, map_value(column, mapping, unmatched, keep))


def rollup_category(
    df: DataFrame,
    column: str,
    groups: Mapping[str, Iterable[str]],
    unmatched: str | None = None,
    keep: bool = False,
    output: str | None = None,
) -> DataFrame:
    return translate(df, column, members_to_group(groups), unmatched, keep, output)


def derive_total_cost(df: DataFrame, copay: str, deductible: str, total: str) -> DataFrame:
    """Missing copay and deductible become 0; a missing total becomes their sum."""
    a, b = money_or_zero(copay), money_or_zero(deductible)
    filled = F.coalesce(parse_money(total), (a + b).cast("decimal(15,2)"))
    return df.withColumns({copay: a, deductible: b, total: filled})


def gross_up(net: str | Column) -> Column:
    """Estimate before tax from a net compensation, rounded half up to whole units."""
    net = F.col(net) if isinstance(net, str) else net
    return F.round(net * 100 / F.lit(NET_SHARE).cast("decimal(6,4)"), 0).cast("decimal(15,2)")


def default_usage(
    df: DataFrame, usage: str, customer_type: str, business: str, commercial: str, private: str
) -> DataFrame:
    """Vehicle use where it is missing: commercial for business customers, private otherwise."""
    default = F.when(F.col(customer_type) == business, F.lit(commercial)).otherwise(F.lit(private))
    return df.withColumn(usage, F.when(is_missing(usage), default).otherwise(F.col(usage)))


def repair_order(df: DataFrame, target: str, upper: str, replacement: str) -> DataFrame:
    """A date that lies after `upper` cannot be right and is replaced."""
    return df.withColumn(
        target, F.when(F.col(target) > F.col(upper), F.col(replacement)).otherwise(F.col(target))
    )


def match_keywords(df: DataFrame, text: str, phrases: Sequence[str], output: str = "matched") -> DataFrame:
    return df.withColumn(output, any_phrase(text, phrases))
