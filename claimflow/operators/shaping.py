"""Projection and schema shaping: contracts, renames, casts, profiles of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.expressions import blank_to_null, is_missing, money_or_zero, parse_date, parse_money


@dataclass(frozen=True)
class Field:
    """How one source column enters the analysis schema.

    `kind`: text, date, money (missing stays NULL), money0 (missing becomes 0) or int.
    `fmt`: the date pattern, for dates only.
    """

    source: str
    target: str
    kind: str = "text"
    fmt: str | None = None

    def parsed(self) -> Column:
        """The typed value, NULL where the text is missing or cannot be read."""
        c = F.col(self.source)
        if self.kind == "date":
            return parse_date(c, self.fmt or "yyyy-MM-dd")
        if self.kind in ("money", "money0"):
            return parse_money(c)
        if self.kind == "int":
            return blank_to_null(c).try_cast("int")
        if self.kind == "text":
            return c
        raise ValueError(f"unknown kind {self.kind!r}")

    def expression(self) -> Column:
        out = money_or_zero(F.col(self.source)) if self.kind == "money0" else self.parsed()
        return out.alias(self.target)


def project(df: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """Prune, rename, parse and re-type in one projection, so the scan reads only what the contract names."""
    return df.select(*[f.expression() for f in contract])


def fields_for(contract: Sequence[Field], targets: Sequence[str]) -> tuple[Field, ...]:
    """The part of a contract that feeds the given target columns."""
    return tuple(f for f in contract if f.target in targets)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Re-type; values that do not fit become NULL instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def add_empty(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def with_row_index(df: DataFrame, columns: Sequence[str] | None = None, name: str = "row_index") -> DataFrame:
    """A stable tie-break for sources without a row key: a hash of the row's own content.

    It does not depend on partitioning or on a rerun and needs no shuffle. The hash skips NULLs, so whether a
    column is NULL is hashed as well: rows that share the index are identical in the given columns (or collide in
    64 bits), so choosing between them does not change a result.
    """
    parts = [x for c in (columns or df.columns) for x in (F.col(c).isNull(), F.col(c))]
    return df.withColumn(name, F.xxhash64(*parts))


def zero_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: its largest absolute value and whether the column is all zero."""
    wide = df.agg(*[F.max(F.abs(F.col(c))).cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "max_abs").withColumn(
        "all_zero", F.coalesce(F.col("max_abs"), F.lit(0.0)) == 0
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def max_length(df: DataFrame, column: str) -> DataFrame:
    """Longest value of a text column in bytes."""
    return df.agg(F.max(F.octet_length(column)).alias("max_bytes"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def profile(df: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per column: position, type, rows, nulls, missing markers, longest text; optionally approximate distincts.

    All columns are measured in one aggregate, then turned into rows.
    """
    metrics: list[Column] = []
    for c in df.columns:
        text = F.col(c).cast("string")
        metrics += [
            F.count_if(F.col(c).isNull()).alias(f"{c}|nulls"),
            F.count_if(is_missing(c) & F.col(c).isNotNull()).alias(f"{c}|markers"),
            F.max(F.octet_length(text)).cast("long").alias(f"{c}|max_bytes"),
        ]
        if distinct:
            metrics.append(F.approx_count_distinct(c).alias(f"{c}|approx_distinct"))
    names = ["nulls", "markers", "max_bytes"] + (["approx_distinct"] if distinct else [])
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *metrics)
    per_column = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            *[F.col(f"`{f.name}|{m}`").alias(m) for m in names],
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return wide.select(F.explode(F.array(*per_column)).alias("p")).select("p.*")


def distinct_counts(sources: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per source: rows and distinct values of each key, for all sources in one job."""
    tagged = [df.select(F.lit(name).alias("source"), *keys) for name, df in sources.items()]
    rows = reduce(lambda x, y: x.unionByName(y), tagged)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_distinct(k).alias(f"distinct_{k}") for k in keys]
    )


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns of two sources side by side: where each is present, its types and missing counts."""
    left, right = (
        profile(x).select(
            "column_name",
            F.col("type").alias(f"type_{side}"),
            (F.col("nulls") + F.col("markers")).alias(f"missing_{side}"),
        )
        for x, side in ((a, "a"), (b, "b"))
    )
    joined = left.join(right, "column_name", "full")
    return joined.withColumn(
        "presence",
        F.when(F.col("type_b").isNull(), "only a").when(F.col("type_a").isNull(), "only b").otherwise("both"),
    )
