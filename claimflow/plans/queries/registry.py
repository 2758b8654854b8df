"""Registered queries: each name maps to a DataFrame builder and, where SQL can say it, to equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.session import compiled

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Result columns in types both engines print alike: dates as text, decimals as doubles, flags as 0/1."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            compiled(spark)
            return present(fn(spark, sf))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
