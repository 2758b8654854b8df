"""Joins between many rows and one row per key that stay balanced when a key holds a large share of the rows.

A window over the key sends all rows of a key to one task. Here the rows are first reduced to per-key
facts (a hash aggregate, combined on the map side), and the facts are joined back by a plain equi join.
Adaptive execution splits a heavy key's rows over several tasks while the join runs, by what it has
measured; nothing is sampled, capped or salted beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOINS = ("left", "inner", "left_semi", "left_anti")  # adaptive execution can split the rows of all of these


def _shuffled_again(facts: DataFrame, on: Sequence[str]) -> DataFrame:
    """`facts` with their keys passed through an expression, so that the join shuffles them.

    Facts are mostly an aggregate on the key and would keep its partitioning. Then only the rows would come
    out of a shuffle, and adaptive execution splits a heavy key only where both sides do. Facts are one row
    per key, so their shuffle is small beside that of the rows.
    """
    return facts.withColumns({c: F.element_at(F.array(c), 1) for c in on})


def join_facts(
    rows: DataFrame, facts: DataFrame, on: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join `rows` with `facts` on the columns `on`; `facts` holds one row per key and `how` keeps `rows` on the left.

    `null_safe` lets NULL keys meet, for facts grouped from the rows themselves; otherwise they match nothing.
    """
    if how not in JOINS:
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    right = _shuffled_again(facts, on)
    if not null_safe:
        return rows.join(right, on, how)
    right = right.withColumnsRenamed({c: f"__right_{c}" for c in on})
    met = F.lit(True)
    for c in on:
        met = met & F.col(c).eqNullSafe(F.col(f"__right_{c}"))
    return rows.join(right, met, how).drop(*[f"__right_{c}" for c in on])


def with_facts(rows: DataFrame, on: Sequence[str], where: Column | None = None, **facts: Column) -> DataFrame:
    """Add per-key aggregates to every row: what `agg(...) OVER (PARTITION BY key)` returns.

    `where` restricts the rows the aggregates look at; keys without such rows get NULL.
    """
    source = rows if where is None else rows.where(where)
    keyed = source.groupBy(*on).agg(*[c.alias(name) for name, c in facts.items()])
    return join_facts(rows, keyed, on, "left" if where is not None else "inner", null_safe=True)
