"""Data-quality checks and reconciliation between sources. Every check is one pass over its rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.expressions import is_missing
from claimflow.operators.grouping import duplicated_keys
from claimflow.operators.shaping import Field
from claimflow.operators.relational import compare, keys_of
from claimflow.sources.hashed import HashedStage, differing

# Pairs of dates whose first must not lie after the second.
CLAIM_DATE_RULES = {
    "submitted after opened": ("claim_submitted_date", "claim_opened_date"),
    "accident after submitted": ("claim_accident_date", "claim_submitted_date"),
    "accident after opened": ("claim_accident_date", "claim_opened_date"),
    "accident after updated": ("claim_accident_date", "updateddate"),
}
SNAPSHOT_DATE_RULES = {"created after payment": ("createddate", "payment_date")}
POLICY_DATE_RULES = {"created after start": ("createddate", "start_date"), "start after end": ("start_date", "end_date")}


def violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """One row per broken rule: the kept columns and the rule's name. Unknown comparisons break nothing."""
    names = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return df.select(*keep, F.explode(F.array_compact(names)).alias("rule"))


def check_order(
    df: DataFrame, keep: Sequence[str], rules: Mapping[str, tuple[str, str]] = CLAIM_DATE_RULES
) -> DataFrame:
    return violations(df, {name: F.col(a) > F.col(b) for name, (a, b) in rules.items()}, keep)


def check_sum(df: DataFrame, parts: Sequence[str], total: str, output: str = "is_sum_correct") -> DataFrame:
    """Whether the parts add up to the total, as a column."""
    added = reduce(lambda x, y: x + y, [F.col(c) for c in parts])
    return df.withColumn(output, added == F.col(total))


def amount_rules() -> dict[str, Column]:
    """Rules between claim state and amounts in the snapshot."""
    status = F.col("claim_status")
    comp, total = F.col("compensation_total"), F.col("total_claim_estimate")
    return {
        "estimate without total": ((F.col("claim_estimate") != 0) | (F.col("claim_estimate_beforetax") != 0)) & (total == 0),
        "net compensation without total": (F.col("compensation_amount_beforetax") != 0) & (comp == 0),
        "settled without compensation": status.isin("paid out", "approved") & (comp == 0),
        "unsettled with compensation": ~status.isin("paid out", "approved") & (comp != 0),
        "zero estimate not cancelled": (total == 0) & (status != "cancelled"),
    }


def check_amounts(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return violations(df, amount_rules(), keep)


def check_future(df: DataFrame, date: str, as_of: Column | None = None, where: Column | None = None) -> DataFrame:
    """Rows dated after `as_of` (today by default)."""
    rows = df if where is None else df.where(where)
    return rows.where(F.col(date) > (F.current_date() if as_of is None else as_of))


def status_date_rules() -> dict[str, Column]:
    """Rules between a log row's state and the claim's dates."""
    name = F.col("claim_status_name")
    return {
        "submitted not dated as submitted": (name == "submitted") & (F.col("updateddate") != F.col("claim_submitted_date")),
        "assessment not dated as opened": (name == "assessment pending")
        & (F.col("updateddate") != F.col("claim_opened_date")),
        "decided without approval date": name.isin("denied", "approved", "cancelled")
        & F.col("claim_approved_date").isNull(),
        "paid without payment date": (name == "paid out") & F.col("payment_date").isNull(),
    }


def check_status_dates(log: DataFrame, keep: Sequence[str]) -> DataFrame:
    return violations(log, status_date_rules(), keep)


def paid_never_approved(log: DataFrame) -> DataFrame:
    """Claims with a paid-out row and no approved row, from one aggregate."""
    name = F.col("claim_status_name")
    return (
        log.groupBy("claimnumber")
        .agg(F.count_if(name == "paid out").alias("paid"), F.count_if(name == "approved").alias("approved"))
        .where((F.col("paid") > 0) & (F.col("approved") == 0))
        .select("claimnumber")
    )


def missing_report(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Per column: rows and distinct keys with a missing value, a row for every column, in one pass over the table."""
    per_key = df.groupBy(key).agg(*[F.count_if(is_missing(c)).alias(f"{c}|missing") for c in columns])
    wide = per_key.agg(
        *[F.coalesce(F.sum(f"`{c}|missing`"), F.lit(0)).alias(f"{c}|rows") for c in columns],
        *[F.count_if(F.col(f"`{c}|missing`") > 0).alias(f"{c}|keys") for c in columns],
    )
    each = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"`{c}|rows`").alias("missing_rows"), F.col(f"`{c}|keys`").alias("missing_keys")
        )
        for c in columns
    ]
    return wide.select(F.explode(F.array(*each)).alias("r")).select("r.*")


def milestone_coverage(facts: DataFrame, milestones: Sequence[str]) -> DataFrame:
    """Per milestone: claims that reached it and claims that did not. `facts` holds one row per claim."""
    wide = facts.agg(F.count(F.lit(1)).alias("claims"), *[F.count(c).alias(c) for c in milestones])
    each = [
        F.struct(
            F.lit(c).alias("milestone"), F.col(c).alias("with_date"), (F.col("claims") - F.col(c)).alias("without_date")
        )
        for c in milestones
    ]
    return wide.select(F.explode(F.array(*each)).alias("r")).select("r.*")


def unreadable_report(raw: DataFrame, contract: Sequence[Field]) -> DataFrame:
    """Per money, date and int column of a source: values that are entered, and those that cannot be read."""
    typed = [f for f in contract if f.kind != "text"]
    wide = raw.agg(
        *[F.count_if(~is_missing(f.source)).alias(f"{f.target}|entered") for f in typed],
        *[F.count_if(~is_missing(f.source) & f.parsed().isNull()).alias(f"{f.target}|unreadable") for f in typed],
    )
    each = [
        F.struct(
            F.lit(f.target).alias("column_name"),
            F.col(f"`{f.target}|entered`").alias("entered"),
            F.col(f"`{f.target}|unreadable`").alias("unreadable"),
        )
        for f in typed
    ]
    return wide.select(F.explode(F.array(*each)).alias("r")).select("r.*")


def reconcile_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Every key of either source and where it is found, as one aggregate instead of a full join."""
    tagged = a.select(key, F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(
        b.select(key, F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    both = tagged.groupBy(key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return both.select(
        key,
        F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "only a").otherwise("only b").alias("found"),
    )


def reconcile_values(a: DataFrame, b: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Matched rows in which any of the amounts differs; NULL differs from a value."""
    matched = compare(a, b, on, columns)
    differs = reduce(lambda x, y: x | y, [~F.col(c).eqNullSafe(F.col(f"{c}_other")) for c in columns])
    return matched.where(differs)


def unequal_rows(a: HashedStage, b: HashedStage) -> DataFrame:
    """Rows that the two stages do not hold equally often, with their copies in each (`copies_a`, `copies_b`).

    Only the buckets whose checksums differ are read. A changed row appears as it was and as it is. NULLs are equal.
    """
    buckets = differing(a, b)
    sides = [
        stage.rows(buckets).withColumns({"copies_a": F.lit(in_a).cast("long"), "copies_b": F.lit(1 - in_a).cast("long")})
        for stage, in_a in ((a, 1), (b, 0))
    ]
    both = sides[0].unionByName(sides[1]).groupBy(*a.columns).agg(F.sum("copies_a").alias("copies_a"), F.sum("copies_b").alias("copies_b"))
    return both.where(F.col("copies_a") != F.col("copies_b"))


def reconcile_stages(a: HashedStage, b: HashedStage) -> DataFrame:
    """Keys whose rows differ: `only a`, `only b` or `differs`. Keys held equally by both are left out and mostly not read."""
    rows = unequal_rows(a, b)
    per_key = rows.groupBy(*a.keys).agg(F.max(F.least("copies_a", "copies_b")).alias("__shared"), F.sum("copies_a").alias("__a"), F.sum("copies_b").alias("__b"))
    found = F.when(F.col("__b") == 0, "only a").when(F.col("__a") == 0, "only b").otherwise("differs")
    return per_key.select(*a.keys, found.alias("found"))


def recoverable(df: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """Keys that miss the value here and have it in `other` (another source, or another row of this one)."""
    lacking, known = keys_of(df.where(is_missing(column)), [key]), keys_of(other.where(~is_missing(column)), [key])
    return lacking.join(known, key, "left_semi")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness: expected to be empty."""
    return duplicated_keys(df, keys)


def assert_none(df: DataFrame, predicate: Column) -> DataFrame:
    """Number of rows that break a post-condition: expected to be 0."""
    return df.agg(F.count_if(predicate).alias("violations"))

