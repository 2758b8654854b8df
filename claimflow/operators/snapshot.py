"""Claim snapshot: claims with several coverages, classifications, the common claim schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.functions.expressions import any_phrase, map_value, members_to_group
from claimflow.operators.cleaning import label_if_missing, rollup_category
from claimflow.operators.picking import duplicated_rows, pick
from claimflow.operators.relational import append_rows
from claimflow.operators.skew import join_facts
from claimflow.sources.contracts import CLAIM_COLUMNS

CLAIM = ["claimnumber"]

SETTLED = ("paid out", "approved")
ESTIMATED = ("in process", "denied", "estimate pending", "documents pending")


def multi_row(df: DataFrame) -> DataFrame:
    """Rows of the claims that have more than one row."""
    return duplicated_rows(df, CLAIM)


def _class_facts(df: DataFrame, classes: dict[str, tuple[Column, str, Sequence[str]]], sep: str) -> DataFrame:
    """Per claim and status class, in one aggregate: sums, zero and spread tests of the deciding amount, coverages.

    A class is (row filter, deciding amount, amounts to sum). Coverages are a closed vocabulary, so the
    collected set stays small.
    """
    out: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    for name, (member, decider, amounts) in classes.items():
        value = F.when(member, F.col(decider))
        out += [
            F.count_if(member).alias(f"__{name}_n"),
            F.count_if(member & (F.col(decider) == 0)).alias(f"__{name}_zeros"),
            (F.min(value) != F.max(value)).alias(f"__{name}_differs"),
            F.array_join(F.array_sort(F.collect_set(F.when(member, F.col("coverage")))), sep).alias(f"__{name}_coverage"),
            *[F.sum(F.when(member, F.col(a))).cast("decimal(15,2)").alias(f"__{name}_{a}") for a in amounts],
        ]
    return df.groupBy("claimnumber").agg(*out)


def rollup_coverage_v1(df: DataFrame) -> DataFrame:
    """First method: per status, zero rows of multi-row claims go; differing amounts are summed, coverages joined.

    As in its source, a claim whose rows are all zero disappears; the second method is the one carried forward.
    """
    status = F.col("claim_status")
    paid = ["compensation_total", "compensation_amount_beforetax", "claim_estimate_first"]
    open_ = ["claim_estimate", "claim_estimate_beforetax", "claim_estimate_first"]
    classes = {
        "paid": (status == "paid out", "compensation_total", paid),
        "open": (status == "in process", "claim_estimate", open_),
        "cancelled": (status == "cancelled", "claim_estimate_first", ["claim_estimate_first"]),
    }
    facts = _class_facts(df, classes, ", ")
    joined = join_facts(df, facts, CLAIM, "inner")
    several = F.col("__rows") > 1
    zero = (
        (status.isin(*SETTLED) & (F.col("compensation_total") == 0))
        | ((status == "in process") & (F.col("claim_estimate") == 0))
        | ((status == "cancelled") & (F.col("claim_estimate_first") == 0))
    )
    kept = joined.where(~(several & F.coalesce(zero, F.lit(False))))
    for name, (_, _, amounts) in classes.items():
        apply = several & F.coalesce(F.col(f"__{name}_differs"), F.lit(False))
        if name != "cancelled":
            apply = apply & (F.col(f"__{name}_zeros") == 0)
        sets = {a: F.when(apply, F.col(f"__{name}_{a}")).otherwise(F.col(a)) for a in amounts}
        coverage = F.col(f"__{name}_coverage")
        if name != "paid":
            coverage = F.replace(coverage, F.lit(", "), F.lit(" "))
        sets["coverage"] = F.when(apply, coverage).otherwise(F.col("coverage"))
        kept = kept.withColumns(sets)
    return kept.select(*df.columns)


def rollup_coverage_v2(df: DataFrame, index: str = "row_index") -> DataFrame:
    """Second method: per status class, sum the amounts of multi-row claims without zeros, then one best row per claim."""
    status = F.col("claim_status")
    estimates = ["claim_estimate_first", "claim_estimate", "claim_estimate_beforetax"]
    classes = {
        "settled": (
            status.isin(*SETTLED),
            "compensation_total",
            [*estimates, "compensation_amount_beforetax", "compensation_total"],
        ),
        "open": (status.isin(*ESTIMATED), "claim_estimate", estimates),
        "cancelled": (status == "cancelled", "claim_estimate_first", ["claim_estimate_first"]),
    }
    facts = _class_facts(df, classes, ", ")
    joined = join_facts(df, facts, CLAIM, "inner")
    for name, (_, _, amounts) in classes.items():
        apply = (F.col("__rows") > 1) & (F.col(f"__{name}_n") > 0) & (F.col(f"__{name}_zeros") == 0)
        sets = {a: F.when(apply, F.col(f"__{name}_{a}")).otherwise(F.col(a)) for a in amounts}
        sets["coverage"] = F.when(apply, F.col(f"__{name}_coverage")).otherwise(F.col("coverage"))
        joined = joined.withColumns(sets)
    order = [
        F.desc("total_claim_estimate"),
        F.desc("claim_estimate"),
        F.desc("claim_estimate_first"),
        F.desc("compensation_total"),
        F.asc("coverage"),
        F.asc(index),
    ]
    return pick(joined.select(*df.columns), CLAIM, order)


def damage_class(cause: str, coverage: str, injured: Column) -> Column:
    """Damage group of one row, as one ordered rule list. A missing cause without injury is unknown."""
    c, cov = F.col(cause), F.col(coverage)
    named = c.isNotNull()
    liability = map_value(c, members_to_group(v.DAMAGE_BY_LIABILITY_CAUSE))
    by_cause = map_value(c, members_to_group(v.DAMAGE_BY_CAUSE))
    return (
        F.when(injured, F.lit(v.INJURY))
        .when(by_cause.isNotNull(), by_cause)
        .when(named & (cov == "Collision coverage"), F.lit(v.PARTIAL_TOTAL))
        .when(named & cov.isin("Personal injury coverage", "Comprehensive coverage"), F.lit(v.INJURY))
        .when((cov == "Auto liability coverage") & liability.isNotNull(), liability)
        .otherwise(F.lit(v.UNKNOWN))
    )


def classify_damage(
    df: DataFrame, cause: str = "accident_type", text: str = "narrative", phrases: Sequence[str] = v.INJURY_PHRASES
) -> DataFrame:
    """Damage group per row; an injury phrase in any row of the claim decides for all of them."""
    flags = df.groupBy("claimnumber").agg(F.max(any_phrase(text, phrases)).alias("__injured"))
    joined = join_facts(df, flags, CLAIM, "inner")
    return joined.withColumn("damage_type", damage_class(cause, "coverage", F.col("__injured"))).drop("__injured")


def damage_per_claim(df: DataFrame) -> DataFrame:
    """One damage group per claim: that of its first coverage by name, then first cause."""
    injured = F.max(any_phrase("narrative", v.INJURY_PHRASES))
    first = F.min(F.struct("coverage", F.coalesce("accident_type", F.lit("")).alias("order"), "accident_type"))
    return (
        df.groupBy("claimnumber")
        .agg(injured.alias("injured"), first.alias("first"))
        .select("claimnumber", "injured", "first.coverage", "first.accident_type")
        .select("claimnumber", damage_class("accident_type", "coverage", F.col("injured")).alias("damage_type"))
    )


def classify_accident(df: DataFrame, column: str = "accident_type", output: str | None = None) -> DataFrame:
    """Cause lists to five accident types; missing causes are `Unknown`, lists without a type stay as written."""
    return rollup_category(label_if_missing(df, column, v.UNKNOWN), column, v.ACCIDENT_TYPES, keep=True, output=output)


def classify_vehicle(df: DataFrame, column: str = "vehicle_type", output: str | None = None) -> DataFrame:
    """Vehicle types to seven classes; others become NULL."""
    return rollup_category(df, column, v.VEHICLE_CLASSES, output=output)


def final_claims(snapshot: DataFrame, history_only: DataFrame, columns: Sequence[str] = CLAIM_COLUMNS) -> DataFrame:
    """Both sources in the common claim schema, one below the other."""
    return append_rows(snapshot.select(*columns), history_only.select(*columns))
