"""From the raw claim snapshot to one clean row per claim, and to the final claim set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.functions.expressions import map_value
from claimflow.operators import snapshot as snap
from claimflow.operators.cleaning import repair_order
from claimflow.operators.lifecycle import process_days
from claimflow.operators.shaping import Field, fields_for, project, with_row_index
from claimflow.plans.history import beyond_snapshot, log_claims
from claimflow.sources.contracts import CLAIM_COLUMNS, SNAPSHOT


# Columns a cleaned column is derived from besides its own source.
NEEDS = {
    "claim_status": ("statusname",),
    "payment_date": ("policy_start_date",),
    "claim_submitted_date": ("claim_opened_date", "claim_accident_date"),
}


def source_fields(columns: Sequence[str] = ()) -> tuple[Field, ...]:
    """The part of the snapshot contract needed for the given cleaned columns (all by default)."""
    if not columns:
        return SNAPSHOT
    return fields_for(SNAPSHOT, {*columns, *[n for c in columns for n in NEEDS.get(c, ())]})


def clean_snapshot(raw: DataFrame, *columns: str) -> DataFrame:
    """Typed snapshot in English, one row per claim and coverage, whole or only the named columns: one projection.

    `row_index` is a hash of the row's (selected) content; ask for it together with the columns it should cover.
    """
    df = project(raw, source_fields(columns))
    has = set(df.columns)
    if "payment_date" in has:
        df = df.withColumn("payment_date", F.coalesce("payment_date", "policy_start_date"))
    if "claim_submitted_date" in has:
        df = repair_order(df, "claim_submitted_date", "claim_opened_date", "claim_accident_date")
    derived = {
        "statusname": ("claim_status", lambda: map_value("statusname", v.SNAPSHOT_STATUS)),
        "coverage": ("coverage", lambda: map_value("coverage", v.COVERAGE_BY_NAME, v.UNKNOWN)),
        "solutioncompensation": (
            "solutioncompensation",
            lambda: map_value("solutioncompensation", v.COMPENSATION_ROUTE, v.UNKNOWN),
        ),
        "customer_type": ("customer_type", lambda: map_value("customer_type", v.CLAIM_CUSTOMER)),
    }
    wanted = {target: build() for source, (target, build) in derived.items() if source in has}
    df = (df.withColumns(wanted) if wanted else df).drop("statusname")
    if not columns or "row_index" in columns:
        df = with_row_index(df)
    return df.select(*columns) if columns else df


def snapshot_claims(df: DataFrame) -> DataFrame:
    """One row per claim in the common claim schema: durations, rolled-up coverages, damage and vehicle classes."""
    timed = process_days(df, "repair")
    claims = snap.rollup_coverage_v2(timed)
    claims = claims.join(snap.damage_per_claim(df), "claimnumber", "left")  # one row per claim on both sides
    claims = snap.classify_vehicle(claims)
    coarse = F.when(F.col("claim_status").isin(*v.OPEN_STATES), F.lit("in process")).otherwise(F.col("claim_status"))
    return claims.withColumn("claim_status", coarse).select(*CLAIM_COLUMNS)


def final_claim_set(log: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Snapshot claims and the claims only the log knows, with the final durations."""
    return joint_claims(beyond_snapshot(log, snapshot), snapshot)


def joint_claims(alone: DataFrame, snapshot: DataFrame) -> DataFrame:
    """`final_claim_set` of a log that is already `beyond_snapshot`."""
    claims = snap.final_claims(snapshot_claims(snapshot), log_claims(alone))
    return process_days(claims, "final")
