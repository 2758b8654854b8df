"""From the raw status log to clean claims: parse, normalise, resolve, reduce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.functions.expressions import map_value
from claimflow.operators import lifecycle as life
from claimflow.operators.cleaning import default_usage, repair_order
from claimflow.operators.picking import dedupe, pick
from claimflow.operators.relational import keys_of
from claimflow.operators.shaping import Field, fields_for, project
from claimflow.operators.skew import join_facts
from claimflow.sources.contracts import CLAIM_COLUMNS, STATUS_LOG

DEDUPE_KEYS = (
    "claimnumber",
    "claim_status_name",
    "coverage",
    "damage_type",
    "compensation_total",
    "claim_estimate",
    "total_claim_estimate",
    "claim_estimate_first",
)


# Columns a cleaned column is derived from besides its own source.
NEEDS = {
    "vehicle_usage": ("customer_type",),
    "claim_submitted_date": ("claim_opened_date", "claim_accident_date"),
    "cost_copay_deductible": ("cost_copay", "cost_deductible"),
}


def source_fields(columns: Sequence[str] = ()) -> tuple[Field, ...]:
    """The part of the log contract needed for the given cleaned columns (all by default)."""
    if not columns:
        return STATUS_LOG
    return fields_for(STATUS_LOG, {*columns, *[n for c in columns for n in NEEDS.get(c, ())]})


def clean_history(raw: DataFrame, *columns: str) -> DataFrame:
    """Typed status log in English, whole or only the named columns: one projection over the raw columns, no shuffle."""
    log = project(raw, source_fields(columns))
    has = set(log.columns)
    if "claim_status_name" in has:
        log = life.normalise_status(log)
    if "vehicle_usage" in has:
        log = default_usage(log, "vehicle_usage", "customer_type", "Tổ chức", "Kinh doanh", "Không kinh doanh")
    if "claim_submitted_date" in has:
        log = repair_order(log, "claim_submitted_date", "claim_opened_date", "claim_accident_date")
    derived = {
        "coverage": lambda: map_value("coverage", v.COVERAGE_BY_CODE, v.UNKNOWN),
        "damage_type": lambda: map_value("damage_type", v.HISTORY_DAMAGE, ""),
        "solutioncompensation": lambda: map_value("solutioncompensation", v.COMPENSATION_ROUTE, v.UNKNOWN),
        "customer_type": lambda: map_value("customer_type", v.CLAIM_CUSTOMER),
    }
    if "cost_copay_deductible" in has:
        derived["cost_copay_deductible"] = lambda: F.coalesce(
            "cost_copay_deductible", (F.col("cost_copay") + F.col("cost_deductible")).cast("decimal(15,2)")
        )
    wanted = {c: build() for c, build in derived.items() if c in has}
    log = log.withColumns(wanted) if wanted else log
    return log.select(*columns) if columns else log


def deduped_history(log: DataFrame) -> DataFrame:
    """Updates equal in state, coverage, damage and amounts are copies; the first one stays."""
    return dedupe(log, DEDUPE_KEYS, [F.asc("updateddate"), F.asc("row_index")])


def reduced_claims(log: DataFrame) -> DataFrame:
    """The reductions of all states, from one table of day cells."""
    return life.reduce_claims(log)


def reduced_with_facts(log: DataFrame) -> DataFrame:
    """The reduced claims of a log without copies, with the claim's damage and milestones on every row left.

    Both are facts of the whole claim, one row each, and meet the few rows that the reductions leave.
    """
    facts = life.damage_facts(log, with_milestones=True)
    return life.damage_labels(reduced_claims(log).join(facts, life.CLAIM))


def beyond_snapshot(log: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The log's rows of the claims that the snapshot does not know.

    The claim number decides alone, so Spark carries the join below the cleaning: raw rows meet the snapshot's claims, and
    only what is left is cleaned.
    """
    return join_facts(log, keys_of(snapshot, life.CLAIM), life.CLAIM, "left_anti")


def history_only_claims(log: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Claims known only to the log, one row each, in the common claim schema."""
    return log_claims(beyond_snapshot(log, snapshot))


def log_claims(log: DataFrame) -> DataFrame:
    """The claims of a log, one row each, in the common claim schema.

    The latest row and the facts are each one row per claim, so they meet in a plain join.
    """
    latest = pick(log, life.CLAIM, [F.desc("updateddate"), F.desc("row_index")])
    claims = latest.join(life.damage_facts(log, with_status=True), life.CLAIM)
    claims = life.damage_labels(claims).withColumn("payment_date", life.paid_date())
    amounts = ("claim_estimate_first", "total_claim_estimate", "compensation_total")
    claims = claims.withColumns({c: F.coalesce(F.col(c), life.zero()) for c in amounts})
    return life.process_days(claims, "history").select(*CLAIM_COLUMNS)
