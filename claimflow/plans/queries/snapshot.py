"""Registered queries: the claim snapshot, its roll-ups and classifications, and the final claim set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.operators import snapshot as op
from claimflow.operators.cleaning import rollup_category
from claimflow.operators.relational import update_from
from claimflow.plans.history import DEDUPE_KEYS, beyond_snapshot, deduped_history
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.lifecycle import REPAIRED
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import CLAIM, log, snapshot
from claimflow.plans.snapshot import joint_claims
from claimflow.sources import adapters
from claimflow.sources.contracts import CLAIM_COLUMNS
from claimflow.sources.tables import load, stage

AMOUNTS = (
    "claim_estimate_first",
    "claim_estimate",
    "claim_estimate_beforetax",
    "total_claim_estimate",
    "compensation_total",
    "compensation_amount_beforetax",
)
BASE = ("claimnumber", "coverage", "claim_status", *AMOUNTS, "row_index")


def doubles(columns: tuple[str, ...] = AMOUNTS) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


@query(
    "k1_multi_row_claims",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, claim_status FROM snapshot QUALIFY COUNT(*) OVER (PARTITION BY claimnumber) > 1",
)
def k1_multi_row_claims(spark, sf):
    return op.multi_row(snapshot(spark, sf, "claimnumber", "coverage", "claim_status"))


def _update(source: str, name: str, where: str, sums: tuple[str, ...], having: str, sep: str = ", ") -> str:
    """One update-from-join step of a roll-up, as its own CTE over the stage before."""
    total = ", ".join(f"SUM({c}) AS s_{c}" for c in sums)
    sets = ", ".join(f"CASE WHEN u.claimnumber IS NULL THEN t.{c} ELSE u.s_{c} END AS {c}" for c in sums)
    return (
        f"{name}_sums AS (SELECT claimnumber, {total}, string_agg(DISTINCT coverage, '{sep}' ORDER BY coverage) AS s_coverage "
        f"FROM several WHERE {where} GROUP BY claimnumber HAVING {having}), "
        f"{name} AS (SELECT t.* REPLACE ({sets}, CASE WHEN u.claimnumber IS NULL THEN t.coverage ELSE u.s_coverage END AS coverage) "
        f"FROM {source} t LEFT JOIN {name}_sums u ON u.claimnumber = t.claimnumber)"
    )


SEVERAL = "several AS (SELECT * FROM snapshot QUALIFY COUNT(*) OVER (PARTITION BY claimnumber) > 1)"
PAID = ("compensation_total", "compensation_amount_beforetax", "claim_estimate_first")
OPEN = ("claim_estimate", "claim_estimate_beforetax", "claim_estimate_first")


def _without(source: str, name: str, predicate: str) -> str:
    return (
        f"{name} AS (SELECT * FROM {source} WHERE NOT COALESCE({predicate} AND claimnumber IN "
        "(SELECT claimnumber FROM several), FALSE))"
    )


V1 = ", ".join(
    [
        SEVERAL,
        _without("snapshot", "a1", "claim_status IN ('paid out', 'approved') AND compensation_total = 0"),
        _update(
            "a1",
            "a2",
            "claim_status = 'paid out'",
            PAID,
            "COUNT(DISTINCT compensation_total) > 1 AND COUNT(*) FILTER (WHERE compensation_total = 0) = 0",
        ),
        _without("a2", "a3", "claim_status = 'in process' AND claim_estimate = 0"),
        _update(
            "a3",
            "a4",
            "claim_status = 'in process'",
            OPEN,
            "COUNT(DISTINCT claim_estimate) > 1 AND COUNT(*) FILTER (WHERE claim_estimate = 0) = 0",
            " ",
        ),
        _without("a4", "a5", "claim_status = 'cancelled' AND claim_estimate_first = 0"),
        _update(
            "a5",
            "a6",
            "claim_status = 'cancelled'",
            ("claim_estimate_first",),
            "COUNT(DISTINCT claim_estimate_first) > 1",
            " ",
        ),
    ]
)


@query("k2_rollup_coverage_v1", f"WITH {sql.SNAPSHOT}, {V1} SELECT claimnumber, coverage, claim_status, {doubles()} FROM a6")
def k2_rollup_coverage_v1(spark, sf):
    return op.rollup_coverage_v1(snapshot(spark, sf, *BASE)).drop("row_index")


V2 = ", ".join(
    [
        SEVERAL,
        _update(
            "snapshot",
            "b1",
            "claim_status IN ('paid out', 'approved')",
            (*OPEN, "compensation_amount_beforetax", "compensation_total"),
            "COUNT(*) FILTER (WHERE compensation_total = 0) = 0",
        ),
        _update(
            "b1",
            "b2",
            "claim_status IN ('in process', 'denied', 'estimate pending', 'documents pending')",
            OPEN,
            "COUNT(*) FILTER (WHERE claim_estimate = 0) = 0",
        ),
        _update(
            "b2",
            "b3",
            "claim_status = 'cancelled'",
            ("claim_estimate_first",),
            "COUNT(*) FILTER (WHERE claim_estimate_first = 0) = 0",
        ),
        "b4 AS (SELECT * FROM b3 QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY total_claim_estimate DESC, "
        "claim_estimate DESC, claim_estimate_first DESC, compensation_total DESC, coverage) = 1)",
    ]
)


@query("k3_rollup_coverage_v2", f"WITH {sql.SNAPSHOT}, {V2} SELECT claimnumber, coverage, claim_status, {doubles()} FROM b4")
def k3_rollup_coverage_v2(spark, sf):
    return op.rollup_coverage_v2(snapshot(spark, sf, *BASE)).drop("row_index")


FLAGGED = (
    f"flagged AS (SELECT *, bool_or({sql.injured('narrative')}) OVER (PARTITION BY claimnumber) AS injured FROM snapshot)"
)


@query(
    "k4_classify_damage",
    f"WITH {sql.SNAPSHOT}, {FLAGGED} SELECT claimnumber, coverage, accident_type, "
    f"{sql.damage_case('accident_type', 'coverage', 'injured')} AS damage_type FROM flagged",
)
def k4_classify_damage(spark, sf):
    df = snapshot(spark, sf, "claimnumber", "coverage", "accident_type", "narrative")
    return op.classify_damage(df).drop("narrative")


TEXT_PHRASES = ("the of", "de la", "und der")


@query(
    "k4_classify_damage_documents",
    "WITH told AS (SELECT doc_id, 'C' || (doc_id // 3) AS claimnumber, "
    f"{sql.pick(list(sql.v.COVERAGE_BY_CODE.values()), 'doc_id % 4')} AS coverage, "
    f"{sql.pick(adapters.CAUSES, f'doc_id % {len(adapters.CAUSES)}')} AS accident_type, text FROM documents), "
    "flagged AS (SELECT *, bool_or("
    + " OR ".join(f"contains(lower(text), '{p}')" for p in TEXT_PHRASES)
    + f") OVER (PARTITION BY claimnumber) AS injured FROM told) SELECT doc_id, claimnumber, "
    f"{sql.damage_case('accident_type', 'coverage', 'injured')} AS damage_type FROM flagged",
)
def k4_classify_damage_documents(spark, sf):
    """Whole document texts as narratives, three to a claim."""
    told = load(spark, sf, "documents", ["doc_id", "text"]).selectExpr(
        "doc_id",
        "concat('C', doc_id div 3) as claimnumber",
        f"{adapters._pick(list(v.COVERAGE_BY_CODE.values()), 'doc_id % 4')} as coverage",
        f"{adapters._pick(adapters.CAUSES, f'doc_id % {len(adapters.CAUSES)}')} as accident_type",
        "text as narrative",
    )
    return op.classify_damage(told, phrases=TEXT_PHRASES).select("doc_id", "claimnumber", "damage_type")


@query(
    "k5_classify_accident",
    f"WITH {sql.RAW_SNAPSHOT} SELECT CASE WHEN nguyen_nhan_ton_that IN ('', '-') THEN 'Unknown' ELSE "
    f"{sql.accident_case('nguyen_nhan_ton_that')} END AS accident_type, COUNT(*) AS n FROM raw_snapshot GROUP BY 1",
)
def k5_classify_accident(spark, sf):
    raw = adapters.snapshot_raw(spark, sf).withColumnRenamed("nguyen_nhan_ton_that", "accident_type")
    return op.classify_accident(raw).groupBy("accident_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k6_classify_vehicle",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, {sql.vehicle_case('vehicle_type')} AS vehicle_class FROM snapshot",
)
def k6_classify_vehicle(spark, sf):
    df = snapshot(spark, sf, "claimnumber", "coverage", "vehicle_type")
    return op.classify_vehicle(df, output="vehicle_class").drop("vehicle_type")


@query(
    "k7_restore_from_source",
    f"WITH {sql.SNAPSHOT}, src AS (SELECT claimnumber, MIN(accident_type) AS cause FROM snapshot GROUP BY 1) "
    f"SELECT s.claimnumber, coverage, CASE WHEN {sql.accident_case('accident_type')} = accident_type THEN r.cause "
    f"ELSE {sql.accident_case('accident_type')} END AS accident_type FROM snapshot s JOIN src r USING (claimnumber)",
)
def k7_restore_from_source(spark, sf):
    df = snapshot(spark, sf, "claimnumber", "coverage", "accident_type")
    source = df.groupBy("claimnumber").agg(F.min("accident_type").alias("cause"))
    grouped = rollup_category(df, "accident_type", v.ACCIDENT_TYPES, keep=True, output="grouped")
    unknown = F.col("grouped") == F.col("accident_type")
    restored = update_from(
        grouped.withColumn("cause", F.col("grouped")), source, CLAIM, ["cause"], unknown, unique=True
    )
    return restored.select("claimnumber", "coverage", F.col("cause").alias("accident_type"))


COMMON = (
    "claimnumber",
    "claim_status",
    "claim_submitted_date",
    "claim_approved_date",
    "payment_date",
    "processdays",
    "cost_copay_deductible",
    "coverage",
    "damage_type",
    "vehicle_type",
    "customer_type",
    "claim_estimate_first",
    "total_claim_estimate",
    "compensation_total",
    "updateddate",
)
FINAL_DAYS = (
    "CAST(CASE WHEN claim_status IN ('approved', 'paid out') THEN claim_approved_date - claim_submitted_date "
    "WHEN claim_status IN ('denied', 'cancelled') THEN updateddate - claim_submitted_date END AS INTEGER)"
)


def _common(**replaced: str) -> str:
    return ", ".join(f"{replaced.get(c, c)} AS {c}" for c in COMMON)


COARSE = (
    "CASE WHEN claim_status IN ('assessment pending', 'estimate pending', 'documents pending', 'in process') "
    "THEN 'in process' ELSE claim_status END"
)
FINAL = f"""{sql.DEDUPED_ROWS}, {sql.SNAPSHOT}, {V2}, {FLAGGED},
snapshot_damage AS (
  SELECT claimnumber, {sql.damage_case('accident_type', 'coverage', 'injured')} AS damage_type FROM flagged
  QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY coverage, accident_type) = 1),
from_snapshot AS (
  SELECT {_common(claim_status=COARSE, processdays=REPAIRED, vehicle_type=sql.vehicle_case('vehicle_type'))}
  FROM b4 JOIN snapshot_damage USING (claimnumber)),
log_damage AS (SELECT claimnumber, COUNT(DISTINCT damage_type) AS n, MIN(damage_type) AS only_one FROM log
  WHERE damage_type <> '' GROUP BY 1),
log_paid AS (SELECT claimnumber, MAX(updateddate) AS paid_on FROM log WHERE claim_status_name = 'paid out' GROUP BY 1),
from_log AS (
  SELECT claimnumber, claim_status, claim_submitted_date, claim_approved_date,
    CASE WHEN claim_status = 'paid out' THEN COALESCE(paid_on, payment_date, claim_approved_date) ELSE payment_date END
      AS payment_date, NULL AS processdays, cost_copay_deductible, coverage,
    CASE WHEN n IS NULL THEN 'Unclassified' WHEN damage_type <> '' THEN damage_type WHEN n = 1 THEN only_one
         ELSE 'Multiple' END AS damage_type, vehicle_type, customer_type,
    COALESCE(claim_estimate_first, 0) AS claim_estimate_first, COALESCE(total_claim_estimate, 0) AS total_claim_estimate,
    COALESCE(compensation_total, 0) AS compensation_total, updateddate
  FROM (SELECT * FROM log_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1)
  LEFT JOIN log_damage USING (claimnumber) LEFT JOIN log_paid USING (claimnumber)
  WHERE claimnumber NOT IN (SELECT claimnumber FROM snapshot)),
final AS (SELECT * REPLACE ({FINAL_DAYS} AS processdays) FROM (SELECT * FROM from_snapshot UNION ALL BY NAME SELECT * FROM from_log))"""


def final_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Claims of both sources, one row each, the log without its copies: the input of the loss metrics.

    The log is a table before its copies are removed, so the sort of the copies does not take over the join's partitions,
    in which all rows of a claim lie together.
    """
    history = {*CLAIM_COLUMNS, *DEDUPE_KEYS, "row_index"} - {"claim_status", "processdays"}
    both = {*CLAIM_COLUMNS, *BASE, "accident_type", "narrative"} - {"damage_type"}
    known = stage(snapshot(spark, sf, *sorted(both)), "clean-snapshot")
    alone = stage(beyond_snapshot(log(spark, sf, *sorted(history)), known), "log-alone")
    return joint_claims(stage(deduped_history(alone), "deduped-log"), known)


def _shown() -> str:
    parts = []
    for c in COMMON:
        if c.endswith("date"):
            parts.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c.startswith(("cost", "claim_estimate", "total", "compensation")):
            parts.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)


@query("k8_final_claims", f"WITH {FINAL} SELECT {_shown()} FROM final")
def k8_final_claims(spark, sf):
    return final_claims(spark, sf).select(*COMMON)
