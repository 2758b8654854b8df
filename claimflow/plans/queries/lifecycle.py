"""Registered queries: the claim lifecycle over the status log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.operators import lifecycle as op
from claimflow.operators.grouping import spelled
from claimflow.operators.relational import keys_of
from claimflow.plans import history
from claimflow.plans.queries import expected
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import CLAIM, log, snapshot
from claimflow.sources import adapters
from claimflow.sources.stages import by_slices, slices_for
from claimflow.sources.tables import stage

BASE = (
    "claimnumber",
    "row_index",
    "claim_status_name",
    "coverage",
    "updateddate",
    "claim_estimate_first",
    "claim_estimate",
    "total_claim_estimate",
    "compensation_total",
)

OUT = [*BASE, "claim_status"]


def deduped(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The log after its copies are removed: what the reductions and all that follows read."""
    return history.deduped_history(log(spark, sf, *dict.fromkeys((*BASE, *history.DEDUPE_KEYS, *more))))


def rows(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The log with the resolved state on every row."""
    return op.with_status(log(spark, sf, *BASE, *more))


def staged(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The log without copies as a table: for what reads it more than once."""
    return stage(deduped(spark, sf, *more), "deduped-log")


def out(alias: str = "", **replaced: str) -> str:
    """Select list of the reduced rows; `replaced` gives SQL for single columns."""
    parts = []
    for c in OUT:
        body = replaced.get(c, f"{alias}{c}")
        if c == "updateddate":
            body = f"CAST({body} AS VARCHAR)"
        elif c.startswith(("claim_estimate", "total", "compensation")):
            body = f"CAST({body} AS DOUBLE)"
        parts.append(f"{body} AS {c}")
    return ", ".join(parts)


def latest(status: str, name: str = "latest_rows") -> str:
    """Rows at the latest date of the claims resolved to `status`."""
    return (
        f"{name} AS (SELECT * FROM log_rows WHERE claim_status = '{status}' "
        "QUALIFY updateddate = MAX(updateddate) OVER (PARTITION BY claimnumber))"
    )


def joint_zero(source: str, name: str = "filled") -> str:
    broken = "claim_estimate IS NULL OR claim_estimate_first IS NULL"
    return (
        f"{name} AS (SELECT * REPLACE (CASE WHEN {broken} THEN 0 ELSE claim_estimate END AS claim_estimate, "
        f"CASE WHEN {broken} THEN 0 ELSE claim_estimate_first END AS claim_estimate_first) FROM {source})"
    )


def drop_zero(source: str, keys: str, name: str = "valued") -> str:
    """Zero rows go where others remain; a group of zero rows keeps its last one."""
    value = "(claim_estimate <> 0 OR claim_estimate_first <> 0)"
    return (
        f"{name} AS (SELECT * FROM {source} QUALIFY {value} OR (COUNT(*) FILTER (WHERE {value}) OVER (PARTITION BY {keys}) = 0 "
        f"AND row_index = MAX(row_index) OVER (PARTITION BY {keys})))"
    )


def zeroed(source: str, name: str, *columns: str) -> str:
    sets = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in columns)
    return f"{name} AS (SELECT * REPLACE ({sets}) FROM {source})"


AMOUNTS = op.AMOUNTS
OWN_ROUTE = expected.COMPENSATION_ROUTE["Tự bồi thường"]


@query(
    "j1_normalise_status",
    f"WITH {sql.LOG} SELECT claim_status_name, COUNT(*) AS n FROM log GROUP BY 1",
)
def j1_normalise_status(spark, sf):
    return op.normalise_status(adapters.status_log_raw(spark, sf)).groupBy("claim_status_name").agg(
        F.count(F.lit(1)).alias("n")
    )


def _chain() -> str:
    """The state of a claim as the chain of guarded updates, each seeing the result of the one before."""
    steps = ["denied", "cancelled", "approved", "paid out", "in process", "documents pending", "assessment pending", "estimate pending"]
    flags = ", ".join(f"bool_or(claim_status_name = '{s}') AS f{i}" for i, s in enumerate(steps))
    body = f"SELECT claimnumber, {flags}, CAST(NULL AS VARCHAR) AS s FROM log GROUP BY claimnumber"
    for i, s in enumerate(steps):
        guard = "" if s in ("denied", "paid out") else " AND s IS NULL"
        body = f"SELECT * REPLACE (CASE WHEN f{i}{guard} THEN '{s}' ELSE s END AS s) FROM ({body})"
    return f"SELECT claimnumber, s AS claim_status FROM ({body})"


@query("j2_resolve_status", f"WITH {sql.LOG} {_chain()}")
def j2_resolve_status(spark, sf):
    return op.resolve_status(log(spark, sf, "claimnumber", "claim_status_name"))


MILESTONES = {
    "documents_pending_date": "documents pending",
    "estimate_pending_date": "estimate pending",
    "assessment_pending_date": "assessment pending",
    "process_start_date": "in process",
}


@query(
    "j3_milestones",
    f"WITH {sql.LOG} SELECT l.claimnumber, l.row_index, "
    + ", ".join(f"CAST(t{i}.d AS VARCHAR) AS {c}" for i, c in enumerate(MILESTONES))
    + " FROM log l "
    + " ".join(
        f"LEFT JOIN (SELECT claimnumber, MIN(updateddate) AS d FROM log WHERE claim_status_name = '{s}' GROUP BY 1) t{i} "
        f"ON t{i}.claimnumber = l.claimnumber"
        for i, s in enumerate(MILESTONES.values())
    ),
)
def j3_milestones(spark, sf):
    return op.with_milestones(log(spark, sf, "claimnumber", "row_index", "claim_status_name", "updateddate")).drop(
        "claim_status_name", "updateddate"
    )


@query(
    "j4_relabel_latest",
    f"WITH {sql.DEDUPED_ROWS}, {latest('assessment pending')} SELECT claimnumber, row_index, claim_status_name AS claim_status, "
    "CAST(claim_status <> claim_status_name AS INTEGER) AS relabelled FROM latest_rows",
)
def j4_relabel_latest(spark, sf):
    return op.relabel_latest(staged(spark, sf)).select("claimnumber", "row_index", "claim_status", "relabelled")


J5A = f"{latest('estimate pending')}, {joint_zero('latest_rows')}, {drop_zero('filled', 'claimnumber')}"


@query(
    "j5a_reduce_estimate_pending",
    f"WITH {sql.DEDUPED_ROWS}, {J5A} SELECT {out()} FROM valued "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, coverage ORDER BY row_index DESC) = 1",
)
def j5a_reduce_estimate_pending(spark, sf):
    return op.reduce_estimate_pending(deduped(spark, sf)).select(*OUT)


@query(
    "j5b_reduce_documents_pending",
    f"WITH {sql.DEDUPED_ROWS}, {latest('documents pending')} SELECT {out()} FROM latest_rows",
)
def j5b_reduce_documents_pending(spark, sf):
    return op.reduce_documents_pending(staged(spark, sf)).select(*OUT)


J5C = (
    f"{latest('assessment pending')}, repeated AS (SELECT DISTINCT claimnumber FROM latest_rows GROUP BY claimnumber, coverage "
    "HAVING COUNT(*) > 1), owned AS (SELECT DISTINCT claimnumber FROM latest_rows WHERE claim_status_name = claim_status), "
    "preferred AS (SELECT * REPLACE (claim_status_name AS claim_status) FROM latest_rows WHERE NOT (claim_status_name <> claim_status "
    "AND claimnumber IN (SELECT claimnumber FROM repeated) AND claimnumber IN (SELECT claimnumber FROM owned))), "
    + joint_zero("preferred")
    + ", "
    + drop_zero("filled", "claimnumber, claim_status = 'assessment pending'", "assessed")
)


@query("j5c_reduce_assessment_pending", f"WITH {sql.DEDUPED_ROWS}, {J5C} SELECT {out()} FROM assessed")
def j5c_reduce_assessment_pending(spark, sf):
    return op.reduce_assessment_pending(staged(spark, sf)).select(*OUT)


J5D = (
    latest("in process")
    + ", mine AS (SELECT * FROM latest_rows WHERE claim_status_name = 'in process'), "
    + zeroed("mine", "mine0", "claim_estimate", "claim_estimate_first", "compensation_total")
    + ", spread AS (SELECT *, (SELECT COUNT(DISTINCT coverage) FROM mine m WHERE m.claimnumber = x.claimnumber) AS nc FROM mine0 x)"
)


@query(
    "j5d_reduce_in_process",
    f"WITH {sql.DEDUPED_ROWS}, {J5D} SELECT {out()} FROM spread QUALIFY CASE WHEN nc = 1 THEN row_index = MAX(row_index) OVER "
    "(PARTITION BY claimnumber) ELSE row_index = MIN(row_index) OVER (PARTITION BY claimnumber, coverage) END",
)
def j5d_reduce_in_process(spark, sf):
    return op.reduce_in_process(deduped(spark, sf)).select(*OUT)


def previous(source: str, status: str, name: str = "previous") -> str:
    return (
        f"{name} AS (SELECT * FROM {source} WHERE claim_status_name <> '{status}' QUALIFY ROW_NUMBER() OVER "
        "(PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1)"
    )


J5E = (
    "decided AS (SELECT * FROM log_rows WHERE claim_status = 'approved'), "
    + zeroed("decided", "approved0", "claim_estimate", "total_claim_estimate", "compensation_total")
    + ", "
    + previous("approved0", "approved")
    + ", estimated AS (SELECT a.* REPLACE (CASE WHEN a.total_claim_estimate <> 0 THEN a.total_claim_estimate "
    "WHEN p.claimnumber IS NOT NULL THEN p.total_claim_estimate "
    "WHEN a.compensation_total <> 0 THEN round(CAST(a.compensation_total AS DOUBLE) * 100 / 92.5926, 0) ELSE 0 END "
    "AS total_claim_estimate) FROM approved0 a LEFT JOIN previous p ON a.claimnumber = p.claimnumber "
    "WHERE a.claim_status_name = 'approved'), approved1 AS (SELECT * FROM estimated QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1)"
)


@query("j5e_reduce_approved", f"WITH {sql.DEDUPED_ROWS}, {J5E} SELECT {out()} FROM approved1")
def j5e_reduce_approved(spark, sf):
    return op.reduce_approved(deduped(spark, sf)).select(*OUT)


@query(
    "j5f_reduce_paid_out",
    f"WITH {sql.DEDUPED_ROWS}, {latest('paid out')}, {zeroed('latest_rows', 'paid0', *AMOUNTS)} SELECT "
    + out(compensation_total="SUM(compensation_total) OVER (PARTITION BY claimnumber, coverage)")
    + " FROM paid0 QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, coverage ORDER BY row_index DESC) = 1",
)
def j5f_reduce_paid_out(spark, sf):
    return op.reduce_paid_out(deduped(spark, sf)).select(*OUT)


@query(
    "j5g_reduce_cancelled",
    f"WITH {sql.DEDUPED_ROWS}, closed AS (SELECT * FROM log_rows WHERE claim_status = 'cancelled'), "
    f"{zeroed('closed', 'closed0', *AMOUNTS)}, {previous('closed0', 'cancelled')} SELECT "
    + out(
        "c.",
        **{
            c: f"CASE WHEN p.claimnumber IS NULL THEN c.{c} ELSE p.{c} END"
            for c in ("total_claim_estimate", "claim_estimate_first", "compensation_total")
        },
    )
    + " FROM closed0 c LEFT JOIN previous p ON p.claimnumber = c.claimnumber WHERE c.claim_status_name = 'cancelled'",
)
def j5g_reduce_cancelled(spark, sf):
    return op.reduce_cancelled(deduped(spark, sf)).select(*OUT)


@query(
    "j5h_reduce_denied",
    f"WITH {sql.DEDUPED_ROWS}, closed AS (SELECT * FROM log_rows WHERE claim_status = 'denied'), "
    f"{zeroed('closed', 'closed0', *AMOUNTS)}, {previous('closed0', 'denied')} SELECT "
    + out(
        "c.",
        total_claim_estimate="COALESCE(NULLIF(CASE WHEN c.total_claim_estimate = 0 AND p.claimnumber IS NOT NULL "
        "THEN p.total_claim_estimate ELSE c.total_claim_estimate END, 0), c.compensation_total)",
    )
    + " FROM closed0 c LEFT JOIN previous p ON p.claimnumber = c.claimnumber WHERE c.claim_status_name = 'denied'",
)
def j5h_reduce_denied(spark, sf):
    return op.reduce_denied(deduped(spark, sf)).select(*OUT)


def _rank(column: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(expected.STATUS_PRIORITY, start=1))
    return f"CASE {column} {whens} ELSE 99 END"


@query(
    "j6_clean_log",
    f"WITH {sql.DEDUPED_ROWS}, {J5C.replace('latest_rows', 'latest_assessed')}, {J5E}, moved AS (SELECT claimnumber, "
    f"arg_min(claim_status, {_rank('claim_status')}) AS s FROM assessed WHERE claim_status <> 'assessment pending' GROUP BY 1), "
    "one AS (SELECT * FROM log_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, claim_status_name, coverage "
    f"ORDER BY updateddate, row_index DESC) = 1), {zeroed('one', 'one0', *AMOUNTS)} SELECT "
    + out(
        "o.",
        claim_status="COALESCE(m.s, o.claim_status)",
        total_claim_estimate="CASE WHEN o.claim_status_name = 'approved' AND o.claim_status = 'approved' "
        "THEN a.total_claim_estimate ELSE o.total_claim_estimate END",
    )
    + " FROM one0 o LEFT JOIN moved m ON m.claimnumber = o.claimnumber LEFT JOIN approved1 a ON a.claimnumber = o.claimnumber",
)
def j6_clean_log(spark, sf):
    return op.clean_log(staged(spark, sf)).select(*OUT)


@query(
    "j7_consolidate_damage",
    f"WITH {sql.LOG}, facts AS (SELECT claimnumber, COUNT(DISTINCT damage_type) AS n, MIN(damage_type) AS only_one, "
    "string_agg(damage_type, ',' ORDER BY damage_type) AS listed FROM log WHERE damage_type <> '' GROUP BY 1) "
    "SELECT l.claimnumber, row_index, CASE WHEN f.n IS NULL THEN 'Unclassified' WHEN damage_type <> '' THEN damage_type "
    "WHEN f.n = 1 THEN only_one ELSE 'Multiple' END AS damage_type, CASE WHEN f.n IS NULL THEN 'Unclassified' "
    "WHEN f.n = 1 THEN only_one ELSE listed END AS damage_type_list FROM log l LEFT JOIN facts f USING (claimnumber)",
)
def j7_consolidate_damage(spark, sf):
    rows = op.consolidate_damage(log(spark, sf, "claimnumber", "row_index", "damage_type"))
    return rows.withColumn("damage_type_list", spelled(F.col("damage_type_list")))


HISTORY_ONLY = f"{sql.ROWS}, {sql.SNAPSHOT}, alone AS (SELECT * FROM log_rows WHERE claimnumber NOT IN (SELECT claimnumber FROM snapshot))"


def history_only(spark: SparkSession, sf: str, variant: str) -> DataFrame:
    claims = op.reduce_history_only(log(spark, sf, *BASE), variant)
    return claims.join(keys_of(snapshot(spark, sf, "claimnumber"), CLAIM), CLAIM, "left_anti")


@query(
    "j8_promote_paid",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, CASE WHEN solutioncompensation <> '{OWN_ROUTE}' THEN 'in process' "
    "WHEN bool_or(claim_status_name = 'paid out') OVER (PARTITION BY claimnumber) THEN 'paid out' ELSE 'approved' END "
    "AS claim_status FROM log",
)
def j8_promote_paid(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name", "solutioncompensation")
    entered = F.when(F.col("solutioncompensation") == v.OWN_ROUTE, "approved").otherwise("in process")
    return op.promote_paid(rows.withColumn("claim_status", entered)).select("claimnumber", "row_index", "claim_status")


DATES = ("claim_submitted_date", "claim_opened_date", "claim_approved_date", "payment_date")


@query(
    "j9_process_days_history",
    f"WITH {sql.ROWS} SELECT claimnumber, row_index, claim_status, CAST(CASE WHEN claim_status = 'paid out' THEN "
    "payment_date - claim_submitted_date WHEN claim_status IN ('submitted', 'cancelled', 'in process', 'denied') THEN "
    "updateddate - claim_submitted_date WHEN claim_status = 'approved' THEN claim_approved_date - claim_submitted_date END "
    "AS INTEGER) AS processdays FROM log_rows",
)
def j9_process_days_history(spark, sf):
    return op.process_days(rows(spark, sf, *DATES), "history").select("claimnumber", "row_index", "claim_status", "processdays")


@query(
    "j10_process_days_final",
    f"WITH {sql.ROWS} SELECT claimnumber, row_index, claim_status, CAST(CASE WHEN claim_status IN ('approved', 'paid out') THEN "
    "claim_approved_date - claim_submitted_date WHEN claim_status IN ('denied', 'cancelled') THEN "
    "updateddate - claim_submitted_date END AS INTEGER) AS processdays FROM log_rows",
)
def j10_process_days_final(spark, sf):
    return op.process_days(rows(spark, sf, *DATES), "final").select("claimnumber", "row_index", "claim_status", "processdays")


REPAIRED = (
    "CAST(CASE WHEN (processdays IS NULL OR processdays = 0) AND claim_status NOT IN ('cancelled', 'estimate pending', "
    "'assessment pending') THEN COALESCE(claim_approved_date, updateddate) - claim_opened_date WHEN claim_status = 'cancelled' "
    "AND processdays = 0 THEN updateddate - claim_submitted_date ELSE processdays END AS INTEGER)"
)


@query(
    "j11_process_days_repair",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, claim_status, {REPAIRED} AS processdays FROM snapshot",
)
def j11_process_days_repair(spark, sf):
    df = snapshot(
        spark, sf, "claimnumber", "coverage", "claim_status", "processdays", "updateddate", "claim_submitted_date",
        "claim_opened_date", "claim_approved_date",
    )
    return op.process_days(df, "repair").select("claimnumber", "coverage", "claim_status", "processdays")


@query(
    "j12_payment_date",
    f"WITH {sql.ROWS}, paid AS (SELECT claimnumber, MAX(updateddate) AS d FROM log WHERE claim_status_name = 'paid out' GROUP BY 1) "
    "SELECT l.claimnumber, row_index, CAST(CASE WHEN claim_status = 'paid out' THEN COALESCE(p.d, payment_date, claim_approved_date) "
    "ELSE payment_date END AS VARCHAR) AS payment_date FROM log_rows l LEFT JOIN paid p USING (claimnumber)",
)
def j12_payment_date(spark, sf):
    return op.payment_date(log(spark, sf, *BASE, "payment_date", "claim_approved_date")).select(
        "claimnumber", "row_index", "payment_date"
    )


@query(
    "j13_reduce_history_only",
    f"WITH {HISTORY_ONLY} SELECT {out()} FROM alone QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1",
)
def j13_reduce_history_only(spark, sf):
    return history_only(spark, sf, "latest").select(*OUT)


@query(
    "j13_history_only_distinct_amounts",
    f"WITH {HISTORY_ONLY} SELECT claimnumber, CAST(SUM(c) AS DOUBLE) AS compensation_total FROM (SELECT DISTINCT claimnumber, "
    "COALESCE(compensation_total, 0) AS c FROM alone WHERE claim_status = 'approved' AND claim_status_name = 'approved') GROUP BY 1",
)
def j13_history_only_distinct_amounts(spark, sf):
    return history_only(spark, sf, "distinct amounts").drop("claim_status")


@query(
    "j13_history_only_largest",
    f"WITH {HISTORY_ONLY} SELECT {out()} FROM alone QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY "
    "compensation_total DESC NULLS LAST, total_claim_estimate DESC NULLS LAST, claim_estimate_first DESC NULLS LAST, "
    "updateddate DESC, row_index DESC) = 1",
)
def j13_history_only_largest(spark, sf):
    return history_only(spark, sf, "largest").select(*OUT)


@query(
    "j13_history_only_in_process",
    f"WITH {HISTORY_ONLY} SELECT {out()} FROM alone WHERE claim_status = 'in process' AND claim_status_name = 'in process' "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1",
)
def j13_history_only_in_process(spark, sf):
    return history_only(spark, sf, "in process").select(*OUT)


def _reduced(name: str, body: str) -> str:
    """One reduction of the chain as CTEs of its own."""
    return body.replace("latest_rows", f"{name}_latest").replace("filled", f"{name}_filled")


REDUCED = f"""{sql.DEDUPED_ROWS},
{_reduced("ep", J5A).replace("valued", "ep_valued")},
{_reduced("dp", latest("documents pending"))},
{_reduced("ap", J5C)},
{_reduced("ip", J5D)},
{J5E.replace("previous", "approved_previous")},
{_reduced("po", latest("paid out"))}, {zeroed("po_latest", "paid0", *AMOUNTS)},
cancelled AS (SELECT * FROM log_rows WHERE claim_status = 'cancelled'), {zeroed("cancelled", "cancelled0", *AMOUNTS)},
{previous("cancelled0", "cancelled", "cancelled_previous")},
refused AS (SELECT * FROM log_rows WHERE claim_status = 'denied'), {zeroed("refused", "refused0", *AMOUNTS)},
{previous("refused0", "denied", "refused_previous")},
reduced AS (
  SELECT {out()} FROM ep_valued QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, coverage ORDER BY row_index DESC) = 1
  UNION ALL SELECT {out()} FROM dp_latest
  UNION ALL SELECT {out()} FROM assessed
  UNION ALL SELECT {out()} FROM spread QUALIFY CASE WHEN nc = 1 THEN row_index = MAX(row_index) OVER (PARTITION BY claimnumber)
    ELSE row_index = MIN(row_index) OVER (PARTITION BY claimnumber, coverage) END
  UNION ALL SELECT {out()} FROM approved1
  UNION ALL SELECT {out(compensation_total="SUM(compensation_total) OVER (PARTITION BY claimnumber, coverage)")} FROM paid0
    QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, coverage ORDER BY row_index DESC) = 1
  UNION ALL SELECT {out("c.", **{
      c: f"CASE WHEN p.claimnumber IS NULL THEN c.{c} ELSE p.{c} END"
      for c in ("total_claim_estimate", "claim_estimate_first", "compensation_total")
  })} FROM cancelled0 c LEFT JOIN cancelled_previous p ON p.claimnumber = c.claimnumber WHERE c.claim_status_name = 'cancelled'
  UNION ALL SELECT {out("c.", total_claim_estimate="COALESCE(NULLIF(CASE WHEN c.total_claim_estimate = 0 AND p.claimnumber IS NOT NULL "
      "THEN p.total_claim_estimate ELSE c.total_claim_estimate END, 0), c.compensation_total)")}
    FROM refused0 c LEFT JOIN refused_previous p ON p.claimnumber = c.claimnumber WHERE c.claim_status_name = 'denied')"""

CHAIN = REDUCED + """,
stamps AS (SELECT claimnumber, """ + ", ".join(
    f"MIN(CASE WHEN claim_status_name = '{s}' THEN updateddate END) AS {c}" for c, s in MILESTONES.items()
) + """ FROM log GROUP BY claimnumber),
damage AS (SELECT claimnumber, COUNT(DISTINCT damage_type) AS n, MIN(damage_type) AS only_one FROM log
  WHERE damage_type <> '' GROUP BY claimnumber)
SELECT r.*, CASE WHEN n IS NULL THEN 'Unclassified' WHEN l.damage_type <> '' THEN l.damage_type WHEN n = 1 THEN only_one
    ELSE 'Multiple' END AS damage_type, """ + ", ".join(f"CAST(s.{c} AS VARCHAR) AS {c}" for c in MILESTONES) + """
FROM reduced r JOIN log l ON l.claimnumber = r.claimnumber AND l.row_index = r.row_index
JOIN stamps s ON s.claimnumber = r.claimnumber LEFT JOIN damage ON damage.claimnumber = r.claimnumber"""


@query("j_chain_reduced_claims", f"WITH {CHAIN}")
def j_chain_reduced_claims(spark, sf):
    """Copies removed, damage consolidated, every state reduced, milestones on every row that is left.

    All that follows the removal of copies looks at a claim alone, so it is done for a slice of the claims at a time.
    """
    slices = slices_for(spark, log(spark, sf, "claimnumber").count())

    def work(rows: DataFrame) -> DataFrame:
        return history.reduced_with_facts(rows).select(*OUT, "damage_type", *MILESTONES)

    return by_slices(deduped(spark, sf, "damage_type"), CLAIM, work, slices, "deduped-log")


@query("j5_reduce_all_states", f"WITH {REDUCED} SELECT * FROM reduced")
def j5_reduce_all_states(spark, sf):
    """The reductions of all eight states out of one table of day cells."""
    return op.reduce_claims(staged(spark, sf)).select(*OUT)
