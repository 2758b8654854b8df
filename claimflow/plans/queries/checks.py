"""Registered queries: data-quality checks and reconciliation of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.functions.expressions import is_missing
from claimflow.operators import checks as op
from claimflow.operators.grouping import impute_by_mode
from claimflow.operators.lifecycle import clean_log, milestones
from claimflow.operators.shaping import fields_for, project
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.lifecycle import BASE, MILESTONES
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import CLAIM, log, snapshot
from claimflow.sources import adapters
from claimflow.sources.hashed import save_hashed
from claimflow.sources.stages import save_checked
from claimflow.sources.tables import new_path, stage
from claimflow.sources.contracts import POLICY, SNAPSHOT, STATUS_LOG

KEEP = ["claimnumber", "row_index"]


def _rules(table: str, keep: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{name}' AS rule FROM {table} WHERE {test}" for name, test in rules.items())


@query(
    "l1_check_date_order",
    f"WITH {sql.LOG} "
    + _rules(
        "log",
        "claimnumber, row_index",
        {
            "submitted after opened": "requested > claim_opened_date",
            "accident after submitted": "claim_accident_date > requested",
            "accident after opened": "claim_accident_date > claim_opened_date",
            "accident after updated": "claim_accident_date > updateddate",
        },
    ),
)
def l1_check_date_order(spark, sf):
    dates = {c for pair in op.CLAIM_DATE_RULES.values() for c in pair}
    fields = fields_for(STATUS_LOG, {*KEEP, *dates})
    return op.check_order(project(adapters.status_log_raw(spark, sf, [f.source for f in fields]), fields), KEEP)


@query(
    "l1_created_after_payment",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, 'created after payment' AS rule FROM snapshot WHERE createddate > payment_date",
)
def l1_created_after_payment(spark, sf):
    rows = snapshot(spark, sf, "claimnumber", "coverage", "createddate", "payment_date")
    return op.check_order(rows, ["claimnumber", "coverage"], op.SNAPSHOT_DATE_RULES)


@query(
    "l1_policy_date_order",
    f"WITH {sql.RAW_POLICIES}, p AS (SELECT policycode, {sql.date('createddate')} AS createddate, {sql.date('ngaybatdau')} AS start_date, "
    f"{sql.date('ngayketthuc')} AS end_date FROM raw_policies) "
    + _rules("p", "policycode", {"created after start": "createddate > start_date", "start after end": "start_date > end_date"}),
)
def l1_policy_date_order(spark, sf):
    fields = fields_for(POLICY, {"policycode", "createddate", "start_date", "end_date"})
    raw = adapters.policies_raw(spark, sf, [f.source for f in fields])
    return op.check_order(project(raw, fields), ["policycode"], op.POLICY_DATE_RULES)


@query(
    "l2_check_sum",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, CAST(cost_copay AS DOUBLE) AS cost_copay, "
    "CAST(cost_deductible AS DOUBLE) AS cost_deductible, CAST(cost_copay_deductible AS DOUBLE) AS cost_copay_deductible "
    "FROM snapshot WHERE cost_copay + cost_deductible <> cost_copay_deductible",
)
def l2_check_sum(spark, sf):
    costs = ["cost_copay", "cost_deductible"]
    df = snapshot(spark, sf, "claimnumber", "coverage", *costs, "cost_copay_deductible")
    return op.check_sum(df, costs, "cost_copay_deductible").where(~F.col("is_sum_correct")).drop("is_sum_correct")


AMOUNT_CHECK = (
    "claimnumber",
    "coverage",
    "claim_status",
    "claim_estimate",
    "claim_estimate_beforetax",
    "total_claim_estimate",
    "compensation_total",
    "compensation_amount_beforetax",
)


@query(
    "l3_check_amounts",
    f"WITH {sql.SNAPSHOT} "
    + _rules(
        "snapshot",
        "claimnumber, coverage",
        {
            "estimate without total": "(claim_estimate <> 0 OR claim_estimate_beforetax <> 0) AND total_claim_estimate = 0",
            "net compensation without total": "compensation_amount_beforetax <> 0 AND compensation_total = 0",
            "settled without compensation": "claim_status IN ('paid out', 'approved') AND compensation_total = 0",
            "unsettled with compensation": "claim_status NOT IN ('paid out', 'approved') AND compensation_total <> 0",
            "zero estimate not cancelled": "total_claim_estimate = 0 AND claim_status <> 'cancelled'",
        },
    ),
)
def l3_check_amounts(spark, sf):
    return op.check_amounts(snapshot(spark, sf, *AMOUNT_CHECK), ["claimnumber", "coverage"])


@query(
    "l4_check_future",
    f"WITH {sql.POLICIES} SELECT policycode, CAST(start_date AS VARCHAR) AS start_date FROM policies "
    "WHERE start_date > DATE '2000-06-30' AND status_trans = 'Terminated'",
)
def l4_check_future(spark, sf):
    late = op.check_future(
        adapters.policies(spark, sf), "start_date", F.lit("2000-06-30").cast("date"), F.col("status_trans") == "Terminated"
    )
    return late.select("policycode", "start_date")


STATUS_DATES = (
    "claim_status_name",
    "updateddate",
    "claim_submitted_date",
    "claim_opened_date",
    "claim_approved_date",
    "payment_date",
)


@query(
    "l5_check_status_dates",
    f"WITH {sql.LOG} "
    + _rules(
        "log",
        "claimnumber, row_index",
        {
            "submitted not dated as submitted": "claim_status_name = 'submitted' AND updateddate <> claim_submitted_date",
            "assessment not dated as opened": "claim_status_name = 'assessment pending' AND updateddate <> claim_opened_date",
            "decided without approval date": "claim_status_name IN ('denied', 'approved', 'cancelled') AND claim_approved_date IS NULL",
            "paid without payment date": "claim_status_name = 'paid out' AND payment_date IS NULL",
        },
    ),
)
def l5_check_status_dates(spark, sf):
    return op.check_status_dates(log(spark, sf, *KEEP, *STATUS_DATES), KEEP)


OBSERVED_SQL = {
    "submitted after opened": "claim_submitted_date > claim_opened_date",
    "accident after submitted": "claim_accident_date > claim_submitted_date",
    "accident after opened": "claim_accident_date > claim_opened_date",
    "accident after updated": "claim_accident_date > updateddate",
    "submitted not dated as submitted": "claim_status_name = 'submitted' AND updateddate <> claim_submitted_date",
    "assessment not dated as opened": "claim_status_name = 'assessment pending' AND updateddate <> claim_opened_date",
    "decided without approval date": "claim_status_name IN ('denied', 'approved', 'cancelled') AND claim_approved_date IS NULL",
    "paid without payment date": "claim_status_name = 'paid out' AND payment_date IS NULL",
}


@query(
    "l1_l5_checked_stage",
    f"WITH {sql.LOG} "
    + " UNION ALL ".join(f"SELECT '{rule}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations, COUNT(*) AS checked FROM log" for rule, broken in OBSERVED_SQL.items()),
)
def l1_l5_checked_stage(spark, sf):
    """Violations of all rules of the log, out of the job that writes it."""
    rules = {name: F.col(a) > F.col(b) for name, (a, b) in op.CLAIM_DATE_RULES.items()}
    rows = log(spark, sf, *KEEP, *dict.fromkeys((*STATUS_DATES, "claim_accident_date", "claim_opened_date", "claim_submitted_date", "updateddate")))
    _, violations = save_checked(rows, new_path(spark, "checked-log"), {**rules, **op.status_date_rules()})
    return violations


@query(
    "l5_paid_never_approved",
    f"WITH {sql.LOG} SELECT DISTINCT claimnumber FROM log WHERE claim_status_name = 'paid out' AND claimnumber NOT IN "
    "(SELECT claimnumber FROM log WHERE claim_status_name = 'approved')",
)
def l5_paid_never_approved(spark, sf):
    return op.paid_never_approved(log(spark, sf, "claimnumber", "claim_status_name"))


MISSING = ("agencycompensation", "damage_type", "claim_approved_date", "payment_date", "compensation_total")


def _is_missing(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) IN ('', '-'))"


@query(
    "l6_missing_report",
    f"WITH {sql.LOG} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS missing_rows, COUNT(DISTINCT claimnumber) AS missing_keys "
        f"FROM log WHERE {_is_missing(c)}"
        for c in MISSING
    ),
)
def l6_missing_report(spark, sf):
    return op.missing_report(log(spark, sf, "claimnumber", *MISSING), MISSING, "claimnumber")


@query(
    "l6_milestone_coverage",
    f"WITH {sql.LOG}, per AS (SELECT claimnumber, "
    + ", ".join(f"MIN(CASE WHEN claim_status_name = '{s}' THEN updateddate END) AS {c}" for c, s in MILESTONES.items())
    + " FROM log GROUP BY claimnumber) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS milestone, COUNT({c}) AS with_date, COUNT(*) - COUNT({c}) AS without_date FROM per" for c in MILESTONES
    ),
)
def l6_milestone_coverage(spark, sf):
    return op.milestone_coverage(milestones(log(spark, sf, "claimnumber", "claim_status_name", "updateddate")), list(MILESTONES))


def _unreadable(contract, table: str) -> str:
    parts = []
    for f in contract:
        if f.kind == "text":
            continue
        if f.kind == "date":
            source = f"split_part({f.source}, ' @', 1)" if "@" in f.fmt else f.source
            value = sql.date(source, {"dd/MM/yyyy": "%d/%m/%Y", "yyyy-MM-dd": "%Y-%m-%d", "dd-MM-yyyy": "%d-%m-%Y"}.get(f.fmt, "%b %d, %Y"))
        else:
            value = sql.money(f.source) if f.kind.startswith("money") else f"TRY_CAST({f.source} AS INTEGER)"
        entered = f"NOT {_is_missing(f.source)}"
        parts.append(
            f"SELECT '{f.target}' AS column_name, COUNT(*) FILTER (WHERE {entered}) AS entered, "
            f"COUNT(*) FILTER (WHERE {entered} AND {value} IS NULL) AS unreadable FROM {table}"
        )
    return " UNION ALL ".join(parts)


# columns that the statements of the checking engine derive as well
LOG_TYPED = fields_for(STATUS_LOG, {"updateddate", "claim_approved_date", "payment_date", "claim_estimate_first", "claim_estimate", "total_claim_estimate", "compensation_total"})
SNAPSHOT_TYPED = fields_for(SNAPSHOT, {"createddate", "updateddate", "payment_date", "claim_approved_date", "claim_estimate", "compensation_total", "processdays"})
POLICY_TYPED = fields_for(POLICY, {"createddate", "start_date", "end_date", "finalprice", "vehicle_seats"})


@query("s3_unreadable_log", f"WITH {sql.RAW_LOG} {_unreadable(LOG_TYPED, 'raw_log')}")
def s3_unreadable_log(spark, sf):
    return op.unreadable_report(adapters.status_log_raw(spark, sf, [f.source for f in LOG_TYPED]), LOG_TYPED)


@query("s3_unreadable_snapshot", f"WITH {sql.RAW_SNAPSHOT} {_unreadable(SNAPSHOT_TYPED, 'raw_snapshot')}")
def s3_unreadable_snapshot(spark, sf):
    return op.unreadable_report(adapters.snapshot_raw(spark, sf, [f.source for f in SNAPSHOT_TYPED]), SNAPSHOT_TYPED)


@query("s3_unreadable_policies", f"WITH {sql.RAW_POLICIES} {_unreadable(POLICY_TYPED, 'raw_policies')}")
def s3_unreadable_policies(spark, sf):
    return op.unreadable_report(adapters.policies_raw(spark, sf, [f.source for f in POLICY_TYPED]), POLICY_TYPED)


@query(
    "l7_reconcile_keys",
    f"WITH {sql.LOG}, {sql.SNAPSHOT}, a AS (SELECT DISTINCT claimnumber FROM log), b AS (SELECT DISTINCT claimnumber FROM snapshot) "
    "SELECT COALESCE(a.claimnumber, b.claimnumber) AS claimnumber, CASE WHEN b.claimnumber IS NULL THEN 'only a' "
    "WHEN a.claimnumber IS NULL THEN 'only b' ELSE 'both' END AS found FROM a FULL JOIN b ON a.claimnumber = b.claimnumber",
)
def l7_reconcile_keys(spark, sf):
    return op.reconcile_keys(log(spark, sf, "claimnumber"), snapshot(spark, sf, "claimnumber"), "claimnumber")


@query(
    "l8_reconcile_values",
    f"WITH {sql.LOG}, {sql.SNAPSHOT}, one AS (SELECT claimnumber, MAX(compensation_total) AS c FROM snapshot GROUP BY 1) "
    "SELECT l.claimnumber, row_index, CAST(compensation_total AS DOUBLE) AS compensation_total, "
    "CAST(c AS DOUBLE) AS compensation_total_other FROM log l JOIN one USING (claimnumber) "
    "WHERE compensation_total IS DISTINCT FROM c",
)
def l8_reconcile_values(spark, sf):
    other = snapshot(spark, sf, "claimnumber", "compensation_total").groupBy("claimnumber").agg(F.max("compensation_total").alias("compensation_total"))
    return op.reconcile_values(log(spark, sf, *KEEP, "compensation_total"), other, CLAIM, ["compensation_total"])


TODAY_SQL = f"""{sql.CLAIMS},
keyed AS (SELECT CAST(substr(claimnumber, 2) AS BIGINT) AS k, claimnumber, claim_status, compensation_total AS c FROM claims),
a AS (SELECT claimnumber, claim_status, c FROM keyed WHERE k % 173 <> 9),
b AS (SELECT claimnumber, CASE WHEN k % 149 = 2 THEN 'denied' ELSE claim_status END AS claim_status, CASE WHEN k % 113 = 3 THEN NULL ELSE c END AS c
  FROM keyed WHERE k % 131 <> 4),
counted AS (SELECT claimnumber, claim_status, c, SUM(in_a) AS copies_a, SUM(in_b) AS copies_b
  FROM (SELECT *, 1 AS in_a, 0 AS in_b FROM a UNION ALL SELECT *, 0, 1 FROM b) GROUP BY 1, 2, 3),
unequal AS (SELECT * FROM counted WHERE copies_a <> copies_b)"""


def two_days(spark, sf):
    """The claims as two sources hold them, a few days apart: some missing on either side, some restated."""
    k = F.substring("claimnumber", 2, 20).cast("long")
    claims = stage(adapters.claims(spark, sf).select("claimnumber", "claim_status", "compensation_total"), "claims")
    before = claims.where(k % 173 != 9)
    after = claims.where(k % 131 != 4).withColumns(
        {
            "claim_status": F.when(k % 149 == 2, "denied").otherwise(F.col("claim_status")),
            "compensation_total": F.when(k % 113 != 3, F.col("compensation_total")),
        }
    )
    return [save_hashed(df, name, ["claimnumber"], levels=2) for df, name in ((before, "claims-before"), (after, "claims-after"))]


@query(
    "l7_reconcile_stages",
    f"WITH {TODAY_SQL} SELECT claimnumber, CASE WHEN SUM(copies_b) = 0 THEN 'only a' WHEN SUM(copies_a) = 0 THEN 'only b' ELSE 'differs' END "
    "AS found FROM unequal GROUP BY claimnumber",
)
def l7_reconcile_stages(spark, sf):
    return op.reconcile_stages(*two_days(spark, sf))


@query(
    "l8_reconcile_stages",
    f"WITH {TODAY_SQL} SELECT claimnumber, claim_status, CAST(c AS DOUBLE) AS compensation_total, CAST(copies_a AS BIGINT) AS copies_a, "
    "CAST(copies_b AS BIGINT) AS copies_b FROM unequal",
)
def l8_reconcile_stages(spark, sf):
    return op.unequal_rows(*two_days(spark, sf))


@query(
    "l9_recoverable",
    f"WITH {sql.LOG}, {sql.SNAPSHOT} SELECT DISTINCT claimnumber FROM log WHERE agencycompensation = '' AND claimnumber IN "
    "(SELECT claimnumber FROM snapshot WHERE agencycompensation NOT IN ('', '-'))",
)
def l9_recoverable(spark, sf):
    columns = ("claimnumber", "agencycompensation")
    return op.recoverable(log(spark, sf, *columns), snapshot(spark, sf, *columns), "claimnumber", "agencycompensation")


@query(
    "l9_recoverable_same_source",
    f"WITH {sql.LOG} SELECT DISTINCT claimnumber FROM log WHERE damage_type = '' AND claimnumber IN "
    "(SELECT claimnumber FROM log WHERE damage_type <> '')",
)
def l9_recoverable_same_source(spark, sf):
    rows = log(spark, sf, "claimnumber", "damage_type")
    return op.recoverable(rows, rows, "claimnumber", "damage_type")


@query(
    "l10_impute_by_mode",
    f"WITH {sql.LOG}, mode AS (SELECT assignee_fullname, agencycompensation AS m FROM log WHERE agencycompensation <> '' "
    "GROUP BY 1, 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY assignee_fullname ORDER BY COUNT(*) DESC, agencycompensation) = 1) "
    "SELECT claimnumber, row_index, CASE WHEN agencycompensation = '' THEN COALESCE(m, agencycompensation) "
    "ELSE agencycompensation END AS agencycompensation FROM log LEFT JOIN mode USING (assignee_fullname)",
)
def l10_impute_by_mode(spark, sf):
    rows = log(spark, sf, *KEEP, "assignee_fullname", "agencycompensation")
    filled = impute_by_mode(rows, "assignee_fullname", "agencycompensation", is_missing("agencycompensation"))
    return filled.drop("assignee_fullname")


@query(
    "l11_assert_unique",
    f"WITH {sql.LOG} SELECT claimnumber, claim_status_name, coverage, COUNT(*) AS n FROM log GROUP BY 1, 2, 3 HAVING COUNT(*) > 1",
)
def l11_assert_unique(spark, sf):
    keys = ["claimnumber", "claim_status_name", "coverage"]
    return op.assert_unique(log(spark, sf, *keys), keys)


@query(
    "l11_assert_none",
    f"WITH {sql.LOG}, one AS (SELECT * FROM log QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, claim_status_name, coverage "
    "ORDER BY updateddate, row_index DESC) = 1) SELECT COUNT(*) FILTER (WHERE COALESCE(claim_estimate_first, 0) = 0) AS violations FROM one",
)
def l11_assert_none(spark, sf):
    return op.assert_none(clean_log(log(spark, sf, *BASE)), F.col("claim_estimate_first") == 0)
