"""Registered queries: calendar, earned premium, losses and loss ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import exposure as op
from claimflow.operators.grouping import monthly
from claimflow.plans.metrics import register_metric_views
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.snapshot import FINAL, final_claims
from claimflow.sources import adapters

FIRST, LAST = "1994-11-01", "2004-12-01"
LOSSES = (
    "losses AS (SELECT CAST(date_trunc('month', claim_submitted_date) AS DATE) AS calendar_month, "
    "SUM(compensation_total) AS incurred_losses FROM claims WHERE claim_status = 'paid out' GROUP BY 1)"
)
MONTH = "CAST(calendar_month AS VARCHAR) AS calendar_month"
PREMIUM = "round(earned_premium, 2) AS earned_premium"


def premium(spark: SparkSession, sf: str) -> DataFrame:
    return op.earned_premium_monthly(adapters.policies(spark, sf))


# the final claims under the name the statements read
ON_FINAL = f"{FINAL}, claims AS (SELECT * FROM final)"


def money(column: str, digits: int = 2):
    return F.round(F.col(column).cast("double"), digits).alias(column)


@query(
    "m1_calendar",
    f"WITH {sql.POLICIES}, {sql.months(FIRST, LAST)}, started AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS calendar_month, "
    f"COUNT(*) AS n FROM policies GROUP BY 1) SELECT {MONTH}, COALESCE(n, 0) AS policies_started FROM months "
    "LEFT JOIN started USING (calendar_month)",
)
def m1_calendar(spark, sf):
    started = monthly(adapters.policies(spark, sf), "start_date", F.count(F.lit(1)).alias("policies_started"))
    return op.calendar(spark, FIRST, LAST).join(started, "calendar_month", "left").fillna(0, ["policies_started"])


@query(
    "m2_earned_premium_month",
    f"WITH {sql.POLICIES} SELECT round(SUM(share), 2) AS earned_premium FROM shares "
    "WHERE start_date <= DATE '1998-01-31' AND end_date >= DATE '1998-01-01'",
)
def m2_earned_premium_month(spark, sf):
    return op.earned_premium_month(adapters.policies(spark, sf), "1998-01-01").select(money("earned_premium"))


@query(
    "m2_earned_premium_starting",
    f"WITH {sql.POLICIES} SELECT round(SUM(share), 2) AS earned_premium FROM shares "
    "WHERE start_date >= DATE '1998-08-01' AND end_date > DATE '1998-08-31'",
)
def m2_earned_premium_starting(spark, sf):
    return op.earned_premium_month(adapters.policies(spark, sf), "1998-08-01", "starting").select(money("earned_premium"))


@query("m3_earned_premium_monthly", f"WITH {sql.EARNED} SELECT {MONTH}, {PREMIUM} FROM premium")
def m3_earned_premium_monthly(spark, sf):
    return premium(spark, sf).select("calendar_month", money("earned_premium"))


@query(
    "m3_earned_premium_by_events",
    f"WITH {sql.EARNED} SELECT {MONTH}, {PREMIUM} FROM premium WHERE calendar_month BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
)
def m3_earned_premium_by_events(spark, sf):
    """The monthly form out of what comes in force and goes out, summed up along the calendar."""
    months = op.calendar(spark, FIRST, LAST)
    return op.earned_premium_by_events(adapters.policies(spark, sf), months).select("calendar_month", money("earned_premium"))


DAYS = ("1996-01-01", "1999-12-31", 3)
DAY_GRID = f"days AS (SELECT CAST(unnest(generate_series(DATE '{DAYS[0]}', DATE '{DAYS[1]}', INTERVAL {DAYS[2]} DAY)) AS DATE) AS calendar_day)"


@query(
    "m3_earned_premium_daily",
    f"WITH {sql.POLICIES}, {DAY_GRID} SELECT CAST(calendar_day AS VARCHAR) AS calendar_day, "
    "round(SUM(CAST(finalprice AS DOUBLE) / (end_date - start_date + 1)), 2) AS earned_premium, COUNT(*) AS active_policies "
    "FROM days JOIN policies ON calendar_day BETWEEN start_date AND end_date GROUP BY calendar_day",
)
def m3_earned_premium_daily(spark, sf):
    daily = op.earned_premium_daily(adapters.policies(spark, sf), op.day_grid(spark, *DAYS))
    return daily.where("active_policies > 0").select("calendar_day", money("earned_premium"), "active_policies")


@query(
    "r4_open_claims_daily",
    f"WITH {sql.CLAIMS}, {DAY_GRID}, c AS (SELECT claim_submitted_date AS s, CASE WHEN claim_approved_date IS NOT NULL THEN greatest(claim_approved_date, claim_submitted_date) END AS e FROM claims) "
    "SELECT CAST(calendar_day AS VARCHAR) AS calendar_day, COUNT(*) FILTER (WHERE s <= calendar_day AND (e IS NULL OR e > calendar_day)) AS open_claims "
    "FROM days, c GROUP BY calendar_day",
)
def r4_open_claims_daily(spark, sf):
    """Open claims on every day of a grid; a settled claim closes on approval."""
    return op.open_claims_daily(adapters.claims(spark, sf), F.col("claim_approved_date"), op.day_grid(spark, *DAYS))


@query(
    "m3_earned_premium_touched",
    f"WITH {sql.POLICIES}, {sql.months('1990-01-01', '2012-12-01')} SELECT {MONTH}, round(SUM(CAST(finalprice AS DOUBLE) / "
    "((year(end_date) - year(start_date)) * 12 + month(end_date) - month(start_date) + 1)), 2) AS earned_premium "
    "FROM months JOIN policies ON calendar_month BETWEEN date_trunc('month', start_date) AND date_trunc('month', end_date) GROUP BY 1",
)
def m3_earned_premium_touched(spark, sf):
    touched = op.earned_premium_monthly(adapters.policies(spark, sf), mode="touched")
    return touched.select("calendar_month", money("earned_premium"))


@query(
    "m4_calendar_premium",
    f"WITH {sql.EARNED}, {sql.months(FIRST, LAST).replace('months AS', 'spine AS')} "
    f"SELECT {MONTH}, {PREMIUM} FROM spine LEFT JOIN premium USING (calendar_month)",
)
def m4_calendar_premium(spark, sf):
    joined = op.calendar_premium(op.calendar(spark, FIRST, LAST), premium(spark, sf))
    return joined.select("calendar_month", money("earned_premium"))


@query(
    "m5_claims_monthly",
    f"WITH {sql.CLAIMS} SELECT CAST(CAST(date_trunc('month', claim_submitted_date) AS DATE) AS VARCHAR) AS calendar_month, "
    "CAST(SUM(compensation_total) AS DOUBLE) AS claims_amount, COUNT(DISTINCT claimnumber) AS claim_count FROM claims GROUP BY 1",
)
def m5_claims_monthly(spark, sf):
    return op.claims_monthly(adapters.claims(spark, sf))


@query(
    "m5_final_claims_monthly",
    f"WITH {ON_FINAL} SELECT CAST(CAST(date_trunc('month', claim_submitted_date) AS DATE) AS VARCHAR) AS calendar_month, "
    "CAST(SUM(compensation_total) AS DOUBLE) AS claims_amount, COUNT(DISTINCT claimnumber) AS claim_count FROM claims GROUP BY 1",
)
def m5_final_claims_monthly(spark, sf):
    return op.claims_monthly(final_claims(spark, sf))


@query(
    "m6_loss_ratio_monthly",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, {LOSSES} SELECT {MONTH}, {PREMIUM}, CAST(incurred_losses AS DOUBLE) AS incurred_losses, "
    "round(CAST(incurred_losses AS DOUBLE) / earned_premium, 6) AS loss_ratio FROM premium LEFT JOIN losses USING (calendar_month)",
)
def m6_loss_ratio_monthly(spark, sf):
    joined = op.loss_ratio_monthly(premium(spark, sf), adapters.claims(spark, sf))
    return joined.select("calendar_month", money("earned_premium"), "incurred_losses", money("loss_ratio", 6))


@query(
    "m6_final_loss_ratio_monthly",
    f"WITH {sql.EARNED}, {ON_FINAL}, {LOSSES} SELECT {MONTH}, {PREMIUM}, CAST(incurred_losses AS DOUBLE) AS incurred_losses, "
    "round(CAST(incurred_losses AS DOUBLE) / earned_premium, 6) AS loss_ratio FROM premium LEFT JOIN losses USING (calendar_month)",
)
def m6_final_loss_ratio_monthly(spark, sf):
    joined = op.loss_ratio_monthly(premium(spark, sf), final_claims(spark, sf))
    return joined.select("calendar_month", money("earned_premium"), "incurred_losses", money("loss_ratio", 6))


@query(
    "m7_monthly_loss_view",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, {LOSSES} SELECT {MONTH}, {PREMIUM}, "
    "CAST(COALESCE(incurred_losses, 0) AS DOUBLE) AS incurred_losses FROM premium LEFT JOIN losses USING (calendar_month)",
)
def m7_monthly_loss_view(spark, sf):
    view = op.monthly_loss_view(premium(spark, sf), adapters.claims(spark, sf))
    return view.select("calendar_month", money("earned_premium"), "incurred_losses")


@query(
    "m7_final_monthly_loss_view",
    f"WITH {sql.EARNED}, {ON_FINAL}, {LOSSES} SELECT {MONTH}, {PREMIUM}, "
    "CAST(COALESCE(incurred_losses, 0) AS DOUBLE) AS incurred_losses FROM premium LEFT JOIN losses USING (calendar_month)",
)
def m7_final_monthly_loss_view(spark, sf):
    view = op.monthly_loss_view(premium(spark, sf), final_claims(spark, sf))
    return view.select("calendar_month", money("earned_premium"), "incurred_losses")


@query(
    "m8_policy_claim_counts",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, {sql.months(FIRST, LAST).replace('months AS', 'spine AS')}, "
    "submitted AS (SELECT CAST(date_trunc('month', claim_submitted_date) AS DATE) AS calendar_month, "
    "COUNT(DISTINCT claimnumber) AS new_claims FROM claims GROUP BY 1) "
    f"SELECT {MONTH}, COALESCE(active_policies, 0) AS active_policies, COALESCE(new_claims, 0) AS new_claims "
    "FROM spine LEFT JOIN premium USING (calendar_month) LEFT JOIN submitted USING (calendar_month)",
)
def m8_policy_claim_counts(spark, sf):
    return op.policy_claim_counts(op.calendar(spark, FIRST, LAST), premium(spark, sf), adapters.claims(spark, sf))


@query(
    "m8_final_policy_claim_counts",
    f"WITH {sql.EARNED}, {ON_FINAL}, {sql.months(FIRST, LAST).replace('months AS', 'spine AS')}, "
    "submitted AS (SELECT CAST(date_trunc('month', claim_submitted_date) AS DATE) AS calendar_month, "
    "COUNT(DISTINCT claimnumber) AS new_claims FROM claims GROUP BY 1) "
    f"SELECT {MONTH}, COALESCE(active_policies, 0) AS active_policies, COALESCE(new_claims, 0) AS new_claims "
    "FROM spine LEFT JOIN premium USING (calendar_month) LEFT JOIN submitted USING (calendar_month)",
)
def m8_final_policy_claim_counts(spark, sf):
    return op.policy_claim_counts(op.calendar(spark, FIRST, LAST), premium(spark, sf), final_claims(spark, sf))


@query(
    "m9_severity_monthly",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, approved AS (SELECT CAST(date_trunc('month', claim_approved_date) AS DATE) AS calendar_month, "
    "SUM(compensation_total) AS incurred_losses, COUNT(*) AS n FROM claims WHERE claim_status IN ('paid out', 'approved') GROUP BY 1) "
    f"SELECT {MONTH}, {PREMIUM}, CAST(incurred_losses AS DOUBLE) AS incurred_losses, "
    "round(CAST(incurred_losses AS DOUBLE) / earned_premium, 6) AS loss_ratio, "
    "round(CAST(incurred_losses AS DOUBLE) / n, 4) AS avg_compensation FROM premium LEFT JOIN approved USING (calendar_month)",
)
def m9_severity_monthly(spark, sf):
    joined = op.severity_monthly(premium(spark, sf), adapters.claims(spark, sf))
    return joined.select(
        "calendar_month", money("earned_premium"), "incurred_losses", money("loss_ratio", 6), money("avg_compensation", 4)
    )


@query(
    "m9_final_severity_monthly",
    f"WITH {sql.EARNED}, {ON_FINAL}, approved AS (SELECT CAST(date_trunc('month', claim_approved_date) AS DATE) AS calendar_month, "
    "SUM(compensation_total) AS incurred_losses, COUNT(*) AS n FROM claims WHERE claim_status IN ('paid out', 'approved') GROUP BY 1) "
    f"SELECT {MONTH}, {PREMIUM}, CAST(incurred_losses AS DOUBLE) AS incurred_losses, "
    "round(CAST(incurred_losses AS DOUBLE) / earned_premium, 6) AS loss_ratio, "
    "round(CAST(incurred_losses AS DOUBLE) / n, 4) AS avg_compensation FROM premium LEFT JOIN approved USING (calendar_month)",
)
def m9_final_severity_monthly(spark, sf):
    joined = op.severity_monthly(premium(spark, sf), final_claims(spark, sf))
    return joined.select(
        "calendar_month", money("earned_premium"), "incurred_losses", money("loss_ratio", 6), money("avg_compensation", 4)
    )


@query(
    "a6_metric_views",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, {LOSSES}, submitted AS (SELECT CAST(date_trunc('month', claim_submitted_date) AS DATE) "
    "AS calendar_month, COUNT(DISTINCT claimnumber) AS new_claims FROM claims GROUP BY 1) "
    f"SELECT {MONTH}, {PREMIUM}, CAST(COALESCE(incurred_losses, 0) AS DOUBLE) AS incurred_losses, active_policies, "
    "COALESCE(new_claims, 0) AS new_claims FROM premium LEFT JOIN losses USING (calendar_month) "
    f"LEFT JOIN submitted USING (calendar_month) WHERE calendar_month BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
)
def a6_metric_views(spark, sf):
    """Both views, read by name."""
    register_metric_views(spark, adapters.policies(spark, sf), adapters.claims(spark, sf), FIRST, LAST)
    both = spark.sql(
        "SELECT calendar_month, earned_premium, incurred_losses, active_policies, new_claims "
        "FROM v_monthly_loss_ratio JOIN v_monthly_policy_claim_counts USING (calendar_month)"
    )
    return both.withColumn("earned_premium", money("earned_premium"))


@query(
    "m10_carried_over",
    f"WITH {sql.POLICIES} SELECT CAST(SUM(finalprice) AS DOUBLE) AS premium, COUNT(DISTINCT policycode) AS policies FROM policies "
    "WHERE start_date > DATE '1998-01-01' AND start_date < DATE '1998-12-31' AND end_date > DATE '1999-01-01'",
)
def m10_carried_over(spark, sf):
    return op.carried_over(adapters.policies(spark, sf), "1998-01-01", "1998-12-31", "1999-01-01")


@query(
    "m11_renewals",
    f"WITH {sql.POLICIES} SELECT certificate_no, COUNT(*) AS terms FROM policies GROUP BY 1 HAVING COUNT(*) > 1",
)
def m11_renewals(spark, sf):
    return op.renewals(adapters.policies(spark, sf))


@query(
    "m12_date_range",
    f"WITH {sql.POLICIES} SELECT CAST(MIN(start_date) AS VARCHAR) AS first_date, CAST(MAX(start_date) AS VARCHAR) AS last_date FROM policies",
)
def m12_date_range(spark, sf):
    return op.date_range(adapters.policies(spark, sf), "start_date")
