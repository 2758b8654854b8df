"""Registered queries: severity, backlog, concentration and leading indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.operators import severity as op
from claimflow.operators import summaries
from claimflow.operators.exposure import loss_ratio_monthly
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.exposure import LOSSES, MONTH, money, premium
from claimflow.plans.queries.registry import query
from claimflow.sources import adapters
from claimflow.sources.tables import stage

CUTS = (50_000, 150_000, 300_000)
SETTLED = "claim_status IN ('paid out', 'approved')"
SUBMITTED = "CAST(date_trunc('month', claim_submitted_date) AS DATE)"
BAND = (
    f"CASE WHEN compensation_total < {CUTS[0]} THEN 'low' WHEN compensation_total < {CUTS[1]} THEN 'moderate' "
    f"WHEN compensation_total < {CUTS[2]} THEN 'high' ELSE 'severe' END"
)
SERIES = (
    f"series AS (SELECT {SUBMITTED} AS calendar_month, COUNT(*) AS claim_count, "
    f"CAST(SUM(compensation_total) AS DOUBLE) / COUNT(*) AS severity FROM claims WHERE {SETTLED} GROUP BY 1)"
)


@query(
    "r1_frequency_severity",
    f"WITH {sql.CLAIMS}, {SERIES} SELECT CAST(s.calendar_month AS VARCHAR) AS calendar_month, s.claim_count, "
    "round(s.severity, 4) AS severity, round(CAST(s.claim_count - b.claim_count AS DOUBLE) / b.claim_count, 6) AS count_change, "
    "round((s.severity - b.severity) / b.severity, 6) AS severity_change FROM series s LEFT JOIN series b "
    "ON b.calendar_month + INTERVAL 1 MONTH = s.calendar_month",
)
def r1_frequency_severity(spark, sf):
    return op.frequency_severity(adapters.claims(spark, sf)).select(
        "calendar_month", "claim_count", money("severity", 4), money("count_change", 6), money("severity_change", 6)
    )


@query(
    "r2_severity_mix",
    f"WITH {sql.CLAIMS}, b AS (SELECT {SUBMITTED} AS calendar_month, {BAND} AS band FROM claims WHERE {SETTLED}) SELECT {MONTH}, "
    "COUNT(*) AS claim_count, "
    + ", ".join(f"COUNT(*) FILTER (WHERE band = '{b}') AS n_{b}" for b in op.BANDS)
    + ", round(CAST(COUNT(*) FILTER (WHERE band IN ('severe', 'high')) AS DOUBLE) / COUNT(*), 6) AS severe_high_share "
    "FROM b GROUP BY calendar_month",
)
def r2_severity_mix(spark, sf):
    mix = op.severity_mix(adapters.claims(spark, sf), CUTS)
    return mix.withColumn("severe_high_share", money("severe_high_share", 6))


@query(
    "r3_estimation_error",
    f"WITH {sql.CLAIMS}, p AS (SELECT {SUBMITTED} AS calendar_month, compensation_total AS c, "
    f"abs(total_claim_estimate - compensation_total) AS gap FROM claims WHERE {SETTLED} AND compensation_total <> 0) "
    f"SELECT {MONTH}, round(CAST(SUM(gap) AS DOUBLE) / CAST(SUM(c) AS DOUBLE), 6) AS total_error, "
    "round(AVG(CAST(gap AS DOUBLE) / CAST(c AS DOUBLE)), 6) AS mean_error FROM p GROUP BY calendar_month",
)
def r3_estimation_error(spark, sf):
    return op.estimation_error(adapters.claims(spark, sf)).select(
        "calendar_month", money("total_error", 6), money("mean_error", 6)
    )


SEGMENT = ["coverage"]
SETTLED_CENTS = (
    f"settled AS (SELECT *, {SUBMITTED} AS calendar_month, CAST(compensation_total * 100 AS BIGINT) AS c FROM claims WHERE {SETTLED})"
)


def bucket_floor(cents: str) -> str:
    """The least amount of the bucket an amount lies in: all but its eleven leading binary digits are zero."""
    unit = f"CAST(pow(2, greatest(length(bin({cents})) - 11, 0)) AS BIGINT)"
    return f"({cents} // {unit}) * {unit}"


def cuts_sql(source: str, keys: str) -> str:
    """cut_1 to cut_3 per key of `source` (keys, c): the largest amount in the bucket of each quantile."""
    shares = ", ".join(f"(CAST({s} AS DOUBLE), 'cut_{k}')" for k, s in enumerate(op.CUT_SHARES, 1))
    return f"""
places AS (SELECT {keys}, c, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY c) AS rn, COUNT(*) OVER (PARTITION BY {keys}) AS n FROM {source}),
asked(share, name) AS (VALUES {shares}),
exact AS (SELECT {keys}, share, name, n, c FROM places, asked WHERE rn = greatest(ceil(round(share * n, 6)), 1)),
tops AS (SELECT {keys}, {bucket_floor("c")} AS b, MAX(c) AS high FROM {source} GROUP BY ALL),
read AS (SELECT e.*, t.high FROM exact e JOIN tops t USING ({keys}) WHERE t.b = {bucket_floor("e.c")}),
cuts AS (SELECT {keys}, """ + ", ".join(f"MAX(high) FILTER (WHERE name = 'cut_{k}') AS cut_{k}" for k in (1, 2, 3)) + f" FROM read GROUP BY {keys})"


BAND_BY_CUTS = "CASE WHEN c < cut_1 THEN 'low' WHEN c < cut_2 THEN 'moderate' WHEN c < cut_3 THEN 'high' WHEN c >= cut_3 THEN 'severe' END"
MIX_BY_BAND = (
    "COUNT(*) AS claim_count, "
    + ", ".join(f"COUNT(*) FILTER (WHERE band = '{b}') AS n_{b}" for b in op.BANDS)
    + ", round(CAST(COUNT(*) FILTER (WHERE band IN ('severe', 'high')) AS DOUBLE) / COUNT(*), 6) AS severe_high_share"
)


def kept_summary(spark, sf):
    """The summary as a stage: what follows reads it and not the claims."""
    return stage(op.amount_summary(adapters.claims(spark, sf), SEGMENT), "amount-summary")


@query(
    "r2_cut_points",
    f"WITH {sql.CLAIMS}, {SETTLED_CENTS}, {cuts_sql('settled', 'coverage')} "
    "SELECT coverage, share, n, c / 100.0 AS exact, 1 AS within FROM exact",
)
def r2_cut_points(spark, sf):
    """Exact quantiles of every segment, and whether those of the merged summary lie above them by less than their error."""
    read = summaries.quantiles(summaries.merge(kept_summary(spark, sf), SEGMENT), SEGMENT, op.CUT_SHARES)
    # buckets of as many digits as an amount has hold one amount each
    whole = summaries.merge(op.amount_summary(adapters.claims(spark, sf), SEGMENT, bits=50), SEGMENT)
    exact = summaries.quantiles(whole, SEGMENT, op.CUT_SHARES).withColumnRenamed("amount", "exact")
    most = F.col("exact") * F.lit(1 + 2.0**-summaries.BITS)
    within = (F.col("amount") >= F.col("exact")) & (F.col("amount").cast("double") <= most)
    return exact.join(read.select(*SEGMENT, "share", "amount"), [*SEGMENT, "share"]).select(*SEGMENT, "share", "n", "exact", within.alias("within"))


@query(
    "r2_severity_mix_by_segment",
    f"WITH {sql.CLAIMS}, {SETTLED_CENTS}, {cuts_sql('settled', 'coverage')}, "
    f"b AS (SELECT calendar_month, {BAND_BY_CUTS} AS band FROM settled JOIN cuts USING (coverage)) SELECT {MONTH}, {MIX_BY_BAND} FROM b GROUP BY calendar_month",
)
def r2_severity_mix_by_segment(spark, sf):
    """The mix by cut points that come from the claims of each segment."""
    claims = adapters.claims(spark, sf)
    mix = op.band_mix(op.banded(claims, op.segment_cuts(kept_summary(spark, sf), SEGMENT), SEGMENT))
    return mix.withColumn("severe_high_share", money("severe_high_share", 6))


@query(
    "r2_severity_mix_trailing",
    f"WITH {sql.CLAIMS}, {SETTLED_CENTS}, ahead AS (SELECT DISTINCT calendar_month AS m FROM settled), "
    "before AS (SELECT m AS at_month, coverage, c FROM settled JOIN ahead ON calendar_month < m AND calendar_month >= m - INTERVAL 12 MONTH), "
    f"{cuts_sql('before', 'at_month, coverage')}, b AS (SELECT s.calendar_month, {BAND_BY_CUTS} AS band FROM settled s "
    "LEFT JOIN cuts ON s.coverage = cuts.coverage AND s.calendar_month = at_month) "
    f"SELECT {MONTH}, {MIX_BY_BAND} FROM b GROUP BY calendar_month",
)
def r2_severity_mix_trailing(spark, sf):
    """The mix of every month by cut points from the twelve months before it, merged from the kept summary."""
    cuts = op.trailing_cuts(kept_summary(spark, sf), SEGMENT)
    mix = op.band_mix(op.banded(adapters.claims(spark, sf), cuts, ["calendar_month", *SEGMENT]))
    return mix.withColumn("severe_high_share", money("severe_high_share", 6))


UNTIL = "2001-12-01"


@query(
    "r4_open_backlog",
    f"WITH {sql.CLAIMS}, {sql.months('1990-01-01', UNTIL)} SELECT {MONTH}, COUNT(*) AS open_claims FROM months JOIN claims "
    "ON claim_submitted_date <= last_day(calendar_month) AND (claim_approved_date IS NULL OR claim_approved_date > last_day(calendar_month)) "
    "GROUP BY calendar_month",
)
def r4_open_backlog(spark, sf):
    return op.open_backlog(adapters.claims(spark, sf), UNTIL)


@query(
    "r5_settlement_duration",
    f"WITH {sql.CLAIMS}, t AS (SELECT {BAND} AS band, CAST(claim_approved_date - claim_submitted_date AS INTEGER) AS d "
    f"FROM claims WHERE {SETTLED}) SELECT band, COUNT(*) AS claim_count, round(AVG(d), 6) AS mean_days, "
    "round(quantile_cont(d, 0.5), 6) AS median_days, round(quantile_cont(d, 0.9), 6) AS p90_days FROM t GROUP BY band",
)
def r5_settlement_duration(spark, sf):
    days = op.settlement_duration(adapters.claims(spark, sf), CUTS)
    return days.select("band", "claim_count", money("mean_days", 6), money("median_days", 6), money("p90_days", 6))


@query(
    "r5_settlement_duration_by_segment",
    f"WITH {sql.CLAIMS}, {SETTLED_CENTS}, {cuts_sql('settled', 'coverage')}, t AS (SELECT {BAND_BY_CUTS} AS band, "
    "CAST(claim_approved_date - claim_submitted_date AS INTEGER) AS d FROM settled JOIN cuts USING (coverage)) "
    "SELECT band, COUNT(*) AS claim_count, round(AVG(d), 6) AS mean_days, "
    "round(quantile_cont(d, 0.5), 6) AS median_days, round(quantile_cont(d, 0.9), 6) AS p90_days FROM t GROUP BY band",
)
def r5_settlement_duration_by_segment(spark, sf):
    """Durations by bands whose cut points come from the claims of each segment."""
    claims = adapters.claims(spark, sf)
    days = op.band_durations(op.banded(claims, op.segment_cuts(kept_summary(spark, sf), SEGMENT), SEGMENT))
    return days.select("band", "claim_count", money("mean_days", 6), money("median_days", 6), money("p90_days", 6))


def _top(share: float) -> str:
    return (
        f"SELECT CAST({share} AS DOUBLE) AS share, COUNT(*) AS top_claims, CAST(SUM(c) AS DOUBLE) AS top_amount, "
        "round(CAST(SUM(c) AS DOUBLE) / (SELECT CAST(SUM(c) AS DOUBLE) FROM ranked), 6) AS loss_share FROM ranked "
        f"WHERE rn <= (SELECT ceil(round({share} * COUNT(*), 6)) FROM ranked)"
    )


@query(
    "r6_loss_concentration",
    f"WITH {sql.CLAIMS}, ranked AS (SELECT compensation_total AS c, ROW_NUMBER() OVER (ORDER BY compensation_total DESC) AS rn "
    f"FROM claims WHERE {SETTLED}) {_top(0.05)} UNION ALL {_top(0.1)}",
)
def r6_loss_concentration(spark, sf):
    top = op.loss_concentration(adapters.claims(spark, sf), (0.05, 0.1))
    return top.withColumn("loss_share", money("loss_share", 6))


@query(
    "r7_large_loss_flag",
    f"WITH {sql.CLAIMS} SELECT claimnumber, CAST(claim_estimate_first >= 250000 AS INTEGER) AS large_loss FROM claims",
)
def r7_large_loss_flag(spark, sf):
    return op.large_loss_flag(adapters.claims(spark, sf), 250_000).select("claimnumber", "large_loss")


@query(
    "r8_stressed_loss_ratio",
    f"WITH {sql.EARNED}, {sql.CLAIMS}, {LOSSES}, stresses AS (SELECT unnest([0.05::DOUBLE, 0.10::DOUBLE, 0.15::DOUBLE]) AS stress) "
    f"SELECT {MONTH}, stress, round(CAST(incurred_losses AS DOUBLE) / earned_premium * (1 + stress), 6) AS stressed_loss_ratio "
    "FROM premium LEFT JOIN losses USING (calendar_month), stresses",
)
def r8_stressed_loss_ratio(spark, sf):
    ratios = loss_ratio_monthly(premium(spark, sf), adapters.claims(spark, sf))
    stressed = op.stressed_loss_ratio(ratios, (0.05, 0.10, 0.15))
    return stressed.withColumn("stressed_loss_ratio", money("stressed_loss_ratio", 6))


LAGS = (0, 1, 2, 3)


@query(
    "r9_lead_lag",
    f"WITH {sql.CLAIMS}, {SERIES}, lags AS (SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS lag) SELECT lag, COUNT(*) AS months, "
    "round(corr(CAST(a.claim_count AS DOUBLE), b.severity), 6) AS correlation FROM lags JOIN series a ON TRUE JOIN series b "
    "ON b.calendar_month = a.calendar_month + to_months(lag) GROUP BY lag",
)
def r9_lead_lag(spark, sf):
    series = op.frequency_severity(adapters.claims(spark, sf)).select("calendar_month", "claim_count", "severity")
    return op.lead_lag(series, "claim_count", "severity", LAGS).withColumn("correlation", money("correlation", 6))


@query(
    "r10_segment_cut",
    f"WITH {sql.CLAIMS} SELECT vehicle_type, coverage, damage_type, COUNT(*) AS claim_count, CAST(SUM(compensation_total) AS DOUBLE) "
    f"AS amount, round(CAST(SUM(compensation_total) AS DOUBLE) / COUNT(*), 4) AS severity FROM claims WHERE {SETTLED} GROUP BY 1, 2, 3",
)
def r10_segment_cut(spark, sf):
    return op.segment_cut(adapters.claims(spark, sf)).withColumn("severity", money("severity", 4))


@query(
    "r10_segment_subtotals",
    f"WITH {sql.CLAIMS} SELECT coverage, damage_type, COUNT(*) AS claim_count, CAST(SUM(compensation_total) AS DOUBLE) "
    f"AS amount, round(CAST(SUM(compensation_total) AS DOUBLE) / COUNT(*), 4) AS severity FROM claims "
    f"WHERE {SETTLED} AND vehicle_type = 'Private Passenger Vehicles' GROUP BY CUBE (coverage, damage_type)",
)
def r10_segment_subtotals(spark, sf):
    private = adapters.claims(spark, sf).where(F.col("vehicle_type") == "Private Passenger Vehicles")
    cut = op.segment_cut(private, ("coverage", "damage_type"), subtotals=True)
    return cut.withColumn("severity", money("severity", 4))
