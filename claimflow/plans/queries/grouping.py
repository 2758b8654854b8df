"""Registered queries: aggregates per key and choices of rows within a key."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.operators import grouping as op
from claimflow.operators import distinct, picking
from claimflow.plans.history import DEDUPE_KEYS, deduped_history
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import CLAIM, log, snapshot
from claimflow.sources import adapters
from claimflow.sources.tables import load, stage


@query(
    "f1_counts",
    f"WITH {sql.LOG} SELECT COUNT(*) AS rows_total, COUNT(DISTINCT claimnumber) AS claims, "
    "COUNT(DISTINCT CASE WHEN claim_status_name IN ('submitted', 'assessment pending', 'estimate pending') "
    "THEN claimnumber END) AS waiting_claims FROM log",
)
def f1_counts(spark, sf):
    waiting = F.col("claim_status_name").isin("submitted", "assessment pending", "estimate pending")
    per_claim = (
        log(spark, sf, "claimnumber", "claim_status_name")
        .groupBy("claimnumber")
        .agg(F.count(F.lit(1)).alias("n"), F.max(waiting).alias("waits"))
    )
    return per_claim.agg(
        F.sum("n").alias("rows_total"), F.count(F.lit(1)).alias("claims"), F.count_if("waits").alias("waiting_claims")
    )


@query(
    "f2_sum_min_max",
    f"WITH {sql.POLICIES} SELECT status_trans, CAST(SUM(finalprice) AS DOUBLE) AS premium, "
    "CAST(MIN(start_date) AS VARCHAR) AS first_start, CAST(MAX(end_date) AS VARCHAR) AS last_end FROM policies GROUP BY 1",
)
def f2_sum_min_max(spark, sf):
    return (
        adapters.policies(spark, sf)
        .groupBy("status_trans")
        .agg(
            F.sum("finalprice").alias("premium"), F.min("start_date").alias("first_start"), F.max("end_date").alias("last_end")
        )
    )


@query(
    "f3_duplicated_keys",
    f"WITH {sql.LOG} SELECT claimnumber, coverage, COUNT(*) AS n FROM log GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def f3_duplicated_keys(spark, sf):
    return op.duplicated_keys(log(spark, sf, "claimnumber", "coverage"), ["claimnumber", "coverage"])


@query(
    "f4_having_distinct",
    f"WITH {sql.LOG} SELECT claimnumber, CAST(COUNT(*) AS BIGINT) AS n, COUNT(DISTINCT coverage) AS n_distinct FROM log "
    "GROUP BY 1 HAVING COUNT(*) > 1 AND COUNT(DISTINCT coverage) = 1",
)
def f4_having_distinct(spark, sf):
    return op.having_distinct(log(spark, sf, "claimnumber", "coverage"), CLAIM, "coverage", F.expr("n > 1 and n_distinct = 1"))


@query(
    "f5_conditional_counts",
    f"WITH {sql.LOG} SELECT claimnumber, COUNT(*) FILTER (WHERE damage_type = '') AS blanks, "
    "COUNT(*) FILTER (WHERE compensation_total = 0) AS zeros FROM log GROUP BY 1 "
    "HAVING COUNT(DISTINCT damage_type) = 2 AND COUNT(*) FILTER (WHERE damage_type = '') > 0",
)
def f5_conditional_counts(spark, sf):
    rows = log(spark, sf, "claimnumber", "damage_type", "compensation_total")
    per_value = rows.groupBy("claimnumber", "damage_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("compensation_total") == 0).alias("zeros")
    )
    return (
        per_value.groupBy("claimnumber")
        .agg(
            F.count(F.lit(1)).alias("values"),
            F.sum(F.when(F.col("damage_type") == "", F.col("n")).otherwise(0)).alias("blanks"),
            F.sum("zeros").alias("zeros"),
        )
        .where("values = 2 and blanks > 0")
        .drop("values")
    )


@query(
    "f6_concat_distinct",
    f"WITH {sql.LOG} SELECT claimnumber, string_agg(DISTINCT coverage, ', ' ORDER BY coverage) AS coverages FROM log GROUP BY 1",
)
def f6_concat_distinct(spark, sf):
    return op.concat_distinct(log(spark, sf, "claimnumber", "coverage"), CLAIM, "coverage", ", ", "coverages")


@query(
    "f7_concat_all",
    f"WITH {sql.LOG} SELECT claimnumber, string_agg(damage_type, ',' ORDER BY damage_type) AS damages, "
    "COUNT(*) AS n_values FROM log WHERE damage_type <> '' GROUP BY 1",
)
def f7_concat_all(spark, sf):
    rows = log(spark, sf, "claimnumber", "damage_type").where("damage_type <> ''")
    counted = op.concat_all(rows, CLAIM, "damage_type", "damages")
    return counted.withColumn("damages", op.spelled(F.col("damages")))


@query(
    "f8_sum_over",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, coverage, CAST(SUM(compensation_total) OVER "
    "(PARTITION BY claimnumber, coverage) AS DOUBLE) AS compensation_total FROM log",
)
def f8_sum_over(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "coverage", "compensation_total")
    return op.sum_over(rows, ["claimnumber", "coverage"], "compensation_total")


@query(
    "f9_group_extreme",
    f"WITH {sql.SNAPSHOT} SELECT claim_status, CAST(claim_estimate_first AS DOUBLE) AS claim_estimate_first, "
    "MIN(coverage) AS coverage, COUNT(*) AS n FROM snapshot WHERE claim_status = 'cancelled' GROUP BY 1, 2",
)
def f9_group_extreme(spark, sf):
    return (
        snapshot(spark, sf, "claim_status", "claim_estimate_first", "coverage")
        .where("claim_status = 'cancelled'")
        .groupBy("claim_status", "claim_estimate_first")
        .agg(F.min("coverage").alias("coverage"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "f10_monthly",
    f"WITH {sql.LOG} SELECT CAST(CAST(date_trunc('month', updateddate) AS DATE) AS VARCHAR) AS calendar_month, "
    "CAST(SUM(compensation_total) AS DOUBLE) AS amount, COUNT(DISTINCT claimnumber) AS claims FROM log GROUP BY 1",
)
def f10_monthly(spark, sf):
    return op.monthly(
        log(spark, sf, "claimnumber", "updateddate", "compensation_total"),
        "updateddate",
        F.sum("compensation_total").alias("amount"),
        F.count_distinct("claimnumber").alias("claims"),
    )


@query(
    "f11_value_pairs",
    f"WITH {sql.LOG} SELECT CAST(total_claim_estimate AS DOUBLE) AS total_claim_estimate, claim_status_name, COUNT(*) AS n "
    "FROM log GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def f11_value_pairs(spark, sf):
    rows = log(spark, sf, "total_claim_estimate", "claim_status_name")
    return op.duplicated_keys(rows, ["total_claim_estimate", "claim_status_name"])


@query(
    "g1_exact_dedupe",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name, CAST(updateddate AS VARCHAR) AS updateddate FROM log "
    f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {', '.join(DEDUPE_KEYS)} ORDER BY updateddate, row_index) = 1",
)
def g1_exact_dedupe(spark, sf):
    rows = log(spark, sf, "row_index", "updateddate", *DEDUPE_KEYS)
    return deduped_history(rows).select("claimnumber", "row_index", "claim_status_name", "updateddate")


@query(
    "g2_first_per_status",
    "SELECT user_id, event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE event_type = 'purchase' "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
)
def g2_first_per_status(spark, sf):
    events = load(spark, sf, "events", ["event_id", "user_id", "ts", "event_type"])
    first = picking.first_per(events, ["user_id"], "ts", "event_id", F.col("event_type") == "purchase")
    return first.select("user_id", "event_id", F.to_date("ts").alias("day"))


@query(
    "g3_last_per_claim",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name, CAST(updateddate AS VARCHAR) AS updateddate FROM log "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY updateddate DESC, row_index DESC) = 1",
)
def g3_last_per_claim(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name", "updateddate")
    return picking.last_per(rows, CLAIM, "updateddate", "row_index")


@query(
    "g4_one_per_status_coverage",
    f"WITH {sql.LOG} SELECT claimnumber, claim_status_name, coverage, row_index FROM log QUALIFY ROW_NUMBER() OVER "
    "(PARTITION BY claimnumber, claim_status_name, coverage ORDER BY updateddate, row_index DESC) = 1",
)
def g4_one_per_status_coverage(spark, sf):
    rows = log(spark, sf, "claimnumber", "claim_status_name", "coverage", "row_index", "updateddate")
    keys = ["claimnumber", "claim_status_name", "coverage"]
    return picking.pick(rows, keys, [F.asc("updateddate"), F.desc("row_index")]).drop("updateddate")


@query(
    "g5_best_per_claim",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, CAST(claim_estimate AS DOUBLE) AS claim_estimate FROM snapshot "
    "QUALIFY RANK() OVER (PARTITION BY claimnumber ORDER BY claim_estimate DESC, compensation_total DESC) = 1",
)
def g5_best_per_claim(spark, sf):
    rows = snapshot(spark, sf, "claimnumber", "coverage", "claim_estimate", "compensation_total")
    measures = [F.col("claim_estimate"), F.col("compensation_total")]
    return picking.best_per(rows, CLAIM, measures).drop("compensation_total")


@query(
    "g6_break_ties",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, CAST(claim_estimate AS DOUBLE) AS claim_estimate FROM snapshot "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber ORDER BY claim_estimate DESC, compensation_total DESC, coverage) = 1",
)
def g6_break_ties(spark, sf):
    rows = snapshot(spark, sf, "claimnumber", "coverage", "claim_estimate", "compensation_total")
    best = picking.best_per(rows, CLAIM, [F.col("claim_estimate"), F.col("compensation_total")])
    return picking.dedupe(best, CLAIM, [F.asc("coverage")]).drop("compensation_total")


@query(
    "g7_duplicated_rows",
    f"WITH {sql.LOG} SELECT claimnumber, coverage, row_index FROM log "
    "QUALIFY COUNT(*) OVER (PARTITION BY claimnumber, coverage) > 1",
)
def g7_duplicated_rows(spark, sf):
    return picking.duplicated_rows(log(spark, sf, "claimnumber", "coverage", "row_index"), ["claimnumber", "coverage"])


@query(
    "g8_keep_last",
    f"WITH {sql.LOG} SELECT claimnumber, coverage, row_index, COUNT(*) OVER (PARTITION BY claimnumber, coverage) AS group_size "
    "FROM log QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, coverage ORDER BY updateddate DESC, row_index DESC) = 1",
)
def g8_keep_last(spark, sf):
    rows = log(spark, sf, "claimnumber", "coverage", "row_index", "updateddate")
    return picking.keep_last(rows, ["claimnumber", "coverage"], ["updateddate", "row_index"]).drop("updateddate")


@query(
    "g9_at_latest_date",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, CAST(updateddate AS VARCHAR) AS updateddate FROM log "
    "QUALIFY updateddate = MAX(updateddate) OVER (PARTITION BY claimnumber)",
)
def g9_at_latest_date(spark, sf):
    return picking.at_latest(log(spark, sf, "claimnumber", "row_index", "updateddate"), CLAIM, "updateddate")


@query(
    "f1_distinct_by_sketch",
    """WITH held AS (SELECT DISTINCT CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) AS DATE) AS q, o_custkey AS c FROM orders),
stays AS (SELECT a.q, COUNT(*) AS n FROM held a JOIN held b ON b.c = a.c AND b.q = a.q + INTERVAL 3 MONTH GROUP BY a.q)
SELECT CAST(held.q AS VARCHAR) AS quarter, COUNT(*) AS customers, 1 AS within, COALESCE(ANY_VALUE(stays.n), 0) AS also_next, 1 AS next_within
FROM held LEFT JOIN stays ON stays.q = held.q GROUP BY held.q""",
)
def f1_distinct_by_sketch(spark, sf):
    """Customers of a quarter, and those it shares with the next, exact and by the united sketches of its months.

    `within` tells whether the sketches are off by no more than four standard errors.
    """
    policies = adapters.policies(spark, sf).select("customercode", F.trunc("start_date", "MM").alias("month"), F.trunc("start_date", "quarter").alias("quarter"))
    monthly_sketches = stage(distinct.sketches(policies, ["month"], "customercode"), "customer-sketches")
    kept = distinct.unite(monthly_sketches.withColumn("quarter", F.trunc("month", "quarter")), ["quarter"])
    before = kept.withColumn("quarter", F.add_months("quarter", -3))
    read = distinct.counted(kept).join(distinct.shared(kept, before, ["quarter"]), "quarter", "left")
    held = policies.select("quarter", "customercode").distinct()
    # a customer's quarters: each says whether the one after is among them
    told = held.unionByName(held.withColumn("quarter", F.add_months("quarter", -3)).withColumn("later", F.lit(1)), allowMissingColumns=True)
    pairs = told.groupBy("quarter", "customercode").agg(F.count_if(F.col("later").isNull()).alias("own"), F.count("later").alias("next"))
    exact = pairs.where("own > 0").groupBy("quarter").agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("next") > 0).alias("also_next"))
    most = 4 * distinct.error()
    both = F.abs(F.coalesce("n_shared", F.lit(0)) - F.col("also_next")) <= most * 2 * F.col("customers") + 0.5
    return exact.join(read, "quarter").select(
        "quarter", "customers", (F.abs(F.col("n") - F.col("customers")) <= most * F.col("customers")).alias("within"), "also_next", both.alias("next_within")
    )
