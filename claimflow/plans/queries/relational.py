"""Registered queries: filters, drill-through, key-set joins, updates and deletes between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import relational as op
from claimflow.operators.exposure import calendar
from claimflow.operators.grouping import duplicated_keys, monthly
from claimflow.plans import history
from claimflow.plans import snapshot as snapshots
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.functions.expressions import parse_money
from claimflow.operators.shaping import Field
from claimflow.sources import adapters, stages, tables

CLAIM = ["claimnumber"]


def log(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The cleaned status log; with columns named, only those are derived at all."""
    raw = adapters.status_log_raw(spark, sf, [f.source for f in history.source_fields(columns)])
    return history.clean_history(raw, *columns)


def snapshot(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The cleaned snapshot; with columns named, only those are derived at all."""
    raw = adapters.snapshot_raw(spark, sf, [f.source for f in snapshots.source_fields(columns)])
    return snapshots.clean_snapshot(raw, *columns)


@query(
    "d1_filter_categories",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name, coverage FROM log "
    "WHERE claim_status_name IN ('submitted', 'assessment pending', 'estimate pending') AND coverage <> 'Collision coverage'",
)
def d1_filter_categories(spark, sf):
    waiting = F.col("claim_status_name").isin("submitted", "assessment pending", "estimate pending")
    return log(spark, sf, "claimnumber", "row_index", "claim_status_name", "coverage").where(
        waiting & (F.col("coverage") != "Collision coverage")
    )


@query(
    "d3_filter_date_window",
    f"WITH {sql.POLICIES} SELECT policycode, CAST(start_date AS VARCHAR) AS start_date FROM policies "
    "WHERE start_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND end_date > DATE '1999-01-01'",
)
def d3_filter_date_window(spark, sf):
    return (
        adapters.policies(spark, sf)
        .where(F.col("start_date").between("1998-01-01", "1998-12-31") & (F.col("end_date") > "1999-01-01"))
        .select("policycode", "start_date")
    )


@query(
    "d6_claim_history",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name, CAST(updateddate AS VARCHAR) AS updateddate "
    "FROM log WHERE claimnumber IN (SELECT claimnumber FROM log WHERE claim_status_name = 'documents pending')",
)
def d6_claim_history(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name", "updateddate")
    waiting = rows.where(F.col("claim_status_name") == "documents pending")
    return op.drill_through(rows, waiting, CLAIM, ["claimnumber", "updateddate", "row_index"])


def bucketed(df: DataFrame, name: str, sort: list[str]) -> DataFrame:
    """A table of eight buckets by claim under a name and a path of its own."""
    path = tables.new_path(df.sparkSession, name)
    return tables.save_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), CLAIM, 8, [*CLAIM, *sort], path)


@query(
    "d6_drill_through_bucketed",
    f"WITH {sql.LOG}, waiting AS (SELECT DISTINCT claimnumber FROM log WHERE claim_status_name = 'documents pending') "
    "SELECT claimnumber, row_index, claim_status_name, CAST(updateddate AS VARCHAR) AS updateddate FROM log JOIN waiting USING (claimnumber) "
    "WHERE updateddate BETWEEN DATE '1995-01-01' AND DATE '1997-06-30'",
)
def d6_drill_through_bucketed(spark, sf):
    """Histories of some claims in a span of dates out of a log that is bucketed by claim: no row of it is shuffled."""
    rows = bucketed(log(spark, sf, "claimnumber", "row_index", "claim_status_name", "updateddate"), "log", ["updateddate"])
    waiting = bucketed(rows.where(F.col("claim_status_name") == "documents pending").select(*CLAIM).distinct(), "waiting", [])
    dated = rows.where(F.col("updateddate").between(F.lit("1995-01-01").cast("date"), F.lit("1997-06-30").cast("date")))
    return dated.join(waiting.hint("merge"), CLAIM, "left_semi")


@query(
    "d7_delete_where",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name FROM log "
    "WHERE NOT (COALESCE(claim_status_name <> 'approved' AND compensation_total = 0, FALSE) OR claim_status_name = 'submitted')",
)
def d7_delete_where(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name", "compensation_total")
    name = F.col("claim_status_name")
    rows = op.delete_where(rows, (name != "approved") & (F.col("compensation_total") == 0))
    return op.delete_where(rows, name == "submitted").drop("compensation_total")


@query(
    "e1_rows_of_keys",
    f"WITH {sql.LOG} SELECT l.claimnumber, l.row_index, l.claim_status_name FROM log l JOIN "
    "(SELECT claimnumber FROM log GROUP BY claimnumber HAVING COUNT(*) > 5) s ON l.claimnumber = s.claimnumber",
)
def e1_rows_of_keys(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name")
    many = rows.groupBy("claimnumber").agg(F.count(F.lit(1)).alias("n")).where("n > 5")
    return op.rows_of(rows, many, CLAIM)


@query(
    "e2_compare_sources",
    f"WITH {sql.LOG}, {sql.SNAPSHOT}, one AS (SELECT claimnumber, MAX(total_claim_estimate) AS total_claim_estimate, "
    "MAX(compensation_total) AS compensation_total FROM snapshot GROUP BY claimnumber) "
    "SELECT l.claimnumber, row_index, CAST(l.total_claim_estimate AS DOUBLE) AS total_claim_estimate, "
    "CAST(o.total_claim_estimate AS DOUBLE) AS total_claim_estimate_other, "
    "CAST(o.compensation_total AS DOUBLE) AS compensation_total_other, "
    "CAST(l.compensation_total AS DOUBLE) AS compensation_total FROM log l JOIN one o USING (claimnumber)",
)
def e2_compare_sources(spark, sf):
    amounts = ["total_claim_estimate", "compensation_total"]
    per_claim = snapshot(spark, sf, "claimnumber", *amounts).groupBy("claimnumber").agg(*[F.max(c).alias(c) for c in amounts])
    return op.compare(log(spark, sf, "claimnumber", "row_index", *amounts), per_claim, CLAIM, amounts)


@query(
    "e3_missing_in_snapshot",
    f"WITH {sql.LOG}, {sql.SNAPSHOT} SELECT DISTINCT l.claimnumber FROM log l LEFT JOIN snapshot s "
    "ON l.claimnumber = s.claimnumber WHERE s.claimnumber IS NULL",
)
def e3_missing_in_snapshot(spark, sf):
    return op.keys_only_in(log(spark, sf, "claimnumber"), snapshot(spark, sf, "claimnumber"), CLAIM)


@query(
    "e4_not_in_history",
    f"WITH {sql.LOG}, {sql.SNAPSHOT} SELECT claimnumber, coverage, claim_status FROM snapshot "
    "WHERE claimnumber NOT IN (SELECT claimnumber FROM log)",
)
def e4_not_in_history(spark, sf):
    return op.missing_in(
        snapshot(spark, sf, "claimnumber", "coverage", "claim_status"), log(spark, sf, "claimnumber"), CLAIM
    )


@query(
    "e5_present_in_snapshot",
    f"WITH {sql.LOG}, {sql.SNAPSHOT} SELECT claimnumber, row_index, claim_status_name FROM log "
    "WHERE claimnumber IN (SELECT claimnumber FROM snapshot WHERE claim_status = 'paid out')",
)
def e5_present_in_snapshot(spark, sf):
    paid = snapshot(spark, sf, "claimnumber", "claim_status").where("claim_status = 'paid out'")
    return op.present_in(log(spark, sf, "claimnumber", "row_index", "claim_status_name"), paid, CLAIM)


@query(
    "e6_exists_submitted",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, CAST(updateddate AS VARCHAR) AS updateddate FROM log t "
    "WHERE EXISTS (SELECT 1 FROM log s WHERE s.claimnumber = t.claimnumber AND s.claim_status_name = 'submitted')",
)
def e6_exists_submitted(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "updateddate", "claim_status_name")
    submitted = rows.where(F.col("claim_status_name") == "submitted")
    return op.present_in(rows, submitted, CLAIM).drop("claim_status_name")


@query(
    "e7_left_enrichment",
    f"WITH {sql.POLICIES}, {sql.CLAIMS}, {sql.months('1995-01-01', '2003-12-01')}, "
    "p AS (SELECT CAST(date_trunc('month', start_date) AS DATE) AS m, COUNT(*) AS n FROM policies GROUP BY 1), "
    "c AS (SELECT CAST(date_trunc('month', claim_submitted_date) AS DATE) AS m, COUNT(*) AS n FROM claims GROUP BY 1) "
    "SELECT CAST(calendar_month AS VARCHAR) AS calendar_month, COALESCE(p.n, 0) AS started, COALESCE(c.n, 0) AS submitted "
    "FROM months LEFT JOIN p ON p.m = calendar_month LEFT JOIN c ON c.m = calendar_month",
)
def e7_left_enrichment(spark, sf):
    started = monthly(adapters.policies(spark, sf), "start_date", F.count(F.lit(1)).alias("started"))
    submitted = monthly(adapters.claims(spark, sf), "claim_submitted_date", F.count(F.lit(1)).alias("submitted"))
    spine = calendar(spark, "1995-01-01", "2003-12-01")
    joined = spine.join(started, "calendar_month", "left").join(submitted, "calendar_month", "left")
    return joined.fillna(0, ["started", "submitted"])


@query(
    "e8_expand_months",
    f"WITH {sql.POLICIES}, {sql.months('1990-01-01', '2012-12-01')} SELECT m.calendar_month::VARCHAR AS calendar_month, "
    "status_trans, COUNT(*) AS policies FROM months m JOIN policies p ON m.calendar_month BETWEEN "
    "date_trunc('month', p.start_date) AND date_trunc('month', p.end_date) GROUP BY 1, 2",
)
def e8_expand_months(spark, sf):
    spans = (
        adapters.policies(spark, sf)
        .groupBy(F.trunc("start_date", "MM").alias("first"), F.trunc("end_date", "MM").alias("last"), "status_trans")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        op.expand_months(spans, "first", "last")
        .groupBy("calendar_month", "status_trans")
        .agg(F.sum("n").alias("policies"))
    )


@query(
    "e9_update_from",
    f"WITH {sql.LOG}, {sql.SNAPSHOT}, src AS (SELECT claimnumber, MAX(total_claim_estimate) AS total_claim_estimate "
    "FROM snapshot GROUP BY claimnumber) SELECT l.claimnumber, row_index, CAST(CASE WHEN s.claimnumber IS NOT NULL "
    "AND (l.total_claim_estimate IS NULL OR l.total_claim_estimate = 0) THEN s.total_claim_estimate "
    "ELSE l.total_claim_estimate END AS DOUBLE) AS total_claim_estimate FROM log l LEFT JOIN src s USING (claimnumber)",
)
def e9_update_from(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "total_claim_estimate")
    source = (
        snapshot(spark, sf, "claimnumber", "total_claim_estimate")
        .groupBy("claimnumber")
        .agg(F.max("total_claim_estimate").alias("total_claim_estimate"))
    )
    unset = F.col("total_claim_estimate").isNull() | (F.col("total_claim_estimate") == 0)
    return op.update_from(rows, source, CLAIM, ["total_claim_estimate"], unset)


@query(
    "e10_set_where_in",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, CASE WHEN claim_status_name = 'in process' AND claimnumber IN "
    "(SELECT claimnumber FROM log WHERE claim_status_name = 'documents pending') THEN 'documents pending' "
    "ELSE claim_status_name END AS claim_status_name FROM log",
)
def e10_set_where_in(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name")
    keys = rows.where(F.col("claim_status_name") == "documents pending")
    return op.set_where_in(
        rows,
        keys,
        CLAIM,
        {"claim_status_name": F.lit("documents pending")},
        F.col("claim_status_name") == "in process",
    )


@query(
    "e11_delete_matching",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name FROM log WHERE NOT (claim_status_name <> 'paid out' "
    "AND claimnumber IN (SELECT claimnumber FROM log WHERE claim_status_name = 'paid out'))",
)
def e11_delete_matching(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name")
    paid = rows.where(F.col("claim_status_name") == "paid out")
    return op.delete_matching(rows, paid, CLAIM, F.col("claim_status_name") != "paid out")


@query(
    "e12_delete_zero_of_multi_row",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, claim_status, CAST(compensation_total AS DOUBLE) AS compensation_total "
    "FROM snapshot WHERE NOT COALESCE(claim_status IN ('paid out', 'approved') AND compensation_total = 0 AND claimnumber IN "
    "(SELECT claimnumber FROM snapshot GROUP BY claimnumber HAVING COUNT(*) > 1), FALSE)",
)
def e12_delete_zero_of_multi_row(spark, sf):
    rows = snapshot(spark, sf, "claimnumber", "coverage", "claim_status", "compensation_total")
    several = duplicated_keys(rows, CLAIM)
    zero = F.col("claim_status").isin("paid out", "approved") & (F.col("compensation_total") == 0)
    return op.delete_matching(rows, several, CLAIM, zero)


@query(
    "a4_append_rows",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name FROM log WHERE claim_status_name = 'estimate pending' "
    "UNION ALL SELECT claimnumber, row_index, claim_status_name FROM log WHERE claim_status_name = 'documents pending'",
)
def a4_append_rows(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name")
    name = F.col("claim_status_name")
    return op.append_rows(rows.where(name == "estimate pending"), rows.where(name == "documents pending"))


@query(
    "a2_save_stage",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name FROM log WHERE claim_status_name = 'estimate pending'",
)
def a2_save_stage(spark, sf):
    rows = log(spark, sf, "claimnumber", "row_index", "claim_status_name")
    return tables.stage(rows.where(F.col("claim_status_name") == "estimate pending"), "estimate-pending")


DECIDED = "claim_status = 'in process' AND updateddate >= DATE '1997-01-01'"


@query(
    "a2_rewrite_partitions",
    f"WITH {sql.CLAIMS} SELECT claimnumber, CASE WHEN {DECIDED} AND year(claim_submitted_date) = 1996 THEN 'approved' ELSE claim_status END AS claim_status, "
    f"CASE WHEN {DECIDED} AND year(claim_submitted_date) = 1996 THEN CAST(updateddate AS VARCHAR) ELSE CAST(claim_approved_date AS VARCHAR) END AS claim_approved_date, "
    "year(claim_submitted_date) AS year FROM claims",
)
def a2_rewrite_partitions(spark, sf):
    """A stage by year in which a status update reads and replaces the one year it touches, twice with the same outcome."""
    columns = ("claimnumber", "claim_status", "claim_approved_date", "updateddate")
    claims = adapters.claims(spark, sf).select(*columns, F.year("claim_submitted_date").alias("year"))
    path = tables.new_path(spark, "claims-by-year")
    written = tables.save_stage(claims, path, ["year"])
    decided = (F.col("claim_status") == "in process") & (F.col("updateddate") >= F.lit("1997-01-01").cast("date"))
    changes = written.where((F.col("year") == 1996) & decided).select(
        "claimnumber", "year", F.lit("approved").alias("claim_status"), F.col("updateddate").alias("claim_approved_date")
    )
    changes = tables.stage(changes, "decisions")
    for _ in range(2):
        stages.rewrite_partitions(path, changes, "year", ["claimnumber"], ["claim_status", "claim_approved_date"])
    return spark.read.parquet(path).select("claimnumber", "claim_status", "claim_approved_date", "year")


EXPORT = "policycode string, customercode string, start_date string, finalprice string"
EXPORT_CONTRACT = (Field("start_date", "start_date", "date", "dd/MM/yyyy"), Field("finalprice", "finalprice", "money"))


@query(
    "a1_text_with_rejects",
    """WITH lines AS (SELECT o_orderkey AS k, 'P' || o_orderkey AS policycode, round(o_totalprice * 100) AS cents,
  CASE WHEN o_orderkey % 61 = 5 OR o_orderkey % 67 = 6 THEN 'columns' WHEN o_orderkey % 71 = 7 AND o_orderkey % 73 = 8
    THEN 'unreadable start_date,unreadable finalprice' WHEN o_orderkey % 71 = 7 THEN 'unreadable start_date'
    WHEN o_orderkey % 73 = 8 THEN 'unreadable finalprice' ELSE 'read' END AS outcome FROM orders)
SELECT outcome, COUNT(*) AS lines, CAST(SUM(CASE WHEN outcome = 'read' THEN cents END) AS DOUBLE) / 100 AS amount FROM lines GROUP BY outcome""",
)
def a1_text_with_rejects(spark, sf):
    """Policies written as text with lines that miss or repeat a column or hold values that cannot be read, and read again."""
    k = F.col("o_orderkey")
    price = F.format_number(F.col("o_totalprice").cast("decimal(15,2)"), 2)
    values = F.struct(
        F.concat(F.lit("P"), k).alias("policycode"),
        F.concat(F.lit("KH"), F.col("o_custkey")).alias("customercode"),
        F.when(k % 71 == 7, "31/02/x").otherwise(F.date_format(F.to_date("o_orderdate"), "dd/MM/yyyy")).alias("start_date"),
        F.when(k % 73 == 8, F.concat(price, F.lit(" vnd"))).otherwise(price).alias("finalprice"),
    )
    line = F.to_csv(values, {"quote": '"', "escape": '"'})
    line = F.when(k % 61 == 5, F.concat(F.lit("P"), k)).when(k % 67 == 6, F.concat(line, F.lit(",more"))).otherwise(line)
    path = tables.new_path(spark, "export")
    tables.load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).select(line.alias("value")).write.text(path)
    read, rejected = tables.load_text_checked(spark, path, EXPORT, EXPORT_CONTRACT, header=False)
    outcomes = read.select(F.lit("read").alias("outcome"), parse_money("finalprice").alias("amount")).unionByName(
        rejected.select(F.array_join("reasons", ",").alias("outcome"), F.lit(None).cast("decimal(15,2)").alias("amount"))
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount"))


@query("a3_fill_cloned_table", f"WITH {sql.LOG} SELECT claimnumber, row_index, coverage FROM log")
def a3_fill_cloned_table(spark, sf):
    """A table of the same schema, filled in two steps."""
    rows = log(spark, sf, "claimnumber", "row_index", "coverage")
    path = tables.new_path(spark, "clone")
    tables.save_stage(rows.limit(0), path)
    collision = F.col("coverage") == "Collision coverage"
    tables.append_stage(rows.where(collision), path)
    tables.append_stage(rows.where(~collision), path)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "h1_sorted_policies",
    f"WITH {sql.POLICIES} SELECT certificate_no, policycode, CAST(start_date AS VARCHAR) AS start_date FROM policies "
    "WHERE createddate > start_date ORDER BY certificate_no, policycode",
)
def h1_sorted_policies(spark, sf):
    return (
        adapters.policies(spark, sf)
        .where(F.col("createddate") > F.col("start_date"))
        .select("certificate_no", "policycode", "start_date")
        .orderBy("certificate_no", "policycode")
    )

