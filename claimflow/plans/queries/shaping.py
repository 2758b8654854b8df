"""Registered queries: profiles, projection, renames, casts, column tests, distinct values."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.functions.expressions import parse_money
from claimflow.operators import shaping as op
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import snapshot
from claimflow.sources import adapters
from claimflow.sources.contracts import POLICY
from claimflow.sources.tables import load

LOG_PROFILE = ("claimnumber", "claim_status_name", "updateddate", "flex_ngay_duyet", "pham_vi", "uoc_bt_ban_dau", "stbt_truoc_thue")
SNAP_PROFILE = ("claimnumber", "statusname", "updateddate", "uoc_bt_ban_dau", "stbt_truoc_thue", "processdays")


def _profile_sql(columns: tuple[str, ...], table: str) -> str:
    parts = [
        f"SELECT {i} AS position, '{c}' AS column_name, 'string' AS type, COUNT(*) AS \"rows\", "
        f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
        f"CAST(COUNT(*) FILTER (WHERE trim({c}) IN ('', '-')) AS BIGINT) AS markers, "
        f"CAST(MAX(strlen({c})) AS BIGINT) AS max_bytes FROM {table}"
        for i, c in enumerate(columns, start=1)
    ]
    return " UNION ALL ".join(parts)


@query("a7_profile_table", f"WITH {sql.RAW_LOG} {_profile_sql(LOG_PROFILE, 'raw_log')}")
def a7_profile_table(spark, sf):
    return op.profile(adapters.status_log_raw(spark, sf, LOG_PROFILE))


@query(
    "a7_schema_diff",
    f"WITH {sql.RAW_LOG}, {sql.RAW_SNAPSHOT}, a AS ({_profile_sql(LOG_PROFILE, 'raw_log')}), "
    f"b AS ({_profile_sql(SNAP_PROFILE, 'raw_snapshot')}) "
    "SELECT COALESCE(a.column_name, b.column_name) AS column_name, a.type AS type_a, a.nulls + a.markers AS missing_a, "
    "b.type AS type_b, b.nulls + b.markers AS missing_b, "
    "CASE WHEN b.type IS NULL THEN 'only a' WHEN a.type IS NULL THEN 'only b' ELSE 'both' END AS presence "
    "FROM a FULL JOIN b ON a.column_name = b.column_name",
)
def a7_schema_diff(spark, sf):
    return op.schema_diff(
        adapters.status_log_raw(spark, sf, LOG_PROFILE), adapters.snapshot_raw(spark, sf, SNAP_PROFILE)
    )


@query(
    "a7_distinct_counts",
    f"WITH {sql.RAW_LOG}, {sql.RAW_SNAPSHOT} SELECT 'log' AS source, COUNT(*) AS rows, COUNT(DISTINCT claimnumber) AS distinct_claimnumber, "
    "COUNT(DISTINCT policycode) AS distinct_policycode FROM raw_log UNION ALL SELECT 'snapshot', COUNT(*), COUNT(DISTINCT claimnumber), "
    "COUNT(DISTINCT policycode) FROM raw_snapshot",
)
def a7_distinct_counts(spark, sf):
    keys = ("claimnumber", "policycode")
    sources = {"log": adapters.status_log_raw(spark, sf, keys), "snapshot": adapters.snapshot_raw(spark, sf, keys)}
    return op.distinct_counts(sources, keys)


@query(
    "b1_project_snapshot",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, claim_status, CAST(claim_submitted_date AS VARCHAR) "
    "AS claim_submitted_date, CAST(claim_approved_date AS VARCHAR) AS claim_approved_date, "
    "CAST(updateddate AS VARCHAR) AS updateddate, CAST(compensation_total AS DOUBLE) AS compensation_total, "
    "CAST(total_claim_estimate AS DOUBLE) AS total_claim_estimate, processdays, customer_type FROM snapshot",
)
def b1_project_snapshot(spark, sf):
    return snapshot(
        spark,
        sf,
        "claimnumber",
        "coverage",
        "claim_status",
        "claim_submitted_date",
        "claim_approved_date",
        "updateddate",
        "compensation_total",
        "total_claim_estimate",
        "processdays",
        "customer_type",
    )


RENAMES = {f.source: f.target for f in POLICY if f.source != f.target}


@query(
    "b2_rename_policy",
    f"WITH {sql.RAW_POLICIES} SELECT sogcn AS certificate_no, policycode, ngaybatdau AS start_date, "
    "ngayketthuc AS end_date, hangxe AS vehicle_make, mdsd AS vehicle_usage, tinhthanhchuxe AS regions_customer "
    "FROM raw_policies",
)
def b2_rename_policy(spark, sf):
    return op.rename(adapters.policies_raw(spark, sf), RENAMES).select(
        "certificate_no", "policycode", "start_date", "end_date", "vehicle_make", "vehicle_usage", "regions_customer"
    )


@query(
    "b3_cast_columns",
    f"WITH {sql.RAW_POLICIES} SELECT policycode, TRY_CAST(sochongoi AS INTEGER) AS sochongoi, "
    f"CAST({sql.money('lpx')} AS DOUBLE) AS lpx FROM raw_policies",
)
def b3_cast_columns(spark, sf):
    raw = adapters.policies_raw(spark, sf).withColumn("lpx", F.regexp_replace("lpx", ",", ""))
    return op.cast_columns(raw, {"sochongoi": "int", "lpx": "decimal(15,2)"}).select("policycode", "sochongoi", "lpx")


@query(
    "b4_add_empty",
    f"WITH {sql.RAW_POLICIES} SELECT policycode, CAST(NULL AS VARCHAR) AS reviewed_date, CAST(NULL AS VARCHAR) AS reviewer FROM raw_policies",
)
def b4_add_empty(spark, sf):
    raw = adapters.policies_raw(spark, sf, ["policycode"])
    return op.add_empty(raw, {"reviewed_date": "date", "reviewer": "string"})


@query(
    "b5_drop_columns",
    f"WITH {sql.RAW_POLICIES} SELECT sogcn, policycode, customercode, status_trans FROM raw_policies",
)
def b5_drop_columns(spark, sf):
    raw = adapters.policies_raw(spark, sf).select("sogcn", "policycode", "customercode", "status_trans", "assigneename")
    return op.drop_columns(raw, ["assigneename"])


@query(
    "b6_row_index_unique",
    "SELECT l_orderkey, COUNT(*) AS n_rows, COUNT(*) AS n_indexes FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_orderkey",
)
def b6_row_index_unique(spark, sf):
    lines = op.with_row_index(load(spark, sf, "lineitem")).dropDuplicates()
    return lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_index").alias("n_indexes")
    )


ZERO_TEST = ("cost_cuuho", "cost_3rdparty", "compensation_amount", "stbt")


@query(
    "b7_zero_columns",
    f"WITH {sql.RAW_SNAPSHOT} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(MAX(abs({sql.money(c)})) AS DOUBLE) AS max_abs, "
        f"CAST(COALESCE(MAX(abs({sql.money(c)})), 0) = 0 AS INTEGER) AS all_zero FROM raw_snapshot"
        for c in ZERO_TEST
    ),
)
def b7_zero_columns(spark, sf):
    raw = adapters.snapshot_raw(spark, sf, ZERO_TEST).select(*[parse_money(c).alias(c) for c in ZERO_TEST])
    return op.zero_columns(raw, ZERO_TEST)


@query("b8_max_text_length", "SELECT MAX(strlen(text)) AS max_bytes FROM documents")
def b8_max_text_length(spark, sf):
    return op.max_length(load(spark, sf, "documents", ["text"]), "text")


@query(
    "b9_distinct_values",
    f"WITH {sql.RAW_LOG} SELECT DISTINCT claim_status_name, loai_hinh, pham_vi FROM raw_log",
)
def b9_distinct_values(spark, sf):
    return op.distinct_values(adapters.status_log_raw(spark, sf), ["claim_status_name", "loai_hinh", "pham_vi"])


