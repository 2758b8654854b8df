"""Registered queries: missing values, money, dates, categories, corrections, text classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.functions.expressions import full_months, map_value, month_key, parse_date, parse_money, ratio, to_day
from claimflow.operators import cleaning as op
from claimflow.operators.phrases import find_phrases, phrase_counts
from claimflow.plans.policies import clean_policies
from claimflow.plans.queries import expected
from claimflow.plans.queries import fragments as sql
from claimflow.plans.queries.registry import query
from claimflow.plans.queries.relational import log, snapshot
from claimflow.sources import adapters
from claimflow.sources.contracts import DMY, DMY_DASH, STAMP
from claimflow.sources.tables import load


@query(
    "c1_rows_missing",
    f"WITH {sql.RAW_POLICIES} SELECT policycode, ngaybatdau, mdsd FROM raw_policies "
    "WHERE ngaybatdau IS NULL OR trim(ngaybatdau) IN ('', '-') OR mdsd IS NULL OR trim(mdsd) IN ('', '-')",
)
def c1_rows_missing(spark, sf):
    return op.rows_missing(adapters.policies_raw(spark, sf), ["ngaybatdau", "mdsd"]).select(
        "policycode", "ngaybatdau", "mdsd"
    )


@query(
    "c2_null_if_missing",
    f"WITH {sql.RAW_LOG} SELECT claimnumber, row_index, NULLIF(flex_ngay_duyet, '') AS flex_ngay_duyet, "
    "NULLIF(ngay_thanh_toan, '') AS ngay_thanh_toan FROM raw_log",
)
def c2_null_if_missing(spark, sf):
    columns = ["flex_ngay_duyet", "ngay_thanh_toan"]
    return op.null_if_missing(adapters.status_log_raw(spark, sf), columns).select("claimnumber", "row_index", *columns)


C3 = ("ubt", "uoc_bt_ban_dau", "stbt_truoc_thue")


@query(
    "c3_zero_if_missing",
    f"WITH {sql.RAW_LOG} SELECT claimnumber, row_index, "
    + ", ".join(f"CAST({sql.money0(c)} AS DOUBLE) AS {c}" for c in C3)
    + " FROM raw_log",
)
def c3_zero_if_missing(spark, sf):
    return op.zero_if_missing(adapters.status_log_raw(spark, sf), C3).select("claimnumber", "row_index", *C3)


@query(
    "c4_zero_if_any_missing",
    f"WITH {sql.RAW_LOG} SELECT claimnumber, row_index, "
    + ", ".join(
        f"CAST(CASE WHEN ubt = '' OR uoc_bt_ban_dau = '' THEN 0 ELSE {sql.money(c)} END AS DOUBLE) AS {c}" for c in C3[:2]
    )
    + " FROM raw_log",
)
def c4_zero_if_any_missing(spark, sf):
    return op.zero_if_any_missing(adapters.status_log_raw(spark, sf), C3[:2]).select("claimnumber", "row_index", *C3[:2])


@query(
    "c5_label_if_missing",
    f"WITH {sql.RAW_SNAPSHOT} SELECT claimnumber, loai_hinh_trans, CASE WHEN nguyen_nhan_ton_that IN ('', '-') "
    "THEN 'Unknown' ELSE nguyen_nhan_ton_that END AS nguyen_nhan_ton_that FROM raw_snapshot",
)
def c5_label_if_missing(spark, sf):
    return op.label_if_missing(adapters.snapshot_raw(spark, sf), "nguyen_nhan_ton_that", "Unknown").select(
        "claimnumber", "loai_hinh_trans", "nguyen_nhan_ton_that"
    )


C6 = ("finalprice", "tndsbb", "lpx", "vcx", "tndstn")


@query(
    "c6_parse_money",
    f"WITH {sql.RAW_POLICIES} SELECT policycode, "
    + ", ".join(f"CAST({sql.money(c)} AS DOUBLE) AS {c}" for c in C6)
    + " FROM raw_policies",
)
def c6_parse_money(spark, sf):
    return adapters.policies_raw(spark, sf).select("policycode", *[parse_money(c).alias(c) for c in C6])


APPROVED_DAY = sql.date("split_part(approveddate, ' @', 1)", "%b %d, %Y")


@query(
    "c7_parse_dates",
    f"WITH {sql.RAW_SNAPSHOT} SELECT claimnumber, loai_hinh_trans, "
    f"CAST({sql.date('updateddate', '%d-%m-%Y')} AS VARCHAR) AS updateddate, "
    f"CAST({sql.date('payment_date')} AS VARCHAR) AS payment_date, "
    f"CAST({APPROVED_DAY} AS VARCHAR) "
    "AS approveddate FROM raw_snapshot",
)
def c7_parse_dates(spark, sf):
    return adapters.snapshot_raw(spark, sf).select(
        "claimnumber",
        "loai_hinh_trans",
        parse_date("updateddate", DMY_DASH).alias("updateddate"),
        parse_date("payment_date", DMY).alias("payment_date"),
        parse_date("approveddate", STAMP).alias("approveddate"),
    )


@query("c8_to_day", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def c8_to_day(spark, sf):
    return load(spark, sf, "events", ["event_id", "ts"]).select("event_id", to_day("ts").alias("day"))


@query(
    "c9_fill_from",
    f"WITH {sql.RAW_SNAPSHOT} SELECT claimnumber, loai_hinh_trans, "
    "CASE WHEN payment_date IN ('', '-') THEN ngaybatdau ELSE payment_date END AS payment_date FROM raw_snapshot",
)
def c9_fill_from(spark, sf):
    return op.fill_from(adapters.snapshot_raw(spark, sf), "payment_date", "ngaybatdau").select(
        "claimnumber", "loai_hinh_trans", "payment_date"
    )


@query(
    "c10_apply_patches",
    f"WITH {sql.LOG}, src AS (SELECT claimnumber, row_index, claim_submitted_date, agencycompensation FROM log), "
    "patch AS (SELECT 'C' || o_orderkey AS claimnumber, MAX(CAST(o_orderdate AS DATE)) AS d, "
    "MAX(o_orderpriority) AS p FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) "
    "SELECT s.claimnumber, row_index, CAST(COALESCE(p.d, claim_submitted_date) AS VARCHAR) AS claim_submitted_date, "
    "COALESCE(p.p, agencycompensation) AS agencycompensation FROM src s LEFT JOIN patch p USING (claimnumber)",
)
def c10_apply_patches(spark, sf):
    urgent = load(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority"]).where(
        "o_orderpriority = '1-URGENT'"
    )
    patches = urgent.selectExpr(
        "concat('C', o_orderkey) as claimnumber",
        "stack(2, 'claim_submitted_date', cast(to_date(o_orderdate) as string), 'agencycompensation', o_orderpriority) "
        "as (column_name, new_value)",
    )
    rows = log(spark, sf, "claimnumber", "row_index", "claim_submitted_date", "agencycompensation")
    return op.apply_patches(rows, patches, "claimnumber", ["claim_submitted_date", "agencycompensation"])


@query(
    "c11_translate",
    f"WITH {sql.RAW_POLICIES} SELECT policycode, {sql.case('status_trans', expected.POLICY_STATUS)} AS status_trans, "
    f"{sql.case('mdsd', expected.USAGE)} AS mdsd, {sql.case('customer_type_trans', expected.POLICY_CUSTOMER)} AS customer_type_trans "
    "FROM raw_policies",
)
def c11_translate(spark, sf):
    df = adapters.policies_raw(spark, sf)
    df = op.translate(df, "status_trans", v.POLICY_STATUS)
    df = op.translate(df, "mdsd", v.USAGE)
    df = op.translate(df, "customer_type_trans", v.POLICY_CUSTOMER)
    return df.select("policycode", "status_trans", "mdsd", "customer_type_trans")


@query(
    "c11_translate_status_coarse",
    f"WITH {sql.RAW_SNAPSHOT} SELECT claimnumber, loai_hinh_trans, "
    f"{sql.case('statusname', expected.SNAPSHOT_STATUS_COARSE)} AS statusname, "
    f"{sql.case('solutioncompensation', expected.COMPENSATION_ROUTE, sql.q('Unknown'))} AS solutioncompensation "
    "FROM raw_snapshot",
)
def c11_translate_status_coarse(spark, sf):
    df = op.translate(adapters.snapshot_raw(spark, sf), "statusname", v.SNAPSHOT_STATUS_COARSE)
    df = op.translate(df, "solutioncompensation", v.COMPENSATION_ROUTE, "Unknown")
    return df.select("claimnumber", "loai_hinh_trans", "statusname", "solutioncompensation")


@query(
    "c12_rollup_category",
    f"WITH {sql.RAW_POLICIES} SELECT {sql.vehicle_case('loaixe')} AS vehicle_class, COUNT(*) AS policies "
    "FROM raw_policies GROUP BY 1",
)
def c12_rollup_category(spark, sf):
    df = op.rollup_category(adapters.policies_raw(spark, sf), "loaixe", v.VEHICLE_CLASSES, output="vehicle_class")
    return df.groupBy("vehicle_class").agg(F.count(F.lit(1)).alias("policies"))


@query(
    "c13_derive_amounts",
    f"WITH {sql.RAW_LOG}, t AS (SELECT claimnumber, row_index, {sql.money0('cost_giam_tru')} AS a, "
    f"{sql.money0('cost_khau_tru')} AS b, {sql.money('cost_tong_khau_giam_tru')} AS c, {sql.money('stbt_truoc_thue')} AS net "
    "FROM raw_log) SELECT claimnumber, row_index, CAST(a AS DOUBLE) AS cost_giam_tru, CAST(b AS DOUBLE) AS cost_khau_tru, "
    "CAST(COALESCE(c, a + b) AS DOUBLE) AS cost_tong_khau_giam_tru, "
    "round(CAST(net AS DOUBLE) * 100 / 92.5926, 0) AS gross FROM t",
)
def c13_derive_amounts(spark, sf):
    raw = adapters.status_log_raw(spark, sf)
    df = op.derive_total_cost(raw, "cost_giam_tru", "cost_khau_tru", "cost_tong_khau_giam_tru")
    return df.withColumn("gross", op.gross_up(parse_money("stbt_truoc_thue"))).select(
        "claimnumber", "row_index", "cost_giam_tru", "cost_khau_tru", "cost_tong_khau_giam_tru", "gross"
    )


@query(
    "c14_default_usage",
    f"WITH {sql.RAW_LOG} SELECT claimnumber, row_index, CASE WHEN mdsd <> '' THEN mdsd WHEN customer_type = 'Tổ chức' "
    "THEN 'Kinh doanh' ELSE 'Không kinh doanh' END AS mdsd FROM raw_log",
)
def c14_default_usage(spark, sf):
    df = op.default_usage(
        adapters.status_log_raw(spark, sf), "mdsd", "customer_type", "Tổ chức", "Kinh doanh", "Không kinh doanh"
    )
    return df.select("claimnumber", "row_index", "mdsd")


@query(
    "c15_repair_order",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, CAST(requested AS VARCHAR) AS entered, "
    "CAST(CASE WHEN requested > claim_opened_date THEN claim_accident_date ELSE requested END AS VARCHAR) "
    "AS claim_submitted_date FROM snapshot",
)
def c15_repair_order(spark, sf):
    raw = adapters.snapshot_raw(spark, sf)
    df = raw.select(
        "claimnumber",
        map_value("loai_hinh_trans", v.COVERAGE_BY_NAME, v.UNKNOWN).alias("coverage"),
        parse_date("requesterdate", DMY).alias("entered"),
        parse_date("requesterdate", DMY).alias("claim_submitted_date"),
        parse_date("ngay_mo_hsbt", DMY).alias("opened"),
        parse_date("accidentdate", DMY).alias("accident"),
    )
    return op.repair_order(df, "claim_submitted_date", "opened", "accident").drop("opened", "accident")


@query(
    "c16_match_keywords",
    f"WITH {sql.RAW_SNAPSHOT} SELECT claimnumber, loai_hinh_trans, CAST({sql.injured('noi_dung_tai_nan')} AS INTEGER) "
    "AS injured FROM raw_snapshot",
)
def c16_match_keywords(spark, sf):
    df = op.match_keywords(adapters.snapshot_raw(spark, sf), "noi_dung_tai_nan", v.INJURY_PHRASES, "injured")
    return df.select("claimnumber", "loai_hinh_trans", "injured")


DOCUMENT_PHRASES = ("the of", "with by", "de la", "und der", "a+b")


@query(
    "c16_match_keywords_documents",
    "SELECT doc_id, CAST("
    + " OR ".join(f"contains(lower(text), '{p}')" for p in DOCUMENT_PHRASES)
    + " AS INTEGER) AS matched FROM documents",
)
def c16_match_keywords_documents(spark, sf):
    docs = load(spark, sf, "documents", ["doc_id", "text"])
    return op.match_keywords(docs, "text", DOCUMENT_PHRASES).select("doc_id", "matched")


PHRASES_SQL = """
words AS (SELECT item_id, k, w[k] AS a, w[k + 1] AS b FROM (SELECT item_id, string_split(lower(text), ' ') AS w FROM benchmark), range(1, len(w)) AS r(k)),
phrases AS (SELECT DISTINCT a || ' ' || b AS phrase FROM words WHERE a <> '' AND b <> ''),
pairs AS (
  SELECT doc_id, w || ' ' || lead(w) OVER later AS phrase, COALESCE(SUM(len(w) + 1) OVER earlier, 0) AS position
  FROM (SELECT rid, doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS k
    FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(lower(text), ' ') AS w FROM documents))
  WINDOW later AS (PARTITION BY rid ORDER BY k), earlier AS (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT doc_id, phrase, CAST(position AS INTEGER) AS position FROM pairs JOIN phrases USING (phrase))"""


def benchmark_phrases(spark, sf):
    """All pairs of neighbouring words in the passages of the benchmark, which come to the driver; the search checks their size."""
    words = F.split(F.lower("text"), " ")
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))
    each = load(spark, sf, "benchmark", ["text"]).select(F.explode(pairs).alias("pair")).select("pair.*")
    named = each.where((F.col("a") != "") & (F.col("b") != "")).select(F.concat_ws(" ", "a", "b").alias("phrase")).distinct()
    return [r["phrase"] for r in named.toLocalIterator()]


@query("c16_phrase_positions", f"WITH {PHRASES_SQL} SELECT * FROM found")
def c16_phrase_positions(spark, sf):
    docs = load(spark, sf, "documents", ["doc_id", "text"])
    return find_phrases(docs, "text", benchmark_phrases(spark, sf), ["doc_id"], between=" ")


@query("c16_phrase_counts", f"WITH {PHRASES_SQL} SELECT phrase, COUNT(*) AS occurrences, COUNT(DISTINCT doc_id) AS found_in FROM found GROUP BY phrase")
def c16_phrase_counts(spark, sf):
    docs = load(spark, sf, "documents", ["doc_id", "text"])
    return phrase_counts(find_phrases(docs, "text", benchmark_phrases(spark, sf), ["doc_id"], between=" "), "doc_id")


@query(
    "c17_day_difference",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, CAST(updateddate - claim_submitted_date AS INTEGER) AS days, "
    "CAST(claim_approved_date - claim_submitted_date AS INTEGER) AS days_to_approval FROM log",
)
def c17_day_difference(spark, sf):
    rows = log(
        spark, sf, "claimnumber", "row_index", "updateddate", "claim_submitted_date", "claim_approved_date"
    )
    return rows.select(
        "claimnumber",
        "row_index",
        F.datediff("updateddate", "claim_submitted_date").alias("days"),
        F.datediff("claim_approved_date", "claim_submitted_date").alias("days_to_approval"),
    )


@query(
    "c18_full_months",
    f"WITH {sql.POLICIES} SELECT policycode, CAST((year(end_date) - year(start_date)) * 12 + month(end_date) "
    "- month(start_date) - CASE WHEN day(end_date) < day(start_date) THEN 1 ELSE 0 END AS INTEGER) AS months FROM policies",
)
def c18_full_months(spark, sf):
    return adapters.policies(spark, sf).select("policycode", full_months("start_date", "end_date").alias("months"))


@query(
    "c19_month_key",
    f"WITH {sql.POLICIES} SELECT policycode, CAST(CAST(date_trunc('month', start_date) AS DATE) AS VARCHAR) AS month FROM policies",
)
def c19_month_key(spark, sf):
    return adapters.policies(spark, sf).select("policycode", month_key("start_date").alias("month"))


AS_OF = "2000-06-30"


@query(
    "c20_compare_with_day",
    f"WITH {sql.POLICIES} SELECT policycode, CAST(start_date > DATE '{AS_OF}' AS INTEGER) AS future_start, "
    f"CAST(end_date < DATE '{AS_OF}' AS INTEGER) AS ended FROM policies",
)
def c20_compare_with_day(spark, sf):
    as_of = F.lit(AS_OF).cast("date")
    return adapters.policies(spark, sf).select(
        "policycode", (F.col("start_date") > as_of).alias("future_start"), (F.col("end_date") < as_of).alias("ended")
    )


@query(
    "c21_safe_ratio",
    f"WITH {sql.SNAPSHOT} SELECT claimnumber, coverage, "
    "round(CAST(compensation_total AS DOUBLE) / NULLIF(CAST(claim_estimate AS DOUBLE), 0), 6) AS paid_share FROM snapshot",
)
def c21_safe_ratio(spark, sf):
    return snapshot(spark, sf, "claimnumber", "coverage", "compensation_total", "claim_estimate").select(
        "claimnumber",
        "coverage",
        F.round(
            ratio(F.col("compensation_total").cast("double"), F.col("claim_estimate").cast("double")), 6
        ).alias("paid_share"),
    )


@query(
    "c7_clean_policies",
    f"WITH {sql.RAW_POLICIES} SELECT sogcn AS certificate_no, policycode, CAST({sql.date('createddate')} AS VARCHAR) AS createddate, "
    f"CAST({sql.date('ngaybatdau')} AS VARCHAR) AS start_date, CAST({sql.date('ngayketthuc')} AS VARCHAR) AS end_date, "
    f"CAST({sql.money('finalprice')} AS DOUBLE) AS finalprice, CAST({sql.money('lpx')} AS DOUBLE) AS personal_injury_coverage, "
    f"TRY_CAST(sochongoi AS INTEGER) AS vehicle_seats, {sql.case('status_trans', expected.POLICY_STATUS)} AS status_trans, "
    f"{sql.case('mdsd', expected.USAGE)} AS vehicle_usage FROM raw_policies WHERE {sql.date('ngaybatdau')} IS NOT NULL",
)
def c7_clean_policies(spark, sf):
    return clean_policies(adapters.policies_raw(spark, sf)).select(
        "certificate_no",
        "policycode",
        "createddate",
        "start_date",
        "end_date",
        "finalprice",
        "personal_injury_coverage",
        "vehicle_seats",
        "status_trans",
        "vehicle_usage",
    )


@query(
    "c7_clean_history",
    f"WITH {sql.LOG} SELECT claimnumber, row_index, claim_status_name, CAST(updateddate AS VARCHAR) AS updateddate, "
    "CAST(claim_accident_date AS VARCHAR) AS claim_accident_date, CAST(claim_submitted_date AS VARCHAR) AS claim_submitted_date, "
    "CAST(claim_approved_date AS VARCHAR) AS claim_approved_date, CAST(payment_date AS VARCHAR) AS payment_date, coverage, "
    "damage_type, solutioncompensation, CAST(cost_copay_deductible AS DOUBLE) AS cost_copay_deductible, "
    "CAST(claim_estimate AS DOUBLE) AS claim_estimate, CAST(compensation_total AS DOUBLE) AS compensation_total, "
    "vehicle_usage, customer_type FROM log",
)
def c7_clean_history(spark, sf):
    return log(
        spark,
        sf,
        "claimnumber",
        "row_index",
        "claim_status_name",
        "updateddate",
        "claim_accident_date",
        "claim_submitted_date",
        "claim_approved_date",
        "payment_date",
        "coverage",
        "damage_type",
        "solutioncompensation",
        "cost_copay_deductible",
        "claim_estimate",
        "compensation_total",
        "vehicle_usage",
        "customer_type",
    )
