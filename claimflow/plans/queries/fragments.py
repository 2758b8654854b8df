"""SQL of the derived sources, used by the equivalent SQL of the registered queries.

The statements work on the base tables alone and follow the definitions of the adapters, in the
dialect of the checking engine.
"""

from __future__ import annotations

from collections.abc import Mapping

from claimflow.plans.queries import expected as v
from claimflow.sources import adapters as a


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick(values: list[str], index: str) -> str:
    return "[" + ", ".join(q(x) for x in values) + f"][{index} + 1]"


def case(column: str, mapping: Mapping[str, str], otherwise: str = "NULL") -> str:
    """CASE over exact values; `otherwise` is SQL."""
    whens = " ".join(f"WHEN {q(k)} THEN {q(t)}" for k, t in mapping.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def members_to_group(groups: Mapping[str, tuple[str, ...]]) -> dict[str, str]:
    return {member: group for group, members in groups.items() for member in members}


def commas(amount: str) -> str:
    return "format('{:,}', " + amount + ")"


def dmy(days: str, pattern: str = "%d/%m/%Y") -> str:
    return f"strftime(base + CAST({days} AS INTEGER), '{pattern}')"


def money(column: str) -> str:
    return f"TRY_CAST(REPLACE({column}, ',', '') AS DECIMAL(15,2))"


def money0(column: str) -> str:
    return f"COALESCE({money(column)}, 0)"


def date(column: str, pattern: str = "%d/%m/%Y") -> str:
    return f"CAST(try_strptime({column}, '{pattern}') AS DATE)"


RAW_LOG = f"""
log_base AS (
  SELECT l_orderkey AS k, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
         (l_partkey + 3 * l_suppkey + 7 * l_linenumber) % 20 AS code,
         DATE '1996-01-01' + CAST(l_orderkey % 1200 AS INTEGER) AS base,
         unnest(range(0, CASE WHEN l_orderkey % 23 = 3 THEN 2 ELSE 1 END)) AS copy
  FROM lineitem),
raw_log AS (
  SELECT 'C' || k AS claimnumber, 'P' || k AS policycode, ((sk * 10 + ln) * 100000000 + price) * 2 + copy AS row_index,
    {pick(a.LOG_STATUS_NAMES, 'code')} AS claim_status_name,
    {dmy('(sk % 6) * 5')} AS updateddate,
    CASE WHEN k % 41 = 0 THEN {dmy('10')} ELSE {dmy('-(k % 5)')} END AS accidentdate,
    CASE WHEN k % 37 = 0 THEN {dmy('7')} ELSE {dmy('0')} END AS requesterdate,
    {dmy('1 + k % 3')} AS ngay_mo_hsbt,
    CASE WHEN k % 4 = 0 THEN '' ELSE {dmy('20 + k % 9', '%Y-%m-%d')} END AS flex_ngay_duyet,
    CASE WHEN k % 3 = 0 THEN '' ELSE {dmy('25 + k % 7')} END AS ngay_thanh_toan,
    {pick(a.COVERAGE_CODES, 'sk % 4')} AS loai_hinh,
    CASE WHEN (ln + k) % 3 <> 0 THEN ''
         ELSE {pick(a.DAMAGE_NAMES, '(k + CASE WHEN k % 11 = 0 THEN ln ELSE 0 END) % 7')} END AS pham_vi,
    {pick(['Tự bồi thường', 'Bồi thường hệ thống', '12'], 'k % 3')} AS loai_boi_thuong,
    CASE WHEN pk % 4 = 0 THEN '' ELSE CAST(pk % 9 * 1000 AS VARCHAR) END AS cost_giam_tru,
    CASE WHEN sk % 5 = 0 THEN '' ELSE CAST(sk % 7 * 500 AS VARCHAR) END AS cost_khau_tru,
    CASE WHEN ln % 2 = 0 THEN '' ELSE CAST(pk % 9 * 1000 + sk % 7 * 500 AS VARCHAR) END AS cost_tong_khau_giam_tru,
    CASE WHEN (pk + sk) % 6 = 0 THEN '' WHEN (pk + sk) % 13 = 0 THEN '0' ELSE {commas('price')} END AS uoc_bt_ban_dau,
    CASE WHEN (pk + ln) % 5 = 0 THEN '' WHEN (pk + ln) % 7 = 0 THEN '0'
         ELSE {commas('price - price // 10')} END AS ubt,
    CASE WHEN code IN (14, 15) THEN CASE WHEN pk % 2 = 0 THEN '' ELSE '0' END
         WHEN (sk + ln) % 9 = 0 THEN '0' ELSE {commas('price')} END AS ubt_trans,
    CASE WHEN code IN (14, 15, 16) AND pk % 17 <> 0 THEN {commas('price // 5 * 4')}
         WHEN code IN (11, 12) AND ln % 3 = 0 THEN {commas('price // 2')} ELSE '' END AS stbt_truoc_thue,
    CASE WHEN pk % 19 = 0 THEN ''
         ELSE 'Đơn vị ' || (CASE WHEN pk % 8 = 0 THEN (sk + 1) % 10 ELSE sk % 5 END) END AS don_vi_boi_thuong,
    'GDV ' || (sk % 25) AS gdv_xu_ly,
    CASE WHEN k % 29 = 0 THEN '' WHEN k % 3 = 0 THEN 'Kinh doanh' ELSE 'Không kinh doanh' END AS mdsd,
    {pick(a.VEHICLES, f'k % {len(a.VEHICLES)}')} AS loaixe,
    {pick(a.MAKES, 'k % 4')} AS hangxe,
    CASE WHEN k % 4 = 0 THEN 'Tổ chức' ELSE 'Cá nhân' END AS customer_type
  FROM log_base)"""

LOG = f"""{RAW_LOG},
log_typed AS (
  SELECT claimnumber, policycode, row_index,
    {case('claim_status_name', v.HISTORY_STATUS, 'claim_status_name')} AS claim_status_name,
    {date('updateddate')} AS updateddate, {date('accidentdate')} AS claim_accident_date,
    {date('requesterdate')} AS requested, {date('ngay_mo_hsbt')} AS claim_opened_date,
    {date('flex_ngay_duyet', '%Y-%m-%d')} AS claim_approved_date, {date('ngay_thanh_toan')} AS payment_date,
    {case('loai_hinh', v.COVERAGE_BY_CODE, "'Unknown'")} AS coverage,
    {case('pham_vi', v.HISTORY_DAMAGE, "''")} AS damage_type,
    {case('loai_boi_thuong', v.COMPENSATION_ROUTE, "'Unknown'")} AS solutioncompensation,
    {money0('cost_giam_tru')} AS cost_copay, {money0('cost_khau_tru')} AS cost_deductible,
    COALESCE({money('cost_tong_khau_giam_tru')}, {money0('cost_giam_tru')} + {money0('cost_khau_tru')})
      AS cost_copay_deductible,
    {money('uoc_bt_ban_dau')} AS claim_estimate_first, {money('ubt')} AS claim_estimate,
    {money('ubt_trans')} AS total_claim_estimate, {money('stbt_truoc_thue')} AS compensation_total,
    don_vi_boi_thuong AS agencycompensation, gdv_xu_ly AS assignee_fullname,
    CASE WHEN mdsd <> '' THEN mdsd WHEN customer_type = 'Tổ chức' THEN 'Kinh doanh' ELSE 'Không kinh doanh' END
      AS vehicle_usage,
    loaixe AS vehicle_type, hangxe AS vehicle_make,
    {case('customer_type', v.CLAIM_CUSTOMER)} AS customer_type
  FROM raw_log),
log AS (
  SELECT *, CASE WHEN requested > claim_opened_date THEN claim_accident_date ELSE requested END AS claim_submitted_date
  FROM log_typed)"""

# the log with copies removed: one row per claim, state, coverage, damage and amounts
DEDUPED = f"""{LOG.replace("log AS (", "full_log AS (").replace("raw_full_log", "raw_log")},
log AS (
  SELECT * FROM full_log QUALIFY ROW_NUMBER() OVER (PARTITION BY claimnumber, claim_status_name, coverage, damage_type,
    compensation_total, claim_estimate, total_claim_estimate, claim_estimate_first ORDER BY updateddate, row_index) = 1)"""

STATUS_CHAIN = "".join(
    f"WHEN bool_or(claim_status_name = {q(s)}) THEN {q(s)} " for s in v.STATUS_PRIORITY
)

ROWS = f"""{LOG},
resolved AS (SELECT claimnumber, CASE {STATUS_CHAIN} END AS claim_status FROM log GROUP BY claimnumber),
log_rows AS (SELECT l.*, r.claim_status FROM log l JOIN resolved r USING (claimnumber))"""

DEDUPED_ROWS = ROWS.replace(LOG, DEDUPED)

RAW_SNAPSHOT = f"""
snap_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS price,
         CASE WHEN o_orderstatus = 'P' THEN 'S' ELSE 'C' END AS book,
         DATE '1996-01-01' + CAST(o_orderkey % 1200 AS INTEGER) AS base,
         unnest(range(0, CASE WHEN o_custkey % 20 = 0 THEN 3 WHEN o_custkey % 4 = 0 THEN 2 ELSE 1 END)) AS i
  FROM orders),
snap_parts AS (SELECT *, price // (CASE WHEN k % 3 = 0 THEN 1 ELSE i + 1 END) AS p, k % 10 IN (5, 6, 7) AS settled, k % 10 IN (1, 2, 5, 6, 7, 8) AS decided
  FROM snap_base),
raw_snapshot AS (
  SELECT book || k AS claimnumber, 'P' || k AS policycode,
    CASE WHEN k % 101 = 0 THEN '2' ELSE {pick(a.SNAPSHOT_STATUS_NAMES, 'k % 10')} END AS statusname,
    {pick(a.COVERAGE_NAMES, '(k + i) % 4')} AS loai_hinh_trans,
    {pick(a.CAUSES, f'(k + 3 * i) % {len(a.CAUSES)}')} AS nguyen_nhan_ton_that,
    CASE WHEN k % 14 = 0 THEN 'Hai xe va chạm, nạn nhân được đưa đi cấp cứu'
         WHEN k % 14 = 1 THEN 'Lái xe BỊ THƯƠNG nhẹ'
         WHEN k % 14 = 2 AND i = 0 THEN 'Người đi đường tử vong' ELSE 'Xe va quệt nhẹ' END AS noi_dung_tai_nan,
    {pick(['Tự bồi thường', 'Bồi thường hệ thống', '12'], 'k % 3')} AS solutioncompensation,
    {dmy('-5', '%d-%m-%Y')} AS createddate,
    CASE WHEN k % 101 = 0 THEN '-' ELSE {dmy('40', '%d-%m-%Y')} END AS updateddate,
    CASE WHEN k % 12 = 0 THEN '-' WHEN k % 23 = 0 THEN {dmy('-10')} ELSE {dmy('-3')} END AS payment_date,
    {dmy('-100')} AS ngaybatdau, {dmy('265')} AS ngayketthuc,
    CASE WHEN k % 61 = 0 THEN {dmy('9')} ELSE {dmy('0')} END AS requesterdate,
    {dmy('1 + k % 3')} AS ngay_mo_hsbt, {dmy('-(k % 5)')} AS accidentdate,
    CASE WHEN decided AND k % 17 <> 0 THEN {dmy('15 + k % 20', '%b %-d, %Y @ %H:%M:%S.000')} ELSE '-' END AS approveddate,
    CASE WHEN (k + i) % 6 = 0 THEN '-' ELSE {commas('p')} END AS uoc_bt_ban_dau,
    CASE WHEN (k + i) % 7 = 0 THEN '-' ELSE {commas('p - p // 10')} END AS ubt,
    CASE WHEN (k + i) % 7 = 0 THEN '-' ELSE {commas('(p - p // 10) // 11 * 10')} END AS ubt_truoc_thue,
    CASE WHEN k % 31 = 0 THEN '0' ELSE {commas('p')} END AS tong_uoc_bt_truoc_thue,
    CASE WHEN settled THEN CASE WHEN (k + i) % 13 = 0 THEN '-' ELSE {commas('p // 5 * 4')} END
         WHEN k % 43 = 0 THEN '1,000,000' ELSE '-' END AS stbt,
    CASE WHEN settled AND (k + i) % 13 <> 0 THEN {commas('p // 5 * 4 // 11 * 10')} ELSE '-' END AS stbt_truoc_thue,
    CASE WHEN k % 25 = 0 THEN {commas('k % 7 * 100000')} ELSE '0' END AS cost_cuuho,
    CASE WHEN k % 8 = 0 THEN '-' ELSE {commas('k % 5 * 1000000')} END AS cost_giam_tru,
    {commas('c % 3 * 500000')} AS cost_khau_tru,
    CASE WHEN k % 19 = 0 THEN '-' ELSE {commas('k % 5 * 1000000 + c % 3 * 500000')} END AS cost_tong_khau_giam_tru,
    '0' AS cost_3rdparty, '0' AS compensation_amount,
    CASE WHEN k % 9 = 0 THEN '0' WHEN k % 47 = 0 THEN '-' ELSE CAST(14 + k % 20 - k % 3 AS VARCHAR) END AS processdays,
    {commas('p // 3')} AS damageestimation,
    {pick(a.VEHICLES, f'k % {len(a.VEHICLES)}')} AS loaixe, {pick(a.MAKES, 'k % 4')} AS hangxe,
    CASE WHEN c % 4 = 0 THEN 'Tổ chức' ELSE 'Cá nhân' END AS customer_type,
    CASE WHEN k % 53 = 0 THEN '-' ELSE 'Đơn vị ' || (c % 10) END AS agencycompensation,
    'GDV ' || (c % 25) AS assignee_fullname
  FROM snap_parts)"""

SNAPSHOT = f"""{RAW_SNAPSHOT},
snap_typed AS (
  SELECT claimnumber, policycode,
    {case('statusname', v.SNAPSHOT_STATUS)} AS claim_status,
    {case('loai_hinh_trans', v.COVERAGE_BY_NAME, "'Unknown'")} AS coverage,
    nguyen_nhan_ton_that AS accident_type, noi_dung_tai_nan AS narrative,
    {date('createddate', '%d-%m-%Y')} AS createddate, {date('updateddate', '%d-%m-%Y')} AS updateddate,
    COALESCE({date('payment_date')}, {date('ngaybatdau')}) AS payment_date,
    {date('requesterdate')} AS requested, {date('ngay_mo_hsbt')} AS claim_opened_date,
    {date('accidentdate')} AS claim_accident_date,
    {date("split_part(approveddate, ' @', 1)", '%b %d, %Y')} AS claim_approved_date,
    {money0('uoc_bt_ban_dau')} AS claim_estimate_first, {money0('ubt')} AS claim_estimate,
    {money0('ubt_truoc_thue')} AS claim_estimate_beforetax, {money0('tong_uoc_bt_truoc_thue')} AS total_claim_estimate,
    {money0('stbt')} AS compensation_total, {money0('stbt_truoc_thue')} AS compensation_amount_beforetax,
    {money0('cost_cuuho')} AS cost_towing, {money0('cost_giam_tru')} AS cost_copay,
    {money0('cost_khau_tru')} AS cost_deductible, {money0('cost_tong_khau_giam_tru')} AS cost_copay_deductible,
    TRY_CAST(processdays AS INTEGER) AS processdays, loaixe AS vehicle_type, hangxe AS vehicle_make,
    {case('customer_type', v.CLAIM_CUSTOMER)} AS customer_type, agencycompensation, assignee_fullname
  FROM raw_snapshot),
snapshot AS (
  SELECT *, CASE WHEN requested > claim_opened_date THEN claim_accident_date ELSE requested END AS claim_submitted_date
  FROM snap_typed)"""

RAW_POLICIES = f"""
policy_base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS price,
         CAST(o_orderdate AS DATE) AS base FROM orders),
raw_policies AS (
  SELECT 'GCN' || c AS sogcn, 'P' || k AS policycode, 'KH' || c AS customercode,
    {pick(a.POLICY_STATUS_NAMES, 'k % 5')} AS status_trans, {dmy('2 - k % 10')} AS createddate,
    CASE WHEN k % 97 = 0 THEN '' WHEN k % 89 = 0 THEN '-' ELSE {dmy('0')} END AS ngaybatdau,
    {dmy('30 * (1 + k % 24)')} AS ngayketthuc, {commas('price')} AS finalprice, {commas('price // 10')} AS tndsbb,
    CASE WHEN k % 7 = 0 THEN '-' ELSE {commas('price // 20')} END AS lpx, {commas('price // 2')} AS vcx,
    CASE WHEN k % 11 = 0 THEN '' ELSE {commas('price // 4')} END AS tndstn,
    CASE WHEN k % 13 = 0 THEN '-' ELSE CAST(4 + k % 40 AS VARCHAR) END AS sochongoi,
    {pick(a.MAKES, 'k % 4')} AS hangxe, {pick(a.VEHICLES, f'k % {len(a.VEHICLES)}')} AS loaixe,
    CASE WHEN k % 29 = 0 THEN '-' WHEN k % 3 = 0 THEN 'Kinh doanh' ELSE 'Không kinh doanh' END AS mdsd,
    'Tỉnh ' || (c % 63) AS tinhthanhchuxe,
    CASE WHEN c % 4 = 0 THEN 'Tổ chức' ELSE 'Cá nhân' END AS customer_type_trans
  FROM policy_base)"""

POLICIES = """
policies AS (
  SELECT 'P' || o_orderkey AS policycode, 'GCN' || o_custkey AS certificate_no,
    CAST(o_orderdate AS DATE) + CAST(2 - o_orderkey % 10 AS INTEGER) AS createddate,
    CAST(o_orderdate AS DATE) AS start_date,
    CAST(o_orderdate AS DATE) + CAST(30 * (1 + o_orderkey % 24) AS INTEGER) AS end_date,
    CAST(o_totalprice AS DECIMAL(15,2)) AS finalprice,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Terminated' ELSE 'Active' END AS status_trans
  FROM orders),
shares AS (
  SELECT *, CAST(finalprice AS DOUBLE) / ((year(end_date) - year(start_date)) * 12 + month(end_date) - month(start_date)
    - CASE WHEN day(end_date) < day(start_date) THEN 1 ELSE 0 END + 1) AS share
  FROM policies)"""


def months(first: str, last: str) -> str:
    return (
        "months AS (SELECT CAST(unnest(generate_series("
        f"DATE '{first}', DATE '{last}', INTERVAL 1 MONTH)) AS DATE) AS calendar_month)"
    )


EARNED = f"""{POLICIES},
{months('1990-01-01', '2012-12-01')},
premium AS (
  SELECT m.calendar_month, SUM(s.share) AS earned_premium, COUNT(*) AS active_policies
  FROM months m JOIN shares s
    ON m.calendar_month BETWEEN date_trunc('month', s.start_date) AND date_trunc('month', s.end_date)
  GROUP BY m.calendar_month)"""

CLAIMS = f"""
claims AS (
  SELECT 'C' || o_orderkey AS claimnumber,
    CASE o_orderstatus WHEN 'F' THEN 'paid out' WHEN 'P' THEN 'approved' ELSE 'in process' END AS claim_status,
    CAST(o_orderdate AS DATE) AS claim_submitted_date,
    CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 3 AS INTEGER) AS claim_opened_date,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(5 + o_orderkey % 60 AS INTEGER) END
      AS claim_approved_date,
    COALESCE(updated, CAST(o_orderdate AS DATE)) AS updateddate,
    {pick(list(v.COVERAGE_BY_CODE.values()), 'o_orderkey % 4')} AS coverage,
    {pick([v.INJURY, v.PARTIAL_TOTAL, v.THIRD_PARTY_VEHICLE, v.THIRD_PARTY_OTHER, v.THEFT], 'o_custkey % 5')}
      AS damage_type,
    {pick(list(v.VEHICLE_CLASSES), 'o_custkey % 7')} AS vehicle_type,
    COALESCE(total, 0) AS claim_estimate_first, CAST(o_totalprice AS DECIMAL(15,2)) AS total_claim_estimate,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(COALESCE(total, 0) * 0.8 AS DECIMAL(15,2)) ELSE 0 END AS compensation_total
  FROM orders LEFT JOIN (
    SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total,
           CAST(MAX(l_shipdate) AS DATE) AS updated
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)"""


def accident_case(column: str) -> str:
    return case(column, members_to_group(v.ACCIDENT_TYPES), column)


def vehicle_case(column: str) -> str:
    return case(column, members_to_group(v.VEHICLE_CLASSES))


def injured(column: str) -> str:
    return "(" + " OR ".join(f"lower({column}) LIKE {q('%' + p + '%')}" for p in v.INJURY_PHRASES) + ")"


def damage_case(cause: str, coverage: str, flag: str) -> str:
    """The damage cascade as the steps of an update chain, each step seeing the result of the one before."""

    def listed(groups: Mapping[str, tuple[str, ...]], group: str) -> str:
        return "(" + ", ".join(q(m) for m in groups[group]) + ")"

    settled = ", ".join(q(x) for x in (v.PARTIAL_TOTAL, v.THEFT, v.THIRD_PARTY_OTHER))
    step = cause
    for group in (v.PARTIAL_TOTAL, v.THEFT, v.THIRD_PARTY_OTHER):
        step = f"CASE WHEN {cause} IN {listed(v.DAMAGE_BY_CAUSE, group)} THEN {q(group)} ELSE {step} END"
    return f"""(SELECT CASE WHEN d4 IN ({settled}, {q(v.INJURY)}, {q(v.THIRD_PARTY_VEHICLE)}) THEN d4 ELSE 'Unknown' END
      FROM (SELECT CASE WHEN {coverage} = 'Auto liability coverage' AND d3 IN {listed(v.DAMAGE_BY_LIABILITY_CAUSE, v.THIRD_PARTY_VEHICLE)}
                        THEN {q(v.THIRD_PARTY_VEHICLE)}
                        WHEN {coverage} = 'Auto liability coverage' AND d3 IN {listed(v.DAMAGE_BY_LIABILITY_CAUSE, v.THIRD_PARTY_OTHER)}
                        THEN {q(v.THIRD_PARTY_OTHER)} ELSE d3 END AS d4
      FROM (SELECT CASE WHEN {flag} THEN {q(v.INJURY)} ELSE d2 END AS d3
      FROM (SELECT CASE WHEN d1 NOT IN ({settled}) AND {coverage} IN ('Personal injury coverage', 'Comprehensive coverage')
                        THEN {q(v.INJURY)} ELSE d1 END AS d2
      FROM (SELECT CASE WHEN d0 NOT IN ({settled}) AND {coverage} = 'Collision coverage'
                        THEN {q(v.PARTIAL_TOTAL)} ELSE d0 END AS d1
      FROM (SELECT {step} AS d0)))))) """
