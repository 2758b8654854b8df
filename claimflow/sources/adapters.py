"""The claim and policy schemas expressed over the available warehouse tables.

Each adapter derives one source, with the blanks, dashes, thousands separators, date texts and
Vietnamese category values the cleaning plans expect, row by row from `orders` or `lineitem`.
Every row of a base table is used, so the size of every source follows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions import vocabulary as v
from claimflow.sources.tables import load

LOG_STATUS_NAMES = (
    ["Mới"] * 2
    + ["Chưa giám định"] * 3
    + ["Chờ lập PASC"] * 5
    + ["Chờ hoàn thiện hồ sơ"]
    + ["Đang xử lý"] * 2
    + ["Đang xử lý bồi thường"]
    + ["Đã duyệt"] * 2
    + ["Đã chi trả bồi thường", "Đã hủy", "Đã huỷ", "Từ chối"]
)
SNAPSHOT_STATUS_NAMES = [
    "Chưa giám định",
    "Đã hủy",
    "Đã huỷ",
    "Đang xử lý",
    "Chờ lập PASC",
    "Đã chi trả bồi thường",
    "Đã chi trả bồi thường",
    "Đã duyệt",
    "Từ chối",
    "Đang xử lý bồi thường",
]
COVERAGE_CODES = list(v.COVERAGE_BY_CODE)
COVERAGE_NAMES = list(v.COVERAGE_BY_NAME)
DAMAGE_NAMES = [*v.HISTORY_DAMAGE, "Hàng hóa trên xe"]
VEHICLES = [m for members in v.VEHICLE_CLASSES.values() for m in members] + ["Xe khác"]
CAUSES = [m for members in v.ACCIDENT_TYPES.values() for m in members] + ["-", "", "Khác"]
MAKES = ["TOYOTA", "KIA", "FORD", "MAZDA"]
POLICY_STATUS_NAMES = ["Đang có hiệu lực", "Chấm dứt", "Hết hiệu lực", "Chưa tới hiệu lực", "Tạm ngưng"]


def _array(values: list[str]) -> str:
    return "array(" + ", ".join("'" + x + "'" for x in values) + ")"


def _pick(values: list[str], index: str) -> str:
    return f"element_at({_array(values)}, cast({index} as int) + 1)"


def _commas(amount: str) -> str:
    """A whole number with its thousands parted; numbers of up to nine digits without a formatter."""
    high, mid = f"({amount}) div 1000000", f"({amount}) div 1000"
    three = [f"substr(cast(1000 + {x} % 1000 as string), 2)" for x in (f"({mid})", f"({amount})")]
    return (
        f"case when ({amount}) between 1000000 and 999999999 then concat(cast({high} as string), ',', {three[0]}, ',', {three[1]}) "
        f"when ({amount}) between 1000 and 999999 then concat(cast({mid} as string), ',', {three[1]}) "
        f"else format_number({amount}, 0) end"
    )


def _dmy(date: str, pattern: str = "dd/MM/yyyy") -> str:
    return f"date_format({date}, '{pattern}')"


def _day(date: str, sign: str = "/", first: str = "day") -> str:
    """Day, month and year (or year, month and day) of a date within the years 1000 to 9999, without a formatter."""
    two = _array([f"{n:02d}" for n in range(1, 32)])
    parts = [f"element_at({two}, day({date}))", f"element_at({two}, month({date}))", f"year({date})"]
    return f"concat_ws('{sign}', {', '.join(parts if first == 'day' else parts[::-1])})"


def _plus(days: str) -> str:
    return f"date_add(base, cast({days} as int))"


def _select(rows: DataFrame, expressions: list[str], columns: Sequence[str] | None) -> DataFrame:
    """The named columns, or all; leaving out the others here keeps the plan small from the start."""
    named = {e.rsplit(" as ", 1)[1]: e for e in expressions}
    return rows.selectExpr(*[named[c] for c in (columns or named)])


def status_log_raw(spark: SparkSession, sf: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Claim status log, one row per line of an order, those of some orders entered twice: all columns text but the source's row key."""
    rows = load(
        spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    ).selectExpr(
        "l_orderkey as k",
        "l_partkey as pk",
        "l_suppkey as sk",
        "l_linenumber as ln",
        "cast(round(l_extendedprice * 100) as bigint) as price",
        "(l_partkey + 3 * l_suppkey + 7 * l_linenumber) % 20 as code",
        "date_add(date'1996-01-01', cast(l_orderkey % 1200 as int)) as base",
        "explode(sequence(0, case when l_orderkey % 23 = 3 then 1 else 0 end)) as copy",
    )
    return _select(
        rows,
        [
            "concat('C', k) as claimnumber",
            "concat('P', k) as policycode",
            "((sk * 10 + ln) * 100000000 + price) * 2 + copy as row_index",
            f"{_pick(LOG_STATUS_NAMES, 'code')} as claim_status_name",
            f"{_day(_plus('(sk % 6) * 5'))} as updateddate",
            f"case when k % 41 = 0 then {_day(_plus('10'))} else {_day(_plus('-(k % 5)'))} end as accidentdate",
            f"case when k % 37 = 0 then {_day(_plus('7'))} else {_day('base')} end as requesterdate",
            f"{_day(_plus('1 + k % 3'))} as ngay_mo_hsbt",
            f"case when k % 4 = 0 then '' else {_day(_plus('20 + k % 9'), '-', 'year')} end as flex_ngay_duyet",
            f"case when k % 3 = 0 then '' else {_day(_plus('25 + k % 7'))} end as ngay_thanh_toan",
            f"{_day(_plus('-100'))} as ngaybatdau",
            f"{_day(_plus('265'))} as ngayketthuc",
            f"{_pick(COVERAGE_CODES, 'sk % 4')} as loai_hinh",
            "case when (ln + k) % 3 <> 0 then '' else "
            f"{_pick(DAMAGE_NAMES, '(k + case when k % 11 = 0 then ln else 0 end) % 7')} end as pham_vi",
            f"{_pick(['Tự bồi thường', 'Bồi thường hệ thống', '12'], 'k % 3')} as loai_boi_thuong",
            "case when pk % 4 = 0 then '' else cast(pk % 9 * 1000 as string) end as cost_giam_tru",
            "case when sk % 5 = 0 then '' else cast(sk % 7 * 500 as string) end as cost_khau_tru",
            "case when ln % 2 = 0 then '' else cast(pk % 9 * 1000 + sk % 7 * 500 as string) end "
            "as cost_tong_khau_giam_tru",
            f"case when (pk + sk) % 6 = 0 then '' when (pk + sk) % 13 = 0 then '0' else {_commas('price')} end "
            "as uoc_bt_ban_dau",
            f"case when (pk + ln) % 5 = 0 then '' when (pk + ln) % 7 = 0 then '0' "
            f"else {_commas('price - price div 10')} end as ubt",
            "case when code in (14, 15) then case when pk % 2 = 0 then '' else '0' end "
            f"when (sk + ln) % 9 = 0 then '0' else {_commas('price')} end as ubt_trans",
            f"case when code in (14, 15, 16) and pk % 17 <> 0 then {_commas('price div 5 * 4')} "
            f"when code in (11, 12) and ln % 3 = 0 then {_commas('price div 2')} else '' end as stbt_truoc_thue",
            "case when pk % 19 = 0 then '' else concat('Đơn vị ', case when pk % 8 = 0 then (sk + 1) % 10 else sk % 5 end) "
            "end as don_vi_boi_thuong",
            "concat('GDV ', sk % 25) as gdv_xu_ly",
            "case when k % 29 = 0 then '' when k % 3 = 0 then 'Kinh doanh' else 'Không kinh doanh' end as mdsd",
            f"{_pick(VEHICLES, f'k % {len(VEHICLES)}')} as loaixe",
            f"{_pick(MAKES, 'k % 4')} as hangxe",
            "case when k % 4 = 0 then 'Tổ chức' else 'Cá nhân' end as customer_type",
        ],
        columns,
    )


def snapshot_raw(spark: SparkSession, sf: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Claim snapshot, one row per claim and coverage: every order, with one to three coverages.

    Pending orders carry claim numbers of their own, so each source has claims that the other does not know. Every
    third claim has the same amounts under each of its coverages.
    """
    rows = (
        load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
        .selectExpr(
            "o_orderkey as k",
            "case when o_orderstatus = 'P' then 'S' else 'C' end as book",
            "o_custkey as c",
            "cast(round(o_totalprice * 100) as bigint) as price",
            "date_add(date'1996-01-01', cast(o_orderkey % 1200 as int)) as base",
            "explode(sequence(0, case when o_custkey % 20 = 0 then 2 when o_custkey % 4 = 0 then 1 else 0 end)) as i",
        )
        .selectExpr("*", "price div (case when k % 3 = 0 then 1 else i + 1 end) as p", "k % 10 in (5, 6, 7) as settled", "k % 10 in (1, 2, 5, 6, 7, 8) as decided")
    )
    stamp = "MMM d, yyyy \\'@\\' HH:mm:ss.SSS"
    return _select(
        rows,
        [
            "concat(book, k) as claimnumber",
            "concat('P', k) as policycode",
            f"case when k % 101 = 0 then '2' else {_pick(SNAPSHOT_STATUS_NAMES, 'k % 10')} end as statusname",
            f"{_pick(COVERAGE_NAMES, '(k + i) % 4')} as loai_hinh_trans",
            f"{_pick(CAUSES, f'(k + 3 * i) % {len(CAUSES)}')} as nguyen_nhan_ton_that",
            "case when k % 14 = 0 then 'Hai xe va chạm, nạn nhân được đưa đi cấp cứu' "
            "when k % 14 = 1 then 'Lái xe BỊ THƯƠNG nhẹ' "
            "when k % 14 = 2 and i = 0 then 'Người đi đường tử vong' else 'Xe va quệt nhẹ' end as noi_dung_tai_nan",
            f"{_pick(['Tự bồi thường', 'Bồi thường hệ thống', '12'], 'k % 3')} as solutioncompensation",
            f"{_day(_plus('-5'), '-')} as createddate",
            f"case when k % 101 = 0 then '-' else {_day(_plus('40'), '-')} end as updateddate",
            f"case when k % 12 = 0 then '-' when k % 23 = 0 then {_day(_plus('-10'))} else {_day(_plus('-3'))} end "
            "as payment_date",
            f"{_day(_plus('-100'))} as ngaybatdau",
            f"{_day(_plus('265'))} as ngayketthuc",
            f"case when k % 61 = 0 then {_day(_plus('9'))} else {_day('base')} end as requesterdate",
            f"{_day(_plus('1 + k % 3'))} as ngay_mo_hsbt",
            f"{_day(_plus('-(k % 5)'))} as accidentdate",
            f"case when decided and k % 17 <> 0 then {_dmy(_plus('15 + k % 20'), stamp)} else '-' end as approveddate",
            f"case when (k + i) % 6 = 0 then '-' else {_commas('p')} end as uoc_bt_ban_dau",
            f"case when (k + i) % 7 = 0 then '-' else {_commas('p - p div 10')} end as ubt",
            f"case when (k + i) % 7 = 0 then '-' else {_commas('(p - p div 10) div 11 * 10')} end as ubt_truoc_thue",
            f"case when k % 31 = 0 then '0' else {_commas('p')} end as tong_uoc_bt_truoc_thue",
            f"case when settled then case when (k + i) % 13 = 0 then '-' else {_commas('p div 5 * 4')} end "
            f"when k % 43 = 0 then {_commas('cast(1000000 as bigint)')} else '-' end as stbt",
            f"case when settled and (k + i) % 13 <> 0 then {_commas('p div 5 * 4 div 11 * 10')} else '-' end "
            "as stbt_truoc_thue",
            f"case when k % 25 = 0 then {_commas('k % 7 * 100000')} else '0' end as cost_cuuho",
            f"case when k % 8 = 0 then '-' else {_commas('k % 5 * 1000000')} end as cost_giam_tru",
            f"{_commas('c % 3 * 500000')} as cost_khau_tru",
            f"case when k % 19 = 0 then '-' else {_commas('k % 5 * 1000000 + c % 3 * 500000')} end "
            "as cost_tong_khau_giam_tru",
            "'0' as cost_3rdparty",
            "'0' as compensation_amount",
            "case when k % 9 = 0 then '0' when k % 47 = 0 then '-' else cast(14 + k % 20 - k % 3 as string) end as processdays",
            f"{_commas('p div 3')} as damageestimation",
            f"{_pick(VEHICLES, f'k % {len(VEHICLES)}')} as loaixe",
            f"{_pick(MAKES, 'k % 4')} as hangxe",
            "case when c % 4 = 0 then 'Tổ chức' else 'Cá nhân' end as customer_type",
            "case when k % 53 = 0 then '-' else concat('Đơn vị ', c % 10) end as agencycompensation",
            "concat('GDV ', c % 25) as assignee_fullname",
        ],
        columns,
    )


def policies_raw(spark: SparkSession, sf: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Policy table, one row per certificate term, all columns text; certificates repeat per customer."""
    rows = load(
        spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    ).selectExpr(
        "o_orderkey as k",
        "o_custkey as c",
        "cast(round(o_totalprice * 100) as bigint) as price",
        "to_date(o_orderdate) as base",
    )
    return _select(
        rows,
        [
            "concat('GCN', c) as sogcn",
            "concat('P', k) as policycode",
            "concat('KH', c) as customercode",
            f"{_pick(POLICY_STATUS_NAMES, 'k % 5')} as status_trans",
            f"{_dmy(_plus('2 - k % 10'))} as createddate",
            f"case when k % 97 = 0 then '' when k % 89 = 0 then '-' else {_dmy('base')} end as ngaybatdau",
            f"{_dmy(_plus('30 * (1 + k % 24)'))} as ngayketthuc",
            f"{_commas('price')} as finalprice",
            f"{_commas('price div 10')} as tndsbb",
            f"case when k % 7 = 0 then '-' else {_commas('price div 20')} end as lpx",
            f"{_commas('price div 2')} as vcx",
            f"case when k % 11 = 0 then '' else {_commas('price div 4')} end as tndstn",
            "case when k % 13 = 0 then '-' else cast(4 + k % 40 as string) end as sochongoi",
            f"{_pick(MAKES, 'k % 4')} as hangxe",
            f"{_pick(VEHICLES, f'k % {len(VEHICLES)}')} as loaixe",
            "case when k % 29 = 0 then '-' when k % 3 = 0 then 'Kinh doanh' else 'Không kinh doanh' end as mdsd",
            "concat('Tỉnh ', c % 63) as tinhthanhchuxe",
            "case when c % 4 = 0 then 'Tổ chức' else 'Cá nhân' end as customer_type_trans",
            "concat('NV ', c % 50) as assigneename",
        ],
        columns,
    )


def policies(spark: SparkSession, sf: str) -> DataFrame:
    """Policies already typed: the input of the exposure metrics."""
    return load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).selectExpr(
        "concat('P', o_orderkey) as policycode",
        "concat('KH', o_custkey) as customercode",
        "concat('GCN', o_custkey) as certificate_no",
        "date_add(to_date(o_orderdate), cast(2 - o_orderkey % 10 as int)) as createddate",
        "to_date(o_orderdate) as start_date",
        "date_add(to_date(o_orderdate), cast(30 * (1 + o_orderkey % 24) as int)) as end_date",
        "cast(o_totalprice as decimal(15,2)) as finalprice",
        "case when o_orderkey % 3 = 0 then 'Terminated' else 'Active' end as status_trans",
    )


def claims(spark: SparkSession, sf: str) -> DataFrame:
    """Claims already typed, one per order, with or without lines: the input of the loss metrics."""
    lines = (
        load(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice", "l_shipdate"])
        .selectExpr(
            "l_orderkey",
            "cast(l_extendedprice as decimal(15,2)) as price",
            "to_date(l_shipdate) as ship",
        )
        .groupBy("l_orderkey")
        .agg(F.sum("price").cast("decimal(15,2)").alias("total"), F.max("ship").alias("updated"))
    )
    orders = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    joined = joined.withColumns(
        {
            "total": F.coalesce("total", F.lit(0).cast("decimal(15,2)")),
            "updated": F.coalesce("updated", F.to_date("o_orderdate")),
        }
    )
    return joined.selectExpr(
        "concat('C', o_orderkey) as claimnumber",
        "concat('P', o_orderkey) as policycode",
        "case o_orderstatus when 'F' then 'paid out' when 'P' then 'approved' else 'in process' end as claim_status",
        "to_date(o_orderdate) as claim_submitted_date",
        "date_add(to_date(o_orderdate), cast(1 + o_orderkey % 3 as int)) as claim_opened_date",
        "case when o_orderstatus <> 'O' then date_add(to_date(o_orderdate), cast(5 + o_orderkey % 60 as int)) end "
        "as claim_approved_date",
        "updated as updateddate",
        f"{_pick(list(v.COVERAGE_BY_CODE.values()), 'o_orderkey % 4')} as coverage",
        f"{_pick([v.INJURY, v.PARTIAL_TOTAL, v.THIRD_PARTY_VEHICLE, v.THIRD_PARTY_OTHER, v.THEFT], 'o_custkey % 5')} "
        "as damage_type",
        f"{_pick(list(v.VEHICLE_CLASSES), 'o_custkey % 7')} as vehicle_type",
        "total as claim_estimate_first",
        "cast(o_totalprice as decimal(15,2)) as total_claim_estimate",
        "case when o_orderstatus <> 'O' then cast(total * 0.8 as decimal(15,2)) else cast(0 as decimal(15,2)) end "
        "as compensation_total",
    )
