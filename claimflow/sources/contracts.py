"""Contracts: how the raw text columns of each source enter the analysis schema.

Fixed values: source column names, target names and date patterns.
"""

from __future__ import annotations

from claimflow.operators.shaping import Field

DMY = "dd/MM/yyyy"
DMY_DASH = "dd-MM-yyyy"
ISO = "yyyy-MM-dd"
STAMP = "MMM d, yyyy '@' HH:mm:ss.SSS"

POLICY = (
    Field("sogcn", "certificate_no"),
    Field("policycode", "policycode"),
    Field("customercode", "customercode"),
    Field("status_trans", "status_trans"),
    Field("createddate", "createddate", "date", DMY),
    Field("ngaybatdau", "start_date", "date", DMY),
    Field("ngayketthuc", "end_date", "date", DMY),
    Field("finalprice", "finalprice", "money"),
    Field("tndsbb", "auto_liability_coverage", "money"),
    Field("lpx", "personal_injury_coverage", "money"),
    Field("vcx", "collision_coverage", "money"),
    Field("tndstn", "comprehensive_coverage", "money"),
    Field("sochongoi", "vehicle_seats", "int"),
    Field("hangxe", "vehicle_make"),
    Field("loaixe", "vehicle_type"),
    Field("mdsd", "vehicle_usage"),
    Field("tinhthanhchuxe", "regions_customer"),
    Field("customer_type_trans", "customer_type"),
)

# Amounts stay NULL where missing: each later reduction has its own rule for filling them.
STATUS_LOG = (
    Field("claimnumber", "claimnumber"),
    Field("policycode", "policycode"),
    Field("row_index", "row_index"),
    Field("claim_status_name", "claim_status_name"),
    Field("updateddate", "updateddate", "date", DMY),
    Field("accidentdate", "claim_accident_date", "date", DMY),
    Field("requesterdate", "claim_submitted_date", "date", DMY),
    Field("ngay_mo_hsbt", "claim_opened_date", "date", DMY),
    Field("flex_ngay_duyet", "claim_approved_date", "date", ISO),
    Field("ngay_thanh_toan", "payment_date", "date", DMY),
    Field("ngaybatdau", "policy_start_date", "date", DMY),
    Field("ngayketthuc", "policy_end_date", "date", DMY),
    Field("loai_hinh", "coverage"),
    Field("pham_vi", "damage_type"),
    Field("loai_boi_thuong", "solutioncompensation"),
    Field("cost_giam_tru", "cost_copay", "money0"),
    Field("cost_khau_tru", "cost_deductible", "money0"),
    Field("cost_tong_khau_giam_tru", "cost_copay_deductible", "money"),
    Field("uoc_bt_ban_dau", "claim_estimate_first", "money"),
    Field("ubt", "claim_estimate", "money"),
    Field("ubt_trans", "total_claim_estimate", "money"),
    Field("stbt_truoc_thue", "compensation_total", "money"),
    Field("don_vi_boi_thuong", "agencycompensation"),
    Field("gdv_xu_ly", "assignee_fullname"),
    Field("mdsd", "vehicle_usage"),
    Field("loaixe", "vehicle_type"),
    Field("hangxe", "vehicle_make"),
    Field("customer_type", "customer_type"),
)

SNAPSHOT = (
    Field("claimnumber", "claimnumber"),
    Field("policycode", "policycode"),
    Field("statusname", "statusname"),
    Field("loai_hinh_trans", "coverage"),
    Field("nguyen_nhan_ton_that", "accident_type"),
    Field("noi_dung_tai_nan", "narrative"),
    Field("solutioncompensation", "solutioncompensation"),
    Field("createddate", "createddate", "date", DMY_DASH),
    Field("updateddate", "updateddate", "date", DMY_DASH),
    Field("payment_date", "payment_date", "date", DMY),
    Field("ngaybatdau", "policy_start_date", "date", DMY),
    Field("ngayketthuc", "policy_end_date", "date", DMY),
    Field("requesterdate", "claim_submitted_date", "date", DMY),
    Field("ngay_mo_hsbt", "claim_opened_date", "date", DMY),
    Field("accidentdate", "claim_accident_date", "date", DMY),
    Field("approveddate", "claim_approved_date", "date", STAMP),
    Field("uoc_bt_ban_dau", "claim_estimate_first", "money0"),
    Field("ubt", "claim_estimate", "money0"),
    Field("ubt_truoc_thue", "claim_estimate_beforetax", "money0"),
    Field("tong_uoc_bt_truoc_thue", "total_claim_estimate", "money0"),
    Field("stbt", "compensation_total", "money0"),
    Field("stbt_truoc_thue", "compensation_amount_beforetax", "money0"),
    Field("cost_cuuho", "cost_towing", "money0"),
    Field("cost_giam_tru", "cost_copay", "money0"),
    Field("cost_khau_tru", "cost_deductible", "money0"),
    Field("cost_tong_khau_giam_tru", "cost_copay_deductible", "money0"),
    Field("processdays", "processdays", "int"),
    Field("damageestimation", "damageestimation", "money"),
    Field("loaixe", "vehicle_type"),
    Field("hangxe", "vehicle_make"),
    Field("customer_type", "customer_type"),
    Field("agencycompensation", "agencycompensation"),
    Field("assignee_fullname", "assignee_fullname"),
)

# The common claim schema: output of both cleaning plans, input of the metrics.
CLAIM_COLUMNS = (
    "claimnumber",
    "policycode",
    "claim_status",
    "claim_accident_date",
    "claim_submitted_date",
    "claim_opened_date",
    "claim_approved_date",
    "payment_date",
    "processdays",
    "cost_copay_deductible",
    "coverage",
    "assignee_fullname",
    "damage_type",
    "vehicle_type",
    "vehicle_make",
    "customer_type",
    "agencycompensation",
    "claim_estimate_first",
    "total_claim_estimate",
    "compensation_total",
    "updateddate",
)
