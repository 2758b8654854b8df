"""Category vocabularies of the source systems and the names they are reported under."""

from __future__ import annotations

# Workflow state names of the claim status log.
HISTORY_STATUS = {
    "Mới": "submitted",
    "Chưa giám định": "assessment pending",
    "Chờ lập PASC": "estimate pending",
    "Đang xử lý": "in process",
    "Đang xử lý bồi thường": "in process",
    "Đã duyệt": "approved",
    "Đã chi trả bồi thường": "paid out",
    "Từ chối": "denied",
    "Đã hủy": "cancelled",
    "Đã huỷ": "cancelled",
    "Chờ hoàn thiện hồ sơ": "documents pending",
}

# The snapshot uses the same raw names, without the newly submitted state.
SNAPSHOT_STATUS = {raw: state for raw, state in HISTORY_STATUS.items() if state != "submitted"}

# States still open in the snapshot are reported together.
OPEN_STATES = ("assessment pending", "estimate pending", "documents pending", "in process")
SNAPSHOT_STATUS_COARSE = {
    raw: "in process" if state in OPEN_STATES else state for raw, state in SNAPSHOT_STATUS.items()
}

# Which state names a claim when its log holds several, strongest first.
# `submitted` alone leaves a claim without a resolved state.
STATUS_PRIORITY = (
    "paid out",
    "denied",
    "cancelled",
    "approved",
    "in process",
    "documents pending",
    "assessment pending",
    "estimate pending",
)

# Policy states.
POLICY_STATUS = {
    "Đang có hiệu lực": "Active",
    "Chấm dứt": "Terminated",
    "Hết hiệu lực": "Expired",
    "Chưa tới hiệu lực": "Not Activated",
}

# Vehicle usages.
USAGE = {"Không kinh doanh": "Non-commercial", "Kinh doanh": "Commercial"}

# Customer types.
POLICY_CUSTOMER = {"Cá nhân": "Personal", "Tổ chức": "Business"}
CLAIM_CUSTOMER = {"Cá nhân": "personal", "Tổ chức": "business"}

# Coverages by code.
COVERAGE_BY_CODE = {
    "LPX": "Personal injury coverage",
    "TNDSBB": "Auto liability coverage",
    "VCX": "Collision coverage",
    "TNDSTN": "Comprehensive coverage",
}

# Coverages by name.
COVERAGE_BY_NAME = {
    "Tai nạn LPX & NNTX": "Personal injury coverage",
    "TNDS bắt buộc": "Auto liability coverage",
    "Vật chất xe": "Collision coverage",
    "TNDS tự nguyện": "Comprehensive coverage",
}

# Compensation routes.
OWN_ROUTE, SYSTEM_ROUTE = "Self-insurance", "Traditional insurance"
COMPENSATION_ROUTE = {"Tự bồi thường": OWN_ROUTE, "Bồi thường hệ thống": SYSTEM_ROUTE}

# Damage groups.
INJURY = "Personal Injury Loss"
PARTIAL_TOTAL = "Partial/Total Loss"
THIRD_PARTY_VEHICLE = "Third-Party Vehicle Property"
THIRD_PARTY_OTHER = "Other Third-Party Property"
THEFT = "Theft"
UNKNOWN = "Unknown"

# Damage names of the log.
HISTORY_DAMAGE = {
    "Tổn thất về người": INJURY,
    "Tổn thất bộ phận/toàn bộ": PARTIAL_TOTAL,
    "Thủy kích": PARTIAL_TOTAL,
    "Tài sản bên thứ 3 về xe": THIRD_PARTY_VEHICLE,
    "Tài sản bên thứ 3 khác": THIRD_PARTY_OTHER,
    "Mất cắp bộ phận": THEFT,
}

# Phrases of the accident narrative that mean someone was hurt.
INJURY_PHRASES = ("người chết", "bị thương", "tử vong", "cấp cứu", "bệnh viện", "nhập viện")

# Vehicle types by class.
VEHICLE_CLASSES = {
    "Private Passenger Vehicles": (
        "Xe không kinh doanh đến 08 chỗ",
        "Xe bán tải (pickup, minivan)",
        "Xe không kinh doanh trên 08 chỗ",
    ),
    "Commercial Freight Vehicles": ("Xe tải", "Xe đầu kéo", "Rơ mooc thông thường"),
    "Commercial Passenger Vehicles": (
        "Xe kinh doanh vận tải hành khách liên tỉnh, Xe giường nằm",
        "Xe kinh doanh chở người còn lại",
        "Xe kinh doanh chở người đến 08 chỗ",
        "Xe tập lái",
    ),
    "Ride-share Vehicles": ("Xe taxi công nghệ", "Xe taxi truyền thống"),
    "Motorcycles": ("Trên 50 cc", "Xe mô tô ba bánh, xe gắn máy và các loại xe cơ giới tương tự"),
    "Government & Emergency Vehicles": ("Xe bus", "Xe cứu thương"),
    "Specialized Vehicles": (
        "Xe chở tiền",
        "Xe hoạt động trong vùng khai thác khoáng sản",
        "Xe hoạt động trong nội cảng, khu công nghiệp, sân bay",
        "Xe chuyên dùng còn lại",
        "Xe đông lạnh",
    ),
}

# Loss causes as the snapshot writes them, several joined by commas, by accident type.
ACCIDENT_TYPES = {
    "Car Accidents": (
        "Đâm/va xe ô tô",
        "Đâm/va xe ô tô,Khác",
        "Đâm/va xe ô tô,Đâm/va vật thể cố định",
        "Vật thể khác rơi vào,Đâm/va xe ô tô",
        "Đâm/va vật thể cố định,Đâm/va xe ô tô",
    ),
    "Bicycle/Motorcycle Accidents": (
        "Đâm/va xe máy",
        "Đâm/va xe máy,Khác",
        "Khác,Đâm/va xe máy",
        "Đâm/va xe máy,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Đâm/va xe máy",
        "Đâm/va xe máy,Vật thể khác rơi vào",
        "Vật thể khác rơi vào,Đâm/va xe máy,Đâm/va vật thể cố định",
    ),
    "Single-Vehicle Accident": (
        "Đâm/va vật thể cố định",
        "Đâm/va động vật",
        "Lật xe",
        "Rơi xe",
        "Khác,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Vật thể khác rơi vào",
        "Vật thể khác rơi vào,Đâm/va vật thể cố định",
        "Đâm/va động vật,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Đâm/va động vật",
        "Đâm/va vật thể cố định,Lật xe",
        "Rơi xe,Lật xe",
    ),
    "External Causes/Non-Collison Damages": (
        "Vật thể khác rơi vào",
        "Bị phá hoại",
        "Hỏa hoạn, cháy, nổ",
        "Mất cắp",
        "Do thiên nhiên",
        "Thủy kích",
        "Khác,Chi phí cứu hộ",
    ),
    "Multi-Vehicle Accidents ": (
        "Đâm/va xe máy,Đâm/va xe ô tô",
        "Đâm/va xe ô tô,Đâm/va xe máy",
    ),
}

# Causes that decide the damage group on their own, whatever the coverage.
DAMAGE_BY_CAUSE = {
    PARTIAL_TOTAL: (
        "Lật xe",
        "Vật thể khác rơi vào",
        "Bị phá hoại",
        "Rơi xe",
        "Thủy kích",
        "Đâm/va động vật",
        "Hỏa hoạn, cháy, nổ",
        "Rơi xe,Lật xe",
    ),
    THEFT: (
        "Mất cắp",
    ),
    THIRD_PARTY_OTHER: (
        "Đâm/va vật thể cố định",
        "Khác,Đâm/va vật thể cố định",
    ),
}

# Causes that decide the damage group under compulsory liability only.
DAMAGE_BY_LIABILITY_CAUSE = {
    THIRD_PARTY_VEHICLE: (
        "Đâm/va xe máy",
        "Đâm/va xe ô tô",
        "Đâm/va xe máy,Khác",
        "Khác,Đâm/va xe máy",
        "Đâm/va xe máy,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Đâm/va xe máy",
        "Đâm/va xe máy,Vật thể khác rơi vào",
        "Vật thể khác rơi vào,Đâm/va xe máy,Đâm/va vật thể cố định",
        "Đâm/va xe ô tô,Khác",
        "Đâm/va xe ô tô,Đâm/va vật thể cố định",
        "Vật thể khác rơi vào,Đâm/va xe ô tô",
        "Đâm/va vật thể cố định,Đâm/va xe ô tô",
        "Đâm/va xe máy,Đâm/va xe ô tô",
    ),
    THIRD_PARTY_OTHER: (
        "Đâm/va vật thể cố định,Vật thể khác rơi vào",
        "Vật thể khác rơi vào,Đâm/va vật thể cố định",
        "Đâm/va động vật,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Đâm/va động vật",
        "Đâm/va vật thể cố định,Lật xe",
    ),
}

# Fixed value: compensation is net of tax; net * 100 / NET_SHARE restores the gross estimate.
NET_SHARE = "92.5926"
