"""Fixed values as the checking statements expect them, written out beside the library's own vocabularies.

A wrong value in either place makes the rows of the two engines differ.
"""

# Fixed values.
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

# Fixed values.
SNAPSHOT_STATUS = {
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

# Fixed values.
SNAPSHOT_STATUS_COARSE = {
    "Chưa giám định": "in process",
    "Chờ lập PASC": "in process",
    "Đang xử lý": "in process",
    "Đang xử lý bồi thường": "in process",
    "Đã duyệt": "approved",
    "Đã chi trả bồi thường": "paid out",
    "Từ chối": "denied",
    "Đã hủy": "cancelled",
    "Đã huỷ": "cancelled",
    "Chờ hoàn thiện hồ sơ": "in process",
}

# Fixed values.
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

# Fixed values.
POLICY_STATUS = {
    "Đang có hiệu lực": "Active",
    "Chấm dứt": "Terminated",
    "Hết hiệu lực": "Expired",
    "Chưa tới hiệu lực": "Not Activated",
}

# Fixed values.
USAGE = {
    "Không kinh doanh": "Non-commercial",
    "Kinh doanh": "Commercial",
}

# Fixed values.
POLICY_CUSTOMER = {
    "Cá nhân": "Personal",
    "Tổ chức": "Business",
}

# Fixed values.
CLAIM_CUSTOMER = {
    "Cá nhân": "personal",
    "Tổ chức": "business",
}

# Fixed values.
COVERAGE_BY_CODE = {
    "LPX": "Personal injury coverage",
    "TNDSBB": "Auto liability coverage",
    "VCX": "Collision coverage",
    "TNDSTN": "Comprehensive coverage",
}

# Fixed values.
COVERAGE_BY_NAME = {
    "Tai nạn LPX & NNTX": "Personal injury coverage",
    "TNDS bắt buộc": "Auto liability coverage",
    "Vật chất xe": "Collision coverage",
    "TNDS tự nguyện": "Comprehensive coverage",
}

# Fixed values.
COMPENSATION_ROUTE = {
    "Tự bồi thường": "Self-insurance",
    "Bồi thường hệ thống": "Traditional insurance",
}

# Fixed values.
HISTORY_DAMAGE = {
    "Tổn thất về người": "Personal Injury Loss",
    "Tổn thất bộ phận/toàn bộ": "Partial/Total Loss",
    "Thủy kích": "Partial/Total Loss",
    "Tài sản bên thứ 3 về xe": "Third-Party Vehicle Property",
    "Tài sản bên thứ 3 khác": "Other Third-Party Property",
    "Mất cắp bộ phận": "Theft",
}

# Fixed values.
INJURY_PHRASES = ("người chết", "bị thương", "tử vong", "cấp cứu", "bệnh viện", "nhập viện")

# Fixed values.
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
    "Motorcycles": (
        "Trên 50 cc",
        "Xe mô tô ba bánh, xe gắn máy và các loại xe cơ giới tương tự",
    ),
    "Government & Emergency Vehicles": ("Xe bus", "Xe cứu thương"),
    "Specialized Vehicles": (
        "Xe chở tiền",
        "Xe hoạt động trong vùng khai thác khoáng sản",
        "Xe hoạt động trong nội cảng, khu công nghiệp, sân bay",
        "Xe chuyên dùng còn lại",
        "Xe đông lạnh",
    ),
}

# Fixed values.
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
    "Multi-Vehicle Accidents ": ("Đâm/va xe máy,Đâm/va xe ô tô", "Đâm/va xe ô tô,Đâm/va xe máy"),
}

# Fixed values.
DAMAGE_BY_CAUSE = {
    "Partial/Total Loss": (
        "Lật xe",
        "Vật thể khác rơi vào",
        "Bị phá hoại",
        "Rơi xe",
        "Thủy kích",
        "Đâm/va động vật",
        "Hỏa hoạn, cháy, nổ",
        "Rơi xe,Lật xe",
    ),
    "Theft": ("Mất cắp",),
    "Other Third-Party Property": ("Đâm/va vật thể cố định", "Khác,Đâm/va vật thể cố định"),
}

# Fixed values.
DAMAGE_BY_LIABILITY_CAUSE = {
    "Third-Party Vehicle Property": (
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
    "Other Third-Party Property": (
        "Đâm/va vật thể cố định,Vật thể khác rơi vào",
        "Vật thể khác rơi vào,Đâm/va vật thể cố định",
        "Đâm/va động vật,Đâm/va vật thể cố định",
        "Đâm/va vật thể cố định,Đâm/va động vật",
        "Đâm/va vật thể cố định,Lật xe",
    ),
}

# Fixed values.
INJURY = "Personal Injury Loss"

# Fixed values.
PARTIAL_TOTAL = "Partial/Total Loss"

# Fixed values.
THIRD_PARTY_VEHICLE = "Third-Party Vehicle Property"

# Fixed values.
THIRD_PARTY_OTHER = "Other Third-Party Property"

# Fixed values.
THEFT = "Theft"

# Fixed values.
UNKNOWN = "Unknown"
