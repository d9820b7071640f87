"""Aliases, patterns, seed rows, thresholds.

These must equal the published business rules for results to be right, so they
are stated as plain tables and kept together.
"""

from __future__ import annotations

# Order states: canonical code -> accepted spellings.
STATE_ALIASES = {
    "acknowledged": ["ACKNOWLEDGED", "ACK"],
    "rejected": ["REJECTED", "REJECT"],
    "pending": ["PENDING"],
    "held": ["HOLD", "HELD"],
    "inProgress": ["IN_PROGRESS", "INPROGRESS"],
    "cancelled": ["CANCELLED", "CANCEL"],
    "completed": ["COMPLETED", "COMPLETE"],
    "failed": ["FAILED", "FAIL"],
    "partial": ["PARTIAL"],
}

# Order categories.
CATEGORY_ALIASES = {
    "NEW": ["NEW"],
    "MODIFY": ["MODIFY", "UPGRADE", "DOWNGRADE"],
    "TERMINATE": ["TERMINATE"],
    "SUSPEND": ["SUSPEND"],
    "RESUME": ["RESUME"],
}

# Sales channels.
CHANNEL_ALIASES = {
    "DIGITAL_APP": ["MYAPP", "STC APP", "JAWWY"],
    "DIGITAL_WEB": ["WEB", "PORTAL"],
    "RETAIL": ["STORE", "RETAIL"],
    "TELESALES": ["TELESALES", "CALL CENTER"],
    "B2B_PORTAL": ["B2B"],
    "PARTNER": ["PARTNER"],
}

# Contact and identity patterns.
MOBILE_LOCAL = r"^05[0-9]{8}$"
MOBILE_INTL = r"^9665[0-9]{8}$"
MOBILE_PLUS = r"^\+9665[0-9]{8}$"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NATIONAL_ID = r"^[12][0-9]{9}$"

# Money rules.
VAT_RATE = "0.15"
VAT_DIVISOR = "1.15"
VAT_TOLERANCE = 0.01
VAT_PERCENT = 15.0
LARGE_AMOUNT = 500000
BILLING_TOLERANCE = 1

# Service-level rules, in hours.
SLA_ENTERPRISE = 4
SLA_SMB = 8
SLA_5G = 12
SLA_FIBER = 48
SLA_DEFAULT = 24
SLA_COMPLIANCE_TARGET = 95.0
SLA_BASELINE = 24
BREACH_SLIGHT = 6
BREACH_MODERATE = 24
CRITICAL_STATES = ["acknowledged", "inProgress", "pending"]
FALLOUT_STATES = ["held", "failed"]
FAILURE_STATES = ["failed", "cancelled", "rejected"]

# Batch gate of the order feed, percent.
ORDER_GATE = 97.0

# Gates per conformed fact, percent.
FACT_GATES = {
    "fact_production_daily": 98.0,
    "fact_equipment_downtime": 97.0,
    "fact_maintenance_workorder": 97.0,
    "fact_pipeline_flow": 98.5,
    "fact_refinery_yield": 98.0,
    "fact_hse_incident": 99.0,
    "fact_financial_actuals": 99.0,
}
DEFAULT_GATE = 97.0
MART_GATE = 99.0

# Code prefixes.
COST_CENTER_DOMAINS = {"UP": "upstream", "MS": "midstream", "DS": "downstream"}
PRODUCT_FAMILIES = {
    "GASOLINE": "LIGHT_DISTILLATE",
    "DIESEL": "MIDDLE_DISTILLATE",
    "JET": "MIDDLE_DISTILLATE",
}

# Incident rates are stated per this many hours worked.
INCIDENT_RATE_HOURS = 200000.0
TRIR_ALERT = 1.0
AVAILABILITY_WATCH = 95.0

OPEN_END = "9999-12-31"
UNKNOWN_SINCE = "2000-01-01"

# Order-state dimension.
ORDER_STATE_SCHEMA = (
    "order_state_sk int, order_state_cd string, order_state_nm string, order_state_nm_ar string, "
    "state_category string, is_terminal_state string, is_sla_clock_running string, "
    "is_billable_state string, sort_order int, state_color_hex string"
)
ORDER_STATES = [
    (1, "acknowledged", "Acknowledged", "مقبول", "ACTIVE", "N", "Y", "N", 1, "#1E88E5"),
    (2, "rejected", "Rejected", "مرفوض", "TERMINAL", "Y", "N", "N", 9, "#E53935"),
    (3, "pending", "Pending", "معلق", "PAUSED", "N", "N", "N", 3, "#FB8C00"),
    (4, "held", "Held", "محتجز", "PAUSED", "N", "N", "N", 4, "#F4511E"),
    (5, "inProgress", "In Progress", "قيد التنفيذ", "ACTIVE", "N", "Y", "N", 5, "#43A047"),
    (6, "cancelled", "Cancelled", "ملغى", "TERMINAL", "Y", "N", "N", 7, "#757575"),
    (7, "completed", "Completed", "مكتمل", "TERMINAL", "Y", "N", "Y", 6, "#00897B"),
    (8, "failed", "Failed", "فشل", "TERMINAL", "Y", "N", "N", 8, "#C62828"),
    (9, "partial", "Partial", "جزئي", "TERMINAL", "Y", "N", "Y", 6, "#558B2F"),
    (-1, "UNKNOWN", "Unknown", "غير معروف", "ACTIVE", "N", "N", "N", 99, "#9E9E9E"),
]

# Channel dimension; the unknown member carries -1 so that fallback keys resolve.
CHANNEL_SCHEMA = (
    "channel_sk int, channel_cd string, channel_type_cd string, channel_nm_en string, "
    "channel_nm_ar string, medium_cd string, is_digital_flag string, is_self_service string, "
    "channel_group string"
)
CHANNELS = [
    (1, "DIGITAL_APP", "DIGITAL", "STC App", "تطبيق STC", "MOBILE_APP", "Y", "Y", "DIGITAL"),
    (2, "DIGITAL_WEB", "DIGITAL", "STC Web Portal", "البوابة الإلكترونية", "WEB", "Y", "Y", "DIGITAL"),
    (3, "RETAIL", "PHYSICAL", "Retail Store", "متجر التجزئة", "IN_STORE", "N", "N", "DIRECT"),
    (4, "TELESALES", "ASSISTED", "Telesales", "المبيعات الهاتفية", "IVRS", "N", "N", "DIRECT"),
    (5, "B2B_PORTAL", "DIGITAL", "B2B Portal", "بوابة الأعمال", "WEB", "Y", "Y", "DIGITAL"),
    (6, "PARTNER", "INDIRECT", "Partner/MVNO", "الشريك", "API", "N", "N", "INDIRECT"),
    (-1, "UNKNOWN", "UNKNOWN", "Unknown", "غير معروف", "UNKNOWN", "N", "N", "UNKNOWN"),
]

# Order-item actions.
ACTION_SCHEMA = (
    "action_sk int, action_cd string, action_nm string, action_nm_ar string, "
    "is_revenue_generating string"
)
ACTIONS = [
    (1, "add", "Add (New Product)", "إضافة", "Y"),
    (2, "modify", "Modify (Upgrade)", "تعديل", "Y"),
    (3, "delete", "Delete (Terminate)", "حذف", "N"),
    (4, "noChange", "No Change (Unchanged)", "بدون تغيير", "N"),
    (-1, "UNKNOWN", "Unknown", "غير معروف", "N"),
]

# Calendar names.
WEEKDAYS_AR = ["الأحد", "الاثنين", "الثلاثاء", "الأربعاء", "الخميس", "الجمعة", "السبت"]
MONTHS_AR = [
    "يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو",
    "يوليو", "أغسطس", "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر",
]
HIJRI_MONTHS_AR = [
    "محرم", "صفر", "ربيع الأول", "ربيع الآخر", "جمادى الأولى", "جمادى الآخرة",
    "رجب", "شعبان", "رمضان", "شوال", "ذو القعدة", "ذو الحجة",
]
