"""Thresholds, labels and defaults that the results depend on.

They are stated once, here, in the order in which they apply.
"""

from __future__ import annotations

import datetime as dt

# Open end of a dimension row.
OPEN_END = dt.date(9999, 12, 31)

# First value of a surrogate key, and of a batch number.
FIRST_KEY = 1000
FIRST_BATCH = 1

# Staging defaults for missing source values.
DEFAULT_COUNTRY = "GB"
DEFAULT_SEGMENT = "RETAIL"
DEFAULT_CHANNEL = "UNKNOWN"
DEFAULT_OPT_IN = "N"
DEFAULT_TIER = "STANDARD"
DEFAULT_REGION = "UNKNOWN"

# Staging status.
PENDING = "PENDING"
LOADED = "LOADED"

# Look-back windows in days.
PROFILE_DAYS = 7
SPEND_DAYS = 7
EVENT_DAYS = 90
INTERACTION_DAYS = 30
REGIONAL_DAYS = 30

# Default model version.
MODEL_VERSION = "v2.1"

# Churn risk: no purchase ever, then more than this many days since the last one, else the last value.
CHURN_NEVER_BOUGHT = "0.95"
CHURN_STEPS = ((180, "0.80"), (90, "0.50"), (30, "0.20"))
CHURN_RECENT = "0.05"
CHURN_LIMIT = "0.70"
NEVER_BOUGHT_DAYS = 999

# Lifetime value score: value / 1000, capped in one variant; above 5 counts as high value.
CLV_CAP = "10.0"
HIGH_VALUE_CLV = "5"

# Engagement: more than this many interactions, or conversions, else zero.
INTERACTION_STEPS = ((10, "1.0"), (5, "0.75"), (0, "0.25"))
CONVERSION_STEPS = ((10, "1.0"), (5, "0.75"), (1, "0.50"), (0, "0.25"))

# Segment labels, short form and long form.
SHORT_LABELS = {
    "VIP": "High-Value Premium",
    "RETAIL": "Standard Retail",
    "WHOLESALE": "B2B Wholesale",
}
LONG_LABELS = {
    "VIP": "High-Value Premium Customer",
    "RETAIL": "Standard Retail Customer",
    "WHOLESALE": "B2B Wholesale Customer",
}
NO_LABEL = "Unclassified"

# Composite score weights; lifetime value is scaled by the last figure, so that 10000 earns the full spend weight.
WEIGHT_CLV = "0.30"
WEIGHT_RETENTION = "0.25"
WEIGHT_ENGAGEMENT = "0.20"
WEIGHT_PROPENSITY = "0.15"
WEIGHT_SPEND = "0.10"
SPEND_SCALE = "0.0001"

# Micro-segments by lowest composite score.
MICRO_SEGMENTS = (
    ("0.8", "CHAMPION"),
    ("0.6", "LOYAL_CUSTOMER"),
    ("0.4", "POTENTIAL_LOYALIST"),
    ("0.2", "AT_RISK"),
)
LOWEST_MICRO_SEGMENT = "LOST_CUSTOMER"

# Interventions.
WINBACK = "WINBACK_CAMPAIGN"
REENGAGE = "REENGAGEMENT_CAMPAIGN"
UPGRADE = "VIP_UPGRADE"
NO_ACTION = "NO_ACTION"

# Campaign event types.
SENT = "SENT"
OPENED = "OPENED"
CLICKED = "CLICKED"
CONVERTED = "CONVERTED"
UNSUBSCRIBED = "UNSUBSCRIBED"

# Prerequisite status codes; any other status gives 1.
STATUS_CODES = {"SUCCESS": 0, "COMPLETED": 0, "RUNNING": 2, "NOT_FOUND": 3}
OTHER_STATUS_CODE = 1
NOT_FOUND = "NOT_FOUND"
SLA_MINUTES = 300

# Catalog filters of the lineage reads.
DEPENDENT_TYPES = ("PACKAGE BODY", "PROCEDURE", "FUNCTION", "TRIGGER")
REFERENCED_TYPES = ("TABLE", "VIEW", "SYNONYM")
TRACKED_PRIVILEGES = ("SELECT", "INSERT", "UPDATE", "DELETE")
TRACED_SCHEMAS = ("CRM_SCHEMA", "DW_OWNER", "FINANCE_SCHEMA")
LINK_TYPE = "CROSS_REPO_GRANT"
UNKNOWN_REPOSITORY = "unknown"

# Feature scoring: every feature is divided by this and capped at one.
FEATURE_SCALE = 1000.0
DEFAULT_CAMPAIGN_WINDOW = 90
DEFAULT_INTERACTION_WINDOW = 30
