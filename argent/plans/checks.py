"""Check suites per silver table and freshness rules per source group.

Our encoding of the reference's column tests; table names are ours.
"""

from __future__ import annotations

from argent.functions.exprs import EMAIL_PATTERN_COLUMN
from argent.operators.quality import Freshness, in_range, matches, not_after, not_null, unique

# Freshness thresholds per source group (minutes).
FRESHNESS = {
    "erp": Freshness(warn_minutes=60, error_minutes=240),
    "crm": Freshness(warn_minutes=60, error_minutes=240),
    "marketing": Freshness(warn_minutes=24 * 60, error_minutes=48 * 60),
}

SUITES = {
    "order_headers": [
        unique("ORDER_ID"), not_null("ORDER_ID"), not_null("CUSTOMER_ID"),
        not_null("TOTAL_AMOUNT"), in_range("TOTAL_AMOUNT", min_value=0),
        not_null("ORDER_DATE"), not_after("ORDER_DATE", severity="warn"),
    ],
    "order_lines": [
        unique("LINE_ID"), not_null("LINE_ID"), not_null("ORDER_ID"),
        in_range("QUANTITY", min_value=1, severity="warn"),
    ],
    "addresses": [unique("ADDRESS_ID"), not_null("ADDRESS_ID")],
    "city_tiers": [unique("CITY_TIER_ID"), not_null("TIER", severity="warn")],
    "categories": [unique("CATEGORY_ID"), not_null("CATEGORY_ID")],
    "brands": [unique("BRAND_ID"), not_null("BRAND_ID")],
    "item_history": [
        unique("scd_id"), not_null("scd_id"), not_null("ITEM_ID"), not_null("STATUS", severity="warn"),
    ],
    "customer_history": [
        unique("scd_id"), not_null("scd_id"), not_null("CUSTOMER_ID"),
        not_null("EMAIL"), matches("EMAIL", EMAIL_PATTERN_COLUMN, severity="warn"),
        not_null("REGISTRATION_DATE"),
    ],
    "registration_source": [unique("REGISTRATION_ID"), not_null("CUSTOMER_ID"), not_null("CHANNEL")],
    "incidents": [unique("INCIDENT_ID"), not_null("INCIDENT_ID")],
    "interactions": [unique("INTERACTION_ID"), not_null("INTERACTION_ID")],
    "surveys": [
        unique("SURVEY_ID"), not_null("SURVEY_ID"),
        in_range("NPS_SCORE", 0, 10, severity="warn"), in_range("CSAT_SCORE", 1, 5, severity="warn"),
    ],
    "campaigns": [unique("CAMPAIGN_ID"), not_null("CAMPAIGN_ID"), in_range("TOTAL_SPEND", min_value=0, severity="warn")],
}
