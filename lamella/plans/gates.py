"""The check suites between layers, as data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamella.operators.quality import WARN, accepted_values, holds, in_range, not_null, unique
from lamella.plans.commerce import ORDER_STATUSES
from lamella.plans.filings import LIEN_STATUSES, SATISFACTION_STATUSES
from lamella.plans.records import CASE_STATUSES, CASE_TYPES, STATES

TIERS = ["platinum", "gold", "silver", "bronze"]
_TEXT = {"empty_is_null": True}
_KEY = {"null_counts": True, "warn_from": 90.0}


def suites(reference_date: str) -> dict[tuple[str, str], list]:
    """Checks per (layer, table). Dates may not lie after ``reference_date``."""
    today = F.lit(reference_date).cast("date")
    return {
        ("bronze", "customers"): [
            not_null("customer_id"), not_null("email"), unique("customer_id", 90.0),
        ],
        ("bronze", "orders"): [
            not_null("order_id"), not_null("customer_id"), not_null("order_date"), unique("order_id"),
            accepted_values("status", ORDER_STATUSES), in_range("total_amount", 0, 100000),
        ],
        ("silver", "customers"): [
            unique("customer_id"), not_null("customer_id", 100.0), not_null("email", 100.0),
            accepted_values("is_active", [True, False], 100.0),
        ],
        ("silver", "orders"): [
            unique("order_id"), not_null("order_id", 100.0), not_null("customer_id", 100.0),
            accepted_values("status", ORDER_STATUSES, 100.0), not_null("total_amount", 100.0),
        ],
        ("silver", "order_items"): [unique("order_item_id"), not_null("order_item_id", 100.0)],
        ("silver", "products"): [
            unique("product_id"), not_null("product_id", 100.0), not_null("category", 100.0),
        ],
        ("gold", "customer_360"): [
            not_null("customer_id"), unique("customer_id"), accepted_values("ltv_tier", TIERS),
            in_range("total_revenue", 0), in_range("total_orders", 0),
        ],
        ("gold", "daily_revenue"): [
            unique("order_date"), not_null("order_date", 100.0), not_null("total_revenue", 100.0),
            not_null("order_count", 100.0),
        ],
        ("gold", "product_performance"): [
            unique("product_id"), not_null("product_id", 100.0), not_null("category", 100.0),
            not_null("total_revenue", 100.0), not_null("units_sold", 100.0),
        ],
        ("bronze", "suits"): [
            not_null("case_number", **_TEXT), not_null("filing_date", **_TEXT),
            not_null("plaintiff_name", severity=WARN, **_TEXT), accepted_values("state_code", STATES),
            holds("filing_date_not_future", F.col("filing_date") <= today),
            holds("has_party", F.coalesce("plaintiff_name", F.lit("")) != F.lit("")),
            holds("amount_non_negative", F.coalesce(F.col("amount_demanded") >= 0, F.lit(True))),
        ],
        ("silver", "suits"): [
            unique("suit_id", **_KEY), not_null("suit_id", 99.0, **_TEXT), not_null("filing_date", 99.0, **_TEXT),
            accepted_values("case_type", CASE_TYPES, 98.0), accepted_values("case_status", CASE_STATUSES, 98.0),
            accepted_values("state_code", STATES, 98.0),
            holds("filing_date_not_future", F.col("filing_date") <= today, 98.0),
        ],
        ("silver", "liens"): [
            unique("lien_id", **_KEY), not_null("state_code", 99.0, **_TEXT), not_null("filing_date", 99.0),
            accepted_values("lien_status", LIEN_STATUSES, 98.0),
            holds("filing_date_not_future", F.col("filing_date") <= today, 98.0),
            holds("amount_non_negative", F.coalesce(F.col("lien_amount") >= 0, F.lit(True))),
        ],
        ("silver", "judgments"): [
            unique("judgment_key", **_KEY), not_null("state_code", 99.0, **_TEXT), not_null("judgment_date", 99.0),
            accepted_values("satisfaction_status", SATISFACTION_STATUSES, 98.0), not_null("suit_id", 95.0, severity=WARN),
            holds("amount_non_negative", F.coalesce(F.col("judgment_amount") >= 0, F.lit(True))),
        ],
        ("silver", "party_master"): [
            unique("party_id", **_KEY), not_null("party_name_normalized", 99.0, **_TEXT), in_range("records", 1, threshold=100.0),
        ],
        ("gold", "lien_best_view"): [unique("lien_id", **_KEY), in_range("days_since_filing", 0, threshold=99.0)],
        ("gold", "judgment_best_view"): [unique("judgment_key", **_KEY)],
        ("gold", "party_profile"): [
            unique("party_key", **_KEY),
            holds("has_record", F.col("suits_as_plaintiff") + F.col("suits_as_defendant") + F.col("judgments_against")
                  + F.col("liens_as_debtor") + F.col("liens_as_creditor") > 0, 100.0),
        ],
        ("gold", "suit_best_view"): [
            unique("suit_id", **_KEY), not_null("primary_plaintiff", 95.0, severity=WARN, **_TEXT),
            not_null("state_code", 100.0, **_TEXT), in_range("days_open", 0, threshold=99.0),
            holds("has_party", F.col("plaintiff_count") + F.col("defendant_count") > 0, 99.0, severity=WARN),
        ],
    }
