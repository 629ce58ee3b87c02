"""Column expressions: built-in functions only, so they stay inside codegen."""

from .amounts import amount_text, percent_text
from .dates import as_date, as_timestamp, days_since, iso_text, order_calendar, utc_now
from .keys import order_key
from .labels import customer_segment, order_category
from .text import clean_lower, clean_upper, has_at_sign, has_text, or_default, whole_number

__all__ = [
    "amount_text", "as_date", "as_timestamp", "clean_lower", "clean_upper",
    "customer_segment", "days_since", "has_at_sign", "has_text", "iso_text",
    "or_default", "order_calendar", "order_category", "order_key",
    "percent_text", "utc_now", "whole_number",
]
