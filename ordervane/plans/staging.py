"""Staging: clean, flag and classify the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    as_date,
    clean_lower,
    clean_upper,
    customer_segment,
    days_since,
    has_at_sign,
    has_text,
    order_calendar,
    order_category,
)
from ..functions.labels import ACTIVE_BELOW_DAYS, MEDIUM_BELOW, NEW_BELOW_DAYS, SMALL_BELOW


def stg_crm_customers(raw: DataFrame, as_of=None, new_below: int = NEW_BELOW_DAYS,
                      active_below: int = ACTIVE_BELOW_DAYS) -> DataFrame:
    """Normalised customers with quality flags, age in days and segment.

    Text is normalised here once; later layers take it as it is.
    """
    age = days_since(F.col("registration_date"), as_date(as_of))
    return raw.select(
        "customer_id",
        clean_upper(F.col("customer_name")).alias("customer_name"),
        clean_lower(F.col("email")).alias("email"),
        F.trim("phone").alias("phone"),
        clean_upper(F.col("city")).alias("city"),
        clean_lower(F.col("status")).alias("status"),
        "registration_date",
        "extracted_at",
        has_text(F.col("customer_name")).alias("has_valid_name"),
        has_at_sign(F.col("email")).alias("has_valid_email"),
        age.alias("days_since_registration"),
        customer_segment(age, new_below, active_below).alias("customer_segment"),
    )


def order_flags() -> dict:
    return {
        "has_valid_amounts": F.coalesce(
            (F.col("quantity") > 0) & (F.col("unit_price") > 0), F.lit(False)
        ),
        "has_valid_product": F.col("product_id").isNotNull(),
    }


def stg_erp_orders(raw: DataFrame, small_below: float = SMALL_BELOW,
                   medium_below: float = MEDIUM_BELOW,
                   with_calculated_total: bool = False) -> DataFrame:
    """Orders with valid amounts and product, plus calendar columns and size class."""
    flags = order_flags()
    extra = []
    if with_calculated_total:
        extra.append(
            (F.col("quantity") * F.col("unit_price")).cast("decimal(20,2)").alias("calculated_total")
        )
    # The two conditions are also filtered directly, so that they reach the scan.
    return (
        raw.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0))
        .filter(flags["has_valid_product"])
        .select(
            "order_id", "customer_id", "product_id", "quantity", "unit_price",
            "total_amount", "status", "order_date", "extracted_at",
            *[column.alias(name) for name, column in flags.items()],
            *[column.alias(name) for name, column in order_calendar(F.col("order_date")).items()],
            order_category(F.col("total_amount"), small_below, medium_below).alias("order_category"),
            *extra,
        )
    )
