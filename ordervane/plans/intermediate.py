"""Intermediate: usable customers and orders, and the per-customer metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import with_values

CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "email", "city", "customer_segment", "registration_date",
)
ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "total_amount", "order_category")


def int_customer_cleaned(stg: DataFrame) -> DataFrame:
    """Customers with id, name and email. A blank name counts as a name here."""
    usable = with_values(stg, "customer_id", "customer_name", "email")
    return usable.select(*CUSTOMER_COLUMNS)


def int_order_cleaned(stg: DataFrame) -> DataFrame:
    """Orders with id, customer and a total of zero or more (a null total is dropped)."""
    usable = with_values(stg, "order_id", "customer_id").filter(F.col("total_amount") >= 0)
    return usable.select(*ORDER_COLUMNS)


def int_customer_metrics(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per customer of ``dim`` with order count, revenue, mean and last order.

    Orders are summed up per customer before the join. Only partial sums are
    shuffled, so a customer holding a large share of all orders costs no more
    than any other, and the join sees at most one order row per customer.
    Customers appearing several times in ``dim`` multiply their orders, as a
    plain join would.
    """
    orders = fact.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"),
        F.count("total_amount").alias("amounts"),
        F.sum("total_amount").cast("decimal(22,2)").alias("revenue"),
        F.max("order_date").alias("last_order_date"),
    )
    customers = dim.groupBy("customer_id").agg(F.count("*").alias("copies"))
    # decimal(14,0) keeps 12 digits after the point within decimal(38)
    mean = F.col("revenue") / F.col("amounts").cast("decimal(14,0)")
    return customers.join(orders, "customer_id", "left").select(
        "customer_id",
        F.coalesce(F.col("orders") * F.col("copies"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("revenue") * F.col("copies"), F.lit(0))
        .cast("decimal(22,2)").alias("total_revenue"),
        F.coalesce(mean, F.lit(0)).cast("decimal(28,12)").alias("avg_order_value"),
        "last_order_date",
    )
