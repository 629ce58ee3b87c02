"""Warehouse: the customer dimension, the order fact and their join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import with_values
from .intermediate import CUSTOMER_COLUMNS, ORDER_COLUMNS


def dim_customer(cleaned: DataFrame) -> DataFrame:
    return with_values(cleaned, "customer_id").select(*CUSTOMER_COLUMNS)


def fact_order(cleaned: DataFrame) -> DataFrame:
    return with_values(cleaned, "order_id", "customer_id").select(*ORDER_COLUMNS)


def dim_fact_left_join(dim: DataFrame, fact: DataFrame, key: str = "customer_id") -> DataFrame:
    """Every customer with each of its orders; customers without orders once.

    A left join cannot split its right side, so one customer with very many
    orders would end up in one task. The matches therefore come from an inner
    join, whose skewed partitions adaptive execution does split, and customers
    without orders from an anti join against the distinct order keys.
    """
    columns = [key] + [c for c in dim.columns if c != key] + [c for c in fact.columns if c != key]
    matched = fact.join(dim, key).select(*columns)
    ordering = fact.select(key).distinct()
    without = dim.join(ordering, key, "left_anti")
    for field in fact.schema.fields:
        if field.name != key:
            without = without.withColumn(field.name, F.lit(None).cast(field.dataType))
    return matched.unionByName(without.select(*columns))
