"""The hand-made customers and orders, one per branch of the models."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ordervane.plans import intermediate, staging, warehouse
from ordervane.schemas import RAW_CRM_CUSTOMERS, RAW_ERP_ORDERS
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

AS_OF = dt.date(2024, 3, 1)
LOADED = dt.datetime(2024, 3, 1, 6)


def frame(spark, rows, schema):
    """A DataFrame from Python rows by Arrow, without Python workers."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.table(columns, schema=arrow), schema)


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def customers(spark):
    day = dt.date
    cells = [
        (1, "  ada lovelace ", " Ada@Example.COM ", " Active", day(2024, 2, 10)),
        (2, "bob", "bob@x.io", "active", day(2024, 1, 31)),
        (3, "   ", "blank@x.io", "active", day(2023, 3, 3)),
        (4, None, "noname@x.io", "active", day(2023, 3, 2)),
        (5, "eve", None, "active", day(2022, 1, 1)),
        (6, "fay", "not-an-email", "passive", None),
        (7, "gus", "gus@x.io", "active", day(2024, 3, 15)),
    ]
    rows = [(i, n, e, " 555 ", " Ankara ", s, d, LOADED) for i, n, e, s, d in cells]
    return frame(spark, rows, nullable(RAW_CRM_CUSTOMERS))


def orders(spark):
    cells = [
        ("o1", 1, "p1", 2, "50.00", "99.99", "2024-02-15 10:00:00"),
        ("o2", 1, "p2", 1, "100.00", "100.00", "2024-02-20 00:00:00"),
        ("o3", 2, "p1", 5, "100.00", "500.00", "2024-01-31 00:00:00"),
        ("o4", 3, "p1", 1, "499.99", "499.99", "2024-01-30 23:59:59"),
        ("o5", 1, None, 1, "10.00", "10.00", "2024-02-01 00:00:00"),
        ("o6", 1, "p1", 0, "10.00", "0.00", "2024-02-01 00:00:00"),
        ("o7", 2, "p1", 1, "10.00", None, "2024-02-01 00:00:00"),
        ("o8", 99, "p1", 1, "10.00", "10.00", "2024-02-28 00:00:00"),
        ("o9", 4, "p1", 1, "700.00", "700.00", "2024-02-28 00:00:00"),
        ("o10", None, "p1", 1, "20.00", "20.00", "2024-02-28 00:00:00"),
        ("o11", 2, "p1", 1, "5.00", "-5.00", "2024-02-28 00:00:00"),
    ]
    rows = [
        (o, c, p, q, Decimal(u), Decimal(t) if t else None, "paid", dt.datetime.fromisoformat(at), LOADED)
        for o, c, p, q, u, t, at in cells
    ]
    return frame(spark, rows, nullable(RAW_ERP_ORDERS))


def stg_customers(spark):
    return staging.stg_crm_customers(customers(spark), AS_OF)


def stg_orders(spark):
    return staging.stg_erp_orders(orders(spark))


def dim(spark):
    return warehouse.dim_customer(intermediate.int_customer_cleaned(stg_customers(spark)))


def fact(spark):
    return warehouse.fact_order(intermediate.int_order_cleaned(stg_orders(spark)))


def metrics(spark):
    return intermediate.int_customer_metrics(dim(spark), fact(spark))
