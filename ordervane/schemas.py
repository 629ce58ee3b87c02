"""Declared schemas. Nothing in this package infers a schema from data.

Stored timestamps carry no zone (``TimestampNTZType``) and are read as UTC.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(10, 2)


def _struct(*columns: tuple, required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(name, kind, name not in required) for name, kind in columns])


# Columns and types of the raw and source tables.
RAW_CRM_CUSTOMERS = _struct(
    ("customer_id", IntegerType()),
    ("customer_name", StringType()),
    ("email", StringType()),
    ("phone", StringType()),
    ("city", StringType()),
    ("status", StringType()),
    ("registration_date", DateType()),
    ("extracted_at", TimestampNTZType()),
    required=("customer_id",),
)

RAW_ERP_ORDERS = _struct(
    ("order_id", StringType()),
    ("customer_id", IntegerType()),
    ("product_id", StringType()),
    ("quantity", IntegerType()),
    ("unit_price", MONEY),
    ("total_amount", MONEY),
    ("status", StringType()),
    ("order_date", TimestampNTZType()),
    ("extracted_at", TimestampNTZType()),
    required=("order_id",),
)

CRM_EXTRACT = _struct(
    ("customer_id", IntegerType()),
    ("customer_name", StringType()),
    ("email", StringType()),
    ("phone", StringType()),
    ("city", StringType()),
    ("status", StringType()),
    ("registration_date", DateType()),
    ("created_at", TimestampNTZType()),
)

# Event fields are read as text, so that a badly typed value can be told from a
# missing one; the validation and load steps cast them.
EVENT_TEXT = _struct(
    *((name, StringType()) for name in (
        "event_id", "order_id", "customer_id", "product_id", "quantity",
        "price", "order_date", "status", "timestamp", "event_type",
    ))
)

# Columns an event file may lack altogether; unreadable lines go to the last one.
CORRUPT_COLUMN = "_corrupt_record"
EVENT_TEXT_WITH_CORRUPT = StructType(
    EVENT_TEXT.fields + [StructField(CORRUPT_COLUMN, StringType(), True)]
)

# Operational source tables.
CRM_CUSTOMERS = _struct(
    ("customer_id", IntegerType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("email", StringType()),
    ("phone", StringType()),
    ("address", StringType()),
    ("city", StringType()),
    ("state", StringType()),
    ("zip_code", StringType()),
    ("country", StringType()),
    ("registration_date", DateType()),
    ("last_activity_date", DateType()),
    ("customer_status", StringType()),
    ("customer_type", StringType()),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
    required=("customer_id", "first_name", "last_name", "email"),
)

CRM_SALES = _struct(
    ("sale_id", IntegerType()),
    ("customer_id", IntegerType()),
    ("product_id", IntegerType()),
    ("sale_date", DateType()),
    ("quantity", IntegerType()),
    ("unit_price", MONEY),
    ("total_amount", MONEY),
    ("discount_amount", MONEY),
    ("net_amount", MONEY),
    ("sales_rep_id", StringType()),
    ("channel", StringType()),
    ("region", StringType()),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
    required=("sale_id", "product_id", "sale_date", "quantity", "unit_price",
              "total_amount", "net_amount"),
)

ERP_PRODUCTS = _struct(
    ("product_id", IntegerType()),
    ("product_name", StringType()),
    ("product_category", StringType()),
    ("product_subcategory", StringType()),
    ("brand", StringType()),
    ("supplier_id", StringType()),
    ("cost_price", MONEY),
    ("list_price", MONEY),
    ("weight", DecimalType(8, 3)),
    ("dimensions", StringType()),
    ("product_status", StringType()),
    ("created_date", DateType()),
    ("updated_date", DateType()),
    required=("product_id", "product_name", "product_category"),
)

ERP_INVENTORY = _struct(
    ("inventory_id", IntegerType()),
    ("product_id", IntegerType()),
    ("warehouse_id", StringType()),
    ("quantity_on_hand", IntegerType()),
    ("quantity_reserved", IntegerType()),
    ("quantity_available", IntegerType()),
    ("reorder_point", IntegerType()),
    ("max_stock_level", IntegerType()),
    ("last_updated", TimestampNTZType()),
    required=("inventory_id", "warehouse_id"),
)

SOURCE_TABLES = {
    "crm.customers": CRM_CUSTOMERS,
    "crm.sales": CRM_SALES,
    "erp.products": ERP_PRODUCTS,
    "erp.inventory": ERP_INVENTORY,
}

# What an omitted column becomes. "now" and "today" stand for the
# load time and its date.
COLUMN_DEFAULTS = {
    "crm.customers": {
        "customer_status": "Active",
        "customer_type": "Standard",
        "created_at": "now",
        "updated_at": "now",
    },
    "crm.sales": {
        "quantity": 1,
        "discount_amount": 0,
        "created_at": "now",
        "updated_at": "now",
    },
    "erp.products": {
        "product_status": "Active",
        "created_date": "today",
        "updated_date": "today",
    },
    "erp.inventory": {
        "quantity_on_hand": 0,
        "quantity_reserved": 0,
        "reorder_point": 0,
        "max_stock_level": 0,
        "last_updated": "now",
    },
}

KPI_ROWS = _struct(
    ("metric_name", StringType()),
    ("metric_value", StringType()),
    ("unit", StringType()),
    ("calculation_date", DateType()),
)

DQ_REPORT = _struct(
    ("test_name", StringType()),
    ("dataset", StringType()),
    ("column_name", StringType()),
    ("test_type", StringType()),
    ("failures", LongType()),
    ("status", StringType()),
)
