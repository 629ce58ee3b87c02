"""The sample star schema in the shape of the CRM and ERP sources.

The sample tables lack e-mails, product keys and faulty rows; those are derived
from the keys by fixed rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import iso_text

AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 31)
LOADED_AT = dt.datetime(2001, 8, 2)

# Event types of the sample stream and what they stand for here.
EVENT_TYPES = {"purchase": "order_event", "signup": "crm_data", "view": "erp_data"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _stamp(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _age_in_days() -> Column:
    return (F.col("c_custkey") % 3650).cast("int")


def crm_customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("customer_id"),
        F.when(key % 23 != 0, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" "))).alias("customer_name"),
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 13 == 0, F.lit("no-at-sign"))
        .otherwise(F.concat(F.lit(" User"), key.cast("string"), F.lit("@Example.COM ")))
        .alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("c_mktsegment").alias("city"),
        F.lit("Active").alias("status"),
        F.date_sub(F.lit(AS_OF), _age_in_days()).alias("registration_date"),
        _stamp(LOADED_AT).alias("extracted_at"),
    )


def erp_orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")

    def money(modulus: int) -> Column:
        return ((cents % modulus).cast("int") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")

    return table(spark, folder, "orders").select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(key % 19 != 0, (key % 200).cast("string")).alias("product_id"),
        (key % 7).cast("int").alias("quantity"),
        money(10_000).alias("unit_price"),
        money(100_000).alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("order_date"),
        _stamp(LOADED_AT).alias("extracted_at"),
    )


def crm_source(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the operational database holds them, with creation times."""
    key = F.col("c_custkey")
    created = _stamp(dt.datetime(2024, 1, 31, 12)) - F.make_dt_interval((key % 60).cast("int"))
    return table(spark, folder, "customer").select(
        key.cast("int").alias("id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("c_mktsegment").alias("city"),
        F.when(key % 11 == 0, F.lit("passive")).otherwise(F.lit("active")).alias("status"),
        F.date_sub(F.lit(EVENTS_AS_OF), _age_in_days()).alias("registration_date"),
        created.cast("timestamp_ntz").alias("created_at"),
    )


def order_events(events: DataFrame) -> DataFrame:
    """The sample events in the shape of order events; works on batches and streams."""
    kind = F.col("event_type")
    mapped = kind
    for name, meaning in EVENT_TYPES.items():
        mapped = F.when(kind == name, F.lit(meaning)).otherwise(mapped)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        iso_text(F.col("ts")).alias("timestamp"),
        mapped.alias("event_type"),
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The sample events as a file stream.

    The braces make the path a pattern, which may match one file or a folder.
    """
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{{events.parquet}}")


def faulty_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON text, six in ten of them faulty in one of six ways."""
    events = table(spark, folder, "events")
    fields = ["event_id", "customer_id", "product_id", "quantity", "price", "timestamp", "event_type"]
    orders = order_events(events)

    def text(**changes) -> Column:
        cells = [changes.get(f, F.col(f)) for f in fields]
        return F.to_json(F.struct(*[
            c.alias(f) for f, c in zip(fields, cells) if c is not None
        ]))

    fault = F.col("event_id").cast("bigint") % 10
    value = (
        F.when(fault == 1, text(customer_id=None))
        .when(fault == 2, text(quantity=F.lit("x")))
        .when(fault == 3, text(quantity=F.lit(2.7)))
        .when(fault == 4, F.expr("left(to_json(struct(event_id, customer_id, product_id)), 30)"))
        .when(fault == 5, F.lit(None).cast("string"))
        .when(fault == 6, text(product_id=F.col("product_id").cast("int")))
        .when(fault == 7, text(product_id=None))
        .otherwise(text())
    )
    return orders.select(F.col("event_id").cast("bigint").alias("message_id"), value.alias("value"))


def crm_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sales, some without quantity or discount."""
    lines = table(spark, folder, "lineitem")
    money = "decimal(10,2)"
    return lines.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("l_extendedprice").cast(money).alias("unit_price"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount").cast(money)).alias("discount_amount"),
    )


def erp_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as stock, with the quantity of their order lines reserved."""
    reserved = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").cast("int").alias("quantity_reserved")
    )
    parts = table(spark, folder, "part")
    return parts.join(reserved, parts.p_partkey == reserved.l_partkey, "left").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("warehouse_id"),
        (F.col("p_size") * 100).alias("quantity_on_hand"),
        "quantity_reserved",
    )
