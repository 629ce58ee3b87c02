"""Order events: parse, validate, enrich, route, and map to raw orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import as_timestamp, iso_text, or_default, order_key, whole_number
from ..schemas import CORRUPT_COLUMN, EVENT_TEXT, EVENT_TEXT_WITH_CORRUPT, MONEY, RAW_ERP_ORDERS

# Event types and the route of each; anything else goes to "events".
ROUTES = {"order_event": "order", "crm_data": "crm", "erp_data": "erp"}
OTHER_ROUTE = "events"
DEAD_LETTER_ROUTE = "dead_letter"
ORDER_EVENT = "order_event"

# Fields an order event must have.
REQUIRED_FIELDS = ("customer_id", "product_id", "quantity", "price")

# Status of an order that has none, at sending and at loading.
SENT_STATUS = "pending"
LOADED_STATUS = "completed"


def parse_events(raw: DataFrame, value: str = "value", fields: list[str] | None = None) -> DataFrame:
    """Add ``event``: the known fields of the JSON text in ``value``, as text.

    ``event`` holds the whole text under ``_corrupt_record`` when it is no JSON
    object. It comes out of a one-element ``explode``: filters on it then stay
    above the parsing, which otherwise would be repeated for every field they use.
    ``fields`` limits what is taken out of the text.
    """
    text = F.col(value).cast("string")
    wanted = [*(fields or EVENT_TEXT.names), CORRUPT_COLUMN]
    event = F.from_json(
        text, StructType([f for f in EVENT_TEXT_WITH_CORRUPT.fields if f.name in wanted]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
    return raw.withColumn(value, text).select("*", F.explode_outer(F.array(event)).alias("event"))


def is_readable(value: str = "value") -> Column:
    """Whether a parsed row is a JSON object."""
    return F.col(value).isNotNull() & F.col(f"event.{CORRUPT_COLUMN}").isNull() & F.col("event").isNotNull()


def validate_order_event(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Typed order fields plus ``reject_reason``, null for a valid event.

    Required: customer_id, product_id, quantity, price. A number given as text is
    accepted when it has the right type, and so is a product number.
    """
    text = {name: F.col(f"event.{name}") for name in EVENT_TEXT.names}
    typed = {
        **text,
        "order_id": whole_number(text["order_id"]),
        "customer_id": whole_number(text["customer_id"]),
        "quantity": whole_number(text["quantity"]),
        "price": text["price"].try_cast("double"),
    }
    values = parsed.select(
        *[c for c in parsed.columns if c != "event"],
        *[typed[name].alias(name) for name in EVENT_TEXT.names],
        is_readable(value).alias("_readable"),
        text["order_id"].isNotNull().alias("_numbered"),
    )
    reason = F.when(~F.col("_readable"), "not a JSON object")
    for name in REQUIRED_FIELDS:
        reason = reason.when(F.col(name).isNull(), name)
    reason = reason.when(F.col("_numbered") & F.col("order_id").isNull(), "order_id")
    return values.withColumn("reject_reason", reason).drop("_readable", "_numbered")


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def dead_letters(validated: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The rejected texts with the first reason found, and the columns to ``keep``."""
    rejected = validated.filter(F.col("reject_reason").isNotNull())
    return rejected.select(*(keep or []), value, "reject_reason")


def enrich_order_event(orders: DataFrame, sent_at: dt.datetime | str | None = None) -> DataFrame:
    """Add what sending adds: send time, event type, order date and status if missing."""
    moment = iso_text(as_timestamp(sent_at))
    return (
        orders.withColumn("timestamp", moment)
        .withColumn("event_type", F.lit(ORDER_EVENT))
        .withColumn("order_date", or_default(F.nullif(F.col("order_date"), F.lit("")), moment))
        .withColumn("status", or_default(F.col("status"), SENT_STATUS))
    )


def event_json(events: DataFrame, columns: list[str] | None = None) -> Column:
    """The row as JSON text, nulls included."""
    names = columns or events.columns
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def route_of(event_type: Column) -> Column:
    route = F.lit(OTHER_ROUTE)
    for name, target in ROUTES.items():
        route = F.when(event_type == name, F.lit(target)).otherwise(route)
    return route


def route_events(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Add ``route``; texts that are no JSON object get the dead-letter route."""
    route = F.when(is_readable(value), route_of(F.col("event.event_type")))
    return parsed.withColumn("route", F.coalesce(route, F.lit(DEAD_LETTER_ROUTE)))


def map_order_event(events: DataFrame, loaded_at: dt.datetime | str | None = None,
                    order_date_from: str = "timestamp") -> DataFrame:
    """Landed order events as raw orders, plus ``load_error`` and ``rejected_row``.

    ``load_error`` names the first value that is there but does not fit its
    column, ``rejected_row`` is then the event's text; such rows are kept apart
    instead of stopping the load. The total is multiplied in double precision and
    then rounded to cents.
    """
    columns = {f.name: f.dataType for f in RAW_ERP_ORDERS.fields}
    known = [F.col(f.name) for f in EVENT_TEXT.fields]
    price = F.col("price").try_cast("double")
    quantity = whole_number(F.col("quantity"))
    customer = whole_number(F.col("customer_id"))
    unit_price = price.try_cast(MONEY)
    total = (quantity.cast("double") * price).try_cast(MONEY)
    ordered = F.col(order_date_from).try_cast("timestamp_ntz")
    error = (
        F.when(F.col("customer_id").isNotNull() & customer.isNull(), "customer_id")
        .when(F.col("quantity").isNotNull() & quantity.isNull(), "quantity")
        .when(F.col("price").isNotNull() & unit_price.isNull(), "price")
        .when(quantity.isNotNull() & price.isNotNull() & total.isNull(), "total_amount")
        .when(F.col(order_date_from).isNotNull() & ordered.isNull(), order_date_from)
    )
    text = F.to_json(F.struct(*known))
    if CORRUPT_COLUMN in events.columns:
        corrupt = F.col(CORRUPT_COLUMN)
        error = F.when(corrupt.isNotNull(), "not a JSON object").otherwise(error)
        text = F.coalesce(corrupt, text)
    values = {
        "order_id": order_key(F.col("event_id"), F.col("order_id"), known),
        "customer_id": customer,
        "product_id": F.col("product_id"),
        "quantity": quantity,
        "unit_price": unit_price,
        "total_amount": total,
        "status": or_default(F.col("status"), LOADED_STATUS),
        "order_date": ordered,
        "extracted_at": as_timestamp(loaded_at),
    }
    return events.select(
        *[values[name].cast(kind).alias(name) for name, kind in columns.items()],
        error.alias("load_error"),
        F.when(error.isNotNull(), text).alias("rejected_row"),
    )


def loadable(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("load_error").isNull()).drop("load_error", "rejected_row")


def quarantined(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.col("load_error").isNotNull())


def recent_events(events: DataFrame, limit: int = 10, capacity: int = 100,
                  order_by: tuple[str, ...] = ("timestamp", "event_id")) -> DataFrame:
    """The newest ``limit`` of the last ``capacity`` events, oldest first.

    ``limit`` of zero or less gives all ``capacity``. Each task keeps its own
    newest rows only; nothing is sorted as a whole.
    """
    count = min(limit, capacity) if limit > 0 else capacity
    newest = events.orderBy(*[F.col(c).desc_nulls_last() for c in order_by]).limit(count)
    return newest.orderBy(*[F.col(c).asc_nulls_first() for c in order_by])


def recent_total(events: DataFrame, capacity: int = 100) -> DataFrame:
    """How many events the tail holds: all of them, up to ``capacity``."""
    return events.limit(capacity).agg(F.count("*").alias("total"))
