"""Loading landed order events into the raw orders table as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions import utc_now
from ..operators.events import map_order_event
from ..sources.batch_folders import query_of
from ..sources.tables import KeyedTable


def stream_upsert_orders(orders: DataFrame, table: KeyedTable, checkpoint: str,
                         name: str | None = None, once: bool = False, trigger: str = "10 seconds",
                         order_date_from: str = "timestamp",
                         loaded_at: Callable[[], dt.datetime] = utc_now) -> StreamingQuery:
    """Insert or update ``table`` from a stream of landed order events.

    A micro-batch becomes one load of the table, named after the query and the
    batch. A retried batch replaces its own load, so every event counts once.
    Rows that do not fit are kept in the load as rejected.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        table.load(map_order_event(batch, loaded_at(), order_date_from), f"{query_of(batch)}-{batch_id:012d}")

    writer = orders.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()
