"""The send path: order requests in, event messages and rejects out."""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.events import dead_letters, enrich_order_event, parse_events, valid_events, validate_order_event
from ..schemas import EVENT_TEXT
from ..sources.batch_folders import DAY, BatchFolders, query_of
from ..sources.event_streams import event_messages, write_messages

_TEXT = StructField("value", StringType(), True)


def send_orders(requests: DataFrame, sent_at: dt.datetime | str | None = None,
                value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages of the valid order requests, enriched as sending does, and the rejected ones with a reason.

    ``requests`` holds a JSON text in ``value``. It may be a stream; write the messages with
    ``write_events`` or any sink, the rejects to a dead-letter output.
    """
    validated = validate_order_event(parse_events(requests, value), value)
    accepted = valid_events(validated).select(*EVENT_TEXT.names)
    return event_messages(enrich_order_event(accepted, sent_at)), dead_letters(validated, value)


class FileOutbox:
    """Messages and rejected requests as files, a folder per batch; stands in for a topic and its dead-letter topic."""

    def __init__(self, spark: SparkSession, path: str):
        self.messages = BatchFolders(spark, f"{path}/messages", StructType([_TEXT]), [], "text")
        self.rejects = rejects_table(spark, path)

    def __call__(self, messages: DataFrame, query: str, number: int) -> None:
        self.messages.write(messages.withColumn(DAY.name, F.current_date()), query, number)


def rejects_table(spark: SparkSession, path: str) -> BatchFolders:
    """The rejected requests, with the reason of each."""
    return BatchFolders(spark, f"{path}/rejects", StructType([_TEXT, StructField("reject_reason", StringType(), True)]), [])


def kafka_outbox(servers: str, topic: str) -> Callable[[DataFrame, str, int], None]:
    """Sends the messages of a batch to a topic. A batch taken again sends again; receivers go by event id."""
    return lambda messages, query, number: write_messages(messages, servers, topic)


def send_order_stream(requests: DataFrame, send: Callable[[DataFrame, str, int], None], rejects: BatchFolders, checkpoint: str,
                      sent_at: dt.datetime | str | None = None, value: str = "value", name: str | None = None,
                      once: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """Send a stream of order requests: valid ones as messages, the others to ``rejects``.

    ``send`` gets the messages of a micro-batch, the query's id and the number of the batch. Rejects
    are written first, in place of the same batch's; a batch that fails is taken again.
    """
    def take(batch: DataFrame, number: int) -> None:
        query = query_of(batch)
        messages, rejected = send_orders(batch, sent_at, value)
        rejects.write(rejected.withColumnRenamed(value, _TEXT.name).withColumn(DAY.name, F.current_date()), query, number)
        send(messages, query, number)

    writer = requests.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()
