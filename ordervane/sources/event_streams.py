"""Event streams: Kafka topics, or files standing in for them.

Kafka needs Spark's Kafka package on the class path. Everything after reading is
the same for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..operators.events import event_json

# Topic, consumer group, retries of the sender.
EVENT_TOPIC = "etl_events"
CONSUMER_GROUP = "etl_group"
SEND_RETRIES = 3


def read_event_stream(spark: SparkSession, servers: str, topics: tuple[str, ...] = (EVENT_TOPIC,),
                      starting: str = "earliest", max_per_trigger: int | None = None,
                      group: str = CONSUMER_GROUP) -> DataFrame:
    """Kafka messages with their text in ``value``.

    There is one task per topic partition. ``max_per_trigger`` caps the messages
    of a micro-batch; a backlog needs large batches, so the default has no cap.
    The position is kept in the query's checkpoint.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("groupIdPrefix", group)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    messages = reader.load()
    return messages.select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset"
    )


def read_file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "json",
                     max_files_per_trigger: int | None = None, name_glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream; each file is read once per checkpoint."""
    reader: DataStreamReader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(folder)


def event_messages(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Events as JSON text in ``value``, without key; ``partitions`` spreads them evenly."""
    messages = events.select(event_json(events).alias("value"))
    return messages.repartition(partitions) if partitions else messages


def _kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": str(SEND_RETRIES),
    }


def write_messages(messages: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> None:
    """Send a batch of JSON texts in ``value``."""
    messages.write.format("kafka").options(**_kafka_options(servers, topic)).save()


def write_events(events: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> None:
    """Send a batch of events."""
    write_messages(event_messages(events), servers, topic)


def write_event_stream(events: DataFrame, servers: str, checkpoint: str,
                       topic: str = EVENT_TOPIC) -> StreamingQuery:
    """Send a stream of events."""
    writer: DataStreamWriter = event_messages(events).writeStream.format("kafka")
    return writer.options(**_kafka_options(servers, topic)).option("checkpointLocation", checkpoint).start()
