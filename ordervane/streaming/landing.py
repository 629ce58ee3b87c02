"""Landing: every event as a JSON line in the folder of its route, and unreadable ones with their origin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.events import DEAD_LETTER_ROUTE, parse_events, route_events
from ..schemas import EVENT_TEXT_WITH_CORRUPT
from ..sources.batch_folders import BATCH, DAY, query_of
from ..sources.lake import landed_events

# What is kept of a message that cannot be read: its text as it came, why it could not be read,
# where it came from, and how often it has been sent again.
DEAD_LETTER = StructType([
    StructField("value", StringType(), True),
    StructField("reason", StringType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("replays", IntegerType(), True),
])


def landing_rows(stream: DataFrame, value: str = "value") -> DataFrame:
    """The event texts with ``route`` and day, each on one line, otherwise unchanged.

    Line breaks in valid JSON lie between tokens only, so blanks may replace them. A text that is
    no JSON object becomes a dead letter: a JSON object of ``DEAD_LETTER``, with topic, partition
    and offset if the stream has them. The day is that of the micro-batch and stays the
    same when it is retried.
    """
    routed = route_events(parse_events(stream, value, ["event_type"]), value)
    known = {"value": F.col(value), "reason": F.when(F.col(value).isNull(), "no text").otherwise("not a JSON object")}
    letter = F.struct(*[
        (known[f.name] if f.name in known else F.col(f.name).cast(f.dataType) if f.name in stream.columns
         else F.lit(0 if f.name == "replays" else None).cast(f.dataType)).alias(f.name)
        for f in DEAD_LETTER.fields
    ])
    text = F.when(F.col("route") == DEAD_LETTER_ROUTE, F.to_json(letter, {"ignoreNullFields": "false"}))
    return routed.select(
        text.otherwise(F.translate(value, "\r\n", "  ")).alias("value"), "route", F.current_date().alias(DAY.name)
    )


def land_events(stream: DataFrame, lake: str, checkpoint: str, name: str | None = None,
                once: bool = False, trigger: str = "10 seconds") -> StreamingQuery:
    """Write the stream of event texts to the landed events of the lake.

    Rows are written where they were read; a route with most of the events is
    spread over all tasks. A failed batch is retried from the checkpoint and replaces
    its own folders. ``once`` takes what is there and ends.
    """
    def land(batch: DataFrame, number: int) -> None:
        landed_events(batch.sparkSession, lake).write(batch, query_of(batch), number)

    writer = landing_rows(stream).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()


def _letters(rows: DataFrame) -> DataFrame:
    return rows.select(F.from_json("value", DEAD_LETTER).alias("letter"), DAY.name).select("letter.*", DAY.name)


def read_dead_letters(spark: SparkSession, lake: str) -> DataFrame:
    """All dead letters with reason and origin, and the day they came."""
    return _letters(landed_events(spark, lake).read(route=DEAD_LETTER_ROUTE))


def _new_files(spark: SparkSession, lake: str, route: str, schema: StructType, fmt: str,
               max_files_per_trigger: int | None) -> DataFrame:
    """The files of one route as they come; only that route's folders are listed."""
    events = landed_events(spark, lake)
    # a stream takes the folder it reads for the base of its partition columns
    reader = spark.readStream.format(fmt).schema(StructType([*schema.fields, DAY, *BATCH]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(f"{events.batches_path}/route={route}").select(*schema.names, DAY.name)


def replay_dead_letters(spark: SparkSession, lake: str, checkpoint: str, repair: Callable[[DataFrame], DataFrame],
                        most_replays: int = 1, name: str | None = None) -> StreamingQuery:
    """Land the dead letters that have come since the last replay once more, after ``repair``.

    ``repair`` gets a stream of dead letters and returns it with ``value`` mended where it can
    be. What is still no JSON object becomes a dead letter again, with its first origin and one
    replay more; with ``most_replays`` it is not taken again. Each letter is replayed
    once for a checkpoint. Ends when all there are have been taken.
    """
    letters = _letters(_new_files(spark, lake, DEAD_LETTER_ROUTE, landed_events(spark, lake).columns, "text", None))
    again = repair(letters.filter(F.col("replays") < most_replays).drop("reason", DAY.name))
    return land_events(again.withColumn("replays", F.col("replays") + 1), lake, checkpoint, name, once=True)


def read_landed_stream(spark: SparkSession, lake: str, route: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Newly landed events of one route, fields as text.

    Days that were merged before the reader's first start are not among them: read those by
    ``read_landed`` once. Days should be merged only after all readers have taken them.
    """
    return _new_files(spark, lake, route, EVENT_TEXT_WITH_CORRUPT, "json", max_files_per_trigger).drop(DAY.name)
