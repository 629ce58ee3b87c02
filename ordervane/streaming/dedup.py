"""Deduplication of a stream by event id."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sources.batch_folders import DAY, BatchFolders, query_of

#: Places of a day's filter; with a quarter as many ids a day, one new id in 400 looks as if it was seen.
FILTER_PLACES = 1 << 24
#: Folders of the ids of a batch or day.
BUCKETS = 16


def dedup_events(stream: DataFrame, keys: list[str] | None = None, salts: int = 16) -> DataFrame:
    """One event per key, however late and in whatever order events come, with all keys in the state store.

    For streams of bounded length: the state grows with the keys. The stream is deduplicated
    twice: first per key and salt, the salt being the reading task modulo ``salts``, then per
    key. An id repeated very often is so thinned out by up to ``salts`` tasks, and at most that
    many copies meet in one. ``salts=0`` leaves out the first step and its state.
    """
    keys = keys or ["event_id"]
    columns = stream.columns
    if salts:
        salted = stream.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        stream = salted.dropDuplicates([*keys, "_salt"]).drop("_salt")
    return stream.dropDuplicates(keys).select(*columns)


class SeenIds:
    """The keys of all events ever taken, as tables by day, with a Bloom filter in front.

    A filter has ``places`` words of 64 bits for each day, of which a key sets four in the word that its hash
    names; words that are 0 are not stored. A new batch's keys meet the words first, two numbers per place and
    day. Only keys whose bits are all set go on to the exact comparison with the stored keys, and of these
    only the days and buckets are read in which a filter has found one. Nothing is kept in memory
    or in a state store, and no key is ever dropped.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, places: int = FILTER_PLACES):
        self.spark = spark
        self.keys = keys or ["event_id"]
        self.places = places
        ids = StructType([StructField("hash", LongType(), True), StructField("id", StringType(), True)])
        words = StructType([StructField("place", LongType(), True), StructField("bits", LongType(), True)])
        self.ids = BatchFolders(spark, f"{path}/ids", ids, ["bucket"])
        self.words = BatchFolders(spark, f"{path}/filter", words, [], combine=lambda rows: _words(rows, DAY.name))

    def _id(self) -> Column:
        """All keys in one text, in which nulls differ from every value."""
        return F.to_json(F.struct(*self.keys), {"ignoreNullFields": "false"})

    def _named(self, rows: DataFrame) -> DataFrame:
        hashed = F.xxhash64("id")
        bits = F.lit(0).cast("bigint")
        for i in range(4):
            turned = F.shiftrightunsigned(F.xxhash64("id", F.lit("bits")), 6 * i)
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), turned.bitwiseAND(F.lit(63)).cast("int")))
        return rows.withColumn("hash", hashed).withColumns({
            "place": F.pmod(F.col("hash"), F.lit(self.places)), "bits": bits,
            "bucket": F.pmod(F.shiftright("hash", 32), F.lit(BUCKETS)).cast("string")})

    def new_rows(self, batch: DataFrame, query: str, number: int) -> DataFrame:
        """A row of each key of the batch that no other batch has brought."""
        once = batch.dropDuplicates(self.keys).withColumn("_seen_id", self._id())
        asked = self._named(once.select(F.col("_seen_id").alias("id")))
        words = self.words.read(before=(query, number)).alias("word")
        hit = (F.col("asked.place") == F.col("word.place")) & (F.col("word.bits").bitwiseAND(F.col("asked.bits")) == F.col("asked.bits"))
        maybe = asked.alias("asked").join(words, hit).select("asked.id", "asked.hash", "asked.bucket", f"word.{DAY.name}")
        known = self.ids.read(before=(query, number)).join(maybe, ["id", "hash", "bucket", DAY.name], "left_semi")
        return once.join(known.select(F.col("id").alias("_seen_id")).distinct(), "_seen_id", "left_anti").select(*batch.columns)

    def add(self, rows: DataFrame, query: str, number: int, day: dt.date) -> None:
        """Store the keys of rows that ``new_rows`` gave for this batch."""
        named = self._named(rows.select(self._id().alias("id")).distinct()).withColumn(DAY.name, F.lit(day))
        self.ids.write(named, query, number)
        self.words.write(_words(named, DAY.name), query, number)

    def merge_days(self, before: dt.date) -> None:
        """Merge the files of all days before this one."""
        self.ids.merge_days(before)
        self.words.merge_days(before)


def _words(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy("place", *names).agg(F.bit_or("bits").alias("bits"))


def write_distinct(stream: DataFrame, seen: SeenIds, write: Callable[[DataFrame, str, int], None], checkpoint: str,
                   name: str | None = None, once: bool = False, trigger: str = "10 seconds",
                   today: Callable[[], dt.date] = lambda: dt.datetime.now(dt.timezone.utc).date()) -> StreamingQuery:
    """One event per key, however late and in whatever order events come, given to ``write`` batch by batch.

    ``write`` gets the rows, the query's id and the number of the batch, and must replace what it wrote
    for that batch before. The keys are stored after the rows are written; a batch that
    fails in between is taken again, and its own keys do not count as seen.
    """
    def take(batch: DataFrame, number: int) -> None:
        query = query_of(batch)
        fresh = seen.new_rows(batch, query, number).persist()
        try:
            write(fresh, query, number)
            seen.add(fresh, query, number, today())
        finally:
            fresh.unpersist()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()
