"""Lake files: dated snapshots, landed events, listings."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import utc_now
from ..functions.dates import ISO_PATTERN
from ..operators.events import DEAD_LETTER_ROUTE, recent_events, recent_total
from .batch_folders import BatchFolders
from .listing import SCHEMA, LakeListing, can_list
from .state import delete_folder, is_missing_path, replace_folder

# A landed event is a line of JSON text.
LANDED_TEXT = StructType([StructField("value", StringType(), True)])

# Spans of days looked through for the newest events.
RECENT_DAYS = (1, 7, 31)

# Written timestamps keep their microseconds. Reading sets no pattern and takes
# any ISO form, with or without fraction.
WRITE_FORMATS = {
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": ISO_PATTERN,
    "timestampNTZFormat": ISO_PATTERN,
}


def snapshot_path(lake: str, kind: str, ds: str) -> str:
    return f"{lake.rstrip('/')}/raw/{kind}/ds={ds}"


def landed_events(spark: SparkSession, lake: str) -> BatchFolders:
    """The table of landed events, with folders per route, day and batch."""
    return BatchFolders(spark, f"{lake.rstrip('/')}/raw/landed", LANDED_TEXT, ["route"], "text")


def write_lake_snapshot(df: DataFrame, lake: str, kind: str, ds: str) -> str:
    """Replace the snapshot of that kind and day by ``df``, as JSON Lines with named fields."""
    path = snapshot_path(lake, kind, ds)
    df.write.mode("overwrite").options(ignoreNullFields="false", **WRITE_FORMATS).json(path)
    return path


def replace_lake_snapshot(df: DataFrame, lake: str, kind: str, ds: str, wanted: Callable[[], bool]) -> bool:
    """Write a snapshot aside, and put it in the place of the day's if ``wanted`` says so once it is written."""
    spark, aside = df.sparkSession, f"{lake.rstrip('/')}/_writing/{uuid.uuid4().hex}"
    written = write_lake_snapshot(df, aside, kind, ds)
    keep = wanted()
    if keep:
        replace_folder(spark, written, snapshot_path(lake, kind, ds))
    delete_folder(spark, aside)
    return keep


def _read_json(spark: SparkSession, path: str, schema: StructType, documents: bool,
               recursive: bool = False) -> DataFrame:
    reader = spark.read.schema(schema)
    if documents:
        reader = reader.option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.json(path)


def read_lake_snapshot(spark: SparkSession, lake: str, kind: str, ds: str, schema: StructType,
                       documents: bool = False) -> DataFrame:
    """One day's snapshot. ``documents`` is for files holding one indented JSON
    value each, an object or an array of objects."""
    return _read_json(spark, snapshot_path(lake, kind, ds), schema, documents)


def read_lake_prefix(spark: SparkSession, prefix: str, schema: StructType,
                     documents: bool = False) -> DataFrame:
    """Every JSON file below ``prefix``."""
    return _read_json(spark, prefix, schema, documents, recursive=True)


def read_lake_object(spark: SparkSession, path: str, schema: StructType,
                     documents: bool = True) -> DataFrame:
    """The JSON file at ``path``, as rows: one JSON value, or with ``documents=False`` one per line."""
    return _read_json(spark, path, schema, documents)


def read_landed(spark: SparkSession, lake: str, schema: StructType, route: str | None = None,
                since: dt.date | None = None, with_dead_letters: bool = False) -> DataFrame:
    """Landed events with ``route`` and ``landed_on``; unreadable messages only if asked for.

    ``route`` and ``since`` limit the folders that are read, ``route`` also those that are listed.
    """
    events = landed_events(spark, lake)
    if route:
        return events.read(schema, "json", since, route=route)
    rows = events.read(schema, "json", since)
    return rows if with_dead_letters else rows.filter(F.col("route") != DEAD_LETTER_ROUTE)


def merge_landed_days(spark: SparkSession, lake: str, before: dt.date) -> int:
    """Merge the landed files of all days before this one; see ``BatchFolders``."""
    return landed_events(spark, lake).merge_days(before)


def recent_landed(spark: SparkSession, lake: str, schema: StructType, limit: int = 10,
                  capacity: int = 100, today: dt.date | None = None) -> DataFrame:
    """The newest landed events, oldest first; see ``recent_events``.

    Days are taken in from the newest on until they hold ``capacity`` events, so
    a long history is read only when its last month holds fewer.
    """
    today = today or utc_now().date()
    order = ("landed_on", "timestamp", "event_id")
    for days in RECENT_DAYS:
        rows = read_landed(spark, lake, schema, since=today - dt.timedelta(days=days))
        if recent_total(rows, capacity).first()["total"] == capacity:
            return recent_events(rows, limit, capacity, order)
    return recent_events(read_landed(spark, lake, schema), limit, capacity, order)


def list_lake_objects(spark: SparkSession, lake: str, prefix: str = "raw/",
                      max_items: int | None = 50) -> DataFrame:
    """Name, size and change time of the files below ``prefix``, first names first.

    Executors list the folders, and with ``max_items`` each task keeps its first names only. The
    contents are not read. No prefix there gives no rows. Where only Spark reaches the store, its own
    listing on the driver stands in.
    """
    root = lake.rstrip("/")
    if can_list(root):
        spark.dataSource.register(LakeListing)
        objects = spark.read.format(LakeListing.name()).options(root=root, prefix=prefix).load()
    else:
        objects = _driver_listing(spark, root, prefix)
    return objects.orderBy("name").limit(max_items) if max_items is not None else objects


def _driver_listing(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(f"{root}/{prefix}")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], SCHEMA)
    return files.select(
        F.regexp_replace("path", _leading(root), "").alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def _leading(root: str) -> str:
    """Pattern of ``root`` at the start of a file's full address, whatever its scheme and host."""
    return r"^(\w[\w+.-]*:)?(//[^/]*)?" + re.escape(urlsplit(root).path) + "/"


def object_count(objects: DataFrame) -> DataFrame:
    return objects.agg(F.count("*").alias("object_count"))
