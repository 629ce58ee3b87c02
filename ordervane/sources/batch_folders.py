"""Tables that a stream appends to, with a folder per micro-batch and a merge of closed days.

A batch's rows lie in ``<keys>/day=.../query=.../batch=...``, below the values of the table's
key columns (a landed event's route, say), the day they came, the stream query's id and the number
of the batch. A batch that is retried replaces its own folders, each moved into place as a whole,
so there is no log of files that grows with the stream, and readers of one key value list that
value's folders only.

A stream of 10-second batches leaves thousands of small files a day. ``merge_days`` rewrites the
days before a given one to files of the usual size, in one pass without a shuffle, writes down the last
batch merged of each key value, day and query, and moves a pointer; then it deletes the
batches' folders. Readers take the merged rows up to the pointer, and batches that are not among those
written down. The last batch of every query stays out of a merge, since it may be repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from .state import ControlTable, delete_folder, is_missing_path, names_below

DAY = StructField("landed_on", DateType(), True)
BATCH = [StructField("query", StringType(), True), StructField("batch", LongType(), True)]
_RUN = StructField("run", IntegerType(), True)
_LAST = StructField("last_batch", LongType(), True)


def query_of(batch: DataFrame) -> str:
    """The id of the stream query whose ``foreachBatch`` holds this batch; it outlives restarts."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if found is None:
        raise RuntimeError("the stream's query id is needed to name its batches")
    return found


def read_or_empty(spark: SparkSession, schema: StructType, fmt: str, path: str, base: str, **options: str) -> DataFrame:
    """The files below ``path``; no rows where there is nothing."""
    try:
        return spark.read.format(fmt).schema(schema).options(basePath=base, **options).load(path)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return spark.createDataFrame([], schema)


class BatchFolders:
    """A table at ``path`` with ``columns``, folders per value of ``keys``, and files of type ``fmt``.

    ``combine`` is what a merge does to the rows, which have ``columns``, ``keys`` and the day.
    """

    def __init__(self, spark: SparkSession, path: str, columns: StructType, keys: list[str], fmt: str = "parquet",
                 combine: Callable[[DataFrame], DataFrame] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.columns = columns
        self.keys = keys
        self.fmt = fmt
        self.combine = combine or (lambda rows: rows)
        self.control = ControlTable(spark, f"{self.path}/_control")

    @property
    def batches_path(self) -> str:
        """Where the batches lie; a stream may read new files from here."""
        return f"{self.path}/batches"

    @property
    def _merged_path(self) -> str:
        return f"{self.path}/merged"

    @property
    def _written_down(self) -> str:
        return f"{self.path}/merged_batches"

    def folders(self, *more: StructField) -> list[StructField]:
        return [*[StructField(k, StringType(), True) for k in self.keys], DAY, *more]

    def write(self, rows: DataFrame, query: str, batch: int) -> None:
        """Add a batch of rows with ``keys`` and ``landed_on``, in place of the same batch if it is there."""
        names = [f.name for f in self.folders(*BATCH)]
        (
            rows.withColumns({"query": F.lit(query), "batch": F.lit(batch).cast("bigint")})
            .select(*self.columns.names, *names)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*names).format(self.fmt).save(self.batches_path)
        )

    def _run(self) -> int:
        return int(self.control.get("run", "0"))

    def _last(self, run: int) -> DataFrame:
        """The last batch merged, by key value, day and query."""
        schema = StructType([*self.folders(BATCH[0], _LAST), _RUN])
        found = read_or_empty(self.spark, schema, "parquet", self._written_down, self._written_down)
        return (found.filter(F.col("run") <= run).groupBy(*self.keys, DAY.name, "query")
                .agg(F.max("last_batch").alias("last_batch")))

    def _unmerged(self, run: int, columns: StructType, fmt: str, below: str = "") -> DataFrame:
        """Rows of batches that are not merged, with the names of their folders."""
        schema = StructType(columns.fields + self.folders(*BATCH))
        rows = read_or_empty(self.spark, schema, fmt, f"{self.batches_path}{below}", self.batches_path)
        if not run:
            return rows
        merged = self._last(run).alias("merged")
        same = F.col("batch") <= F.col("merged.last_batch")
        for name in [*self.keys, DAY.name, "query"]:
            same &= F.col(f"rows.{name}") == F.col(f"merged.{name}")
        return rows.alias("rows").join(merged, same, "left_anti")

    def read(self, columns: StructType | None = None, fmt: str | None = None, since: dt.date | None = None,
             before: tuple[str, int] | None = None, **values: str) -> DataFrame:
        """All rows with ``keys`` and ``landed_on``; ``values`` of the first key and ``since`` limit what is listed and read.

        ``columns`` and ``fmt`` are for files that can be read in another way than they were written (JSON lines as text).
        ``before``, a query and one of its batches, leaves out that batch.
        """
        run = self._run()
        rows = self._unmerged(run, columns or self.columns, fmt or self.fmt, self._below(values))
        if before:
            rows = rows.filter((F.col("query") != before[0]) | (F.col("batch") != before[1]))
        rows = rows.select(*(columns or self.columns).names, *self.keys, DAY.name)
        if run:
            rows = rows.unionByName(self.read_merged(columns, fmt, **values))
        for name, value in values.items():
            rows = rows.filter(F.col(name) == value)
        return rows.filter(F.col(DAY.name) >= F.lit(since)) if since else rows

    def _below(self, values: dict[str, str]) -> str:
        first = self.keys[0] if self.keys else None
        return f"/{first}={values[first]}" if first in values else ""

    def read_merged(self, columns: StructType | None = None, fmt: str | None = None, **values: str) -> DataFrame:
        """The merged rows only."""
        run, columns, below = self._run(), columns or self.columns, self._below(values)
        schema = StructType(columns.fields + [_RUN, *self.folders()])
        rows = read_or_empty(self.spark, schema, fmt or self.fmt, f"{self._merged_path}/run=*{below}", self._merged_path)
        return rows.filter(F.col("run") <= run).select(*columns.names, *self.keys, DAY.name)

    def merge_days(self, before: dt.date) -> int:
        """Merge the batches of all days before this one, and delete their folders; gives the number of folder groups merged.

        Readers that list new batches only (streams) should have read them by then. Merges of
        one table must not run side by side.
        """
        run = self._run()
        rows = self._unmerged(run, self.columns, self.fmt)
        group = [*self.keys, DAY.name, "query"]
        # of a query's few names, not of its rows, which would meet in one task
        batches = rows.select(*group, "batch").distinct()
        newest = batches.groupBy("query").agg(F.max("batch").alias("newest"))
        rows = rows.filter(F.col(DAY.name) < F.lit(before))
        last = (batches.filter(F.col(DAY.name) < F.lit(before)).join(newest, "query").filter(F.col("batch") < F.col("newest"))
                .groupBy(*group).agg(F.max("batch").alias("last_batch")))
        last.coalesce(1).write.mode("overwrite").parquet(f"{self._written_down}/run={run + 1}")
        written = self.spark.read.schema(StructType(self.folders(BATCH[0], _LAST))).parquet(f"{self._written_down}/run={run + 1}")
        groups = written.collect()  # a row per key value, day and query since the last merge
        if groups:
            # batches that have come since are not among those written down
            known = rows.join(written, group).filter(F.col("batch") <= F.col("last_batch"))
            names = [*self.columns.names, *self.keys, DAY.name]
            (
                self.combine(known.select(*names)).select(*names).write.mode("overwrite").partitionBy(*self.keys, DAY.name)
                .format(self.fmt).save(f"{self._merged_path}/run={run + 1}")
            )
            self.control.set("run", str(run + 1))
        self._delete_merged(groups)
        return len(groups)

    def _delete_merged(self, groups: list) -> None:
        for row in groups:
            folder = "/".join([self.batches_path, *[f"{k}={row[k]}" for k in self.keys], f"{DAY.name}={row[DAY.name]}", f"query={row['query']}"])
            for name in names_below(self.spark, folder, "batch=*"):
                if int(name.removeprefix("batch=")) <= row["last_batch"]:
                    delete_folder(self.spark, f"{folder}/{name}")
