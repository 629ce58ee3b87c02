"""The control table: high-water marks and table pointers by key."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ..functions import as_timestamp

CONTROL = StructType([
    StructField("value", StringType(), True),
    StructField("set_at", TimestampNTZType(), False),
])

CRM_MARK = "crm_last_loaded_at"


def is_missing_path(error: AnalysisException) -> bool:
    """Whether an analysis failed because nothing lies at a path; any other failure must be raised."""
    return error.getCondition() == "PATH_NOT_FOUND"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` can be listed as a data folder or file."""
    try:
        spark.read.format("binaryFile").load(path).schema
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return False
    return True


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and host of its file system."""
    files, place = _file_system(spark, path)
    return files.makeQualified(place).toString().rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the lake, if it is there, by the file system it lies in."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; both lie in one file system."""
    files, place = _file_system(spark, path)
    files.mkdirs(place.getParent())
    files.delete(place, True)
    if not files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new), place):
        raise OSError(f"{new} could not be moved to {path}")


def names_below(spark: SparkSession, folder: str, pattern: str = "*", depth: int = 1) -> list[str]:
    """The last ``depth`` parts of the paths below ``folder`` that match ``pattern``, which has as many parts.

    Only folders of few entries are to be looked at this way: the names come to the driver.
    """
    files, place = _file_system(spark, f"{folder}/{pattern}")
    found = files.globStatus(place) or []
    return sorted("/".join(str(f.getPath()).split("/")[-depth:]) for f in found)


class ControlTable:
    """Small key/value state in a lake folder; the last value set for a key counts.

    Each ``set`` adds one row in its own file. A crash leaves either the old
    state or the new one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, key: str) -> str:
        return f"{self.path}/key={key}"

    def get(self, key: str, default: str | None = None) -> str | None:
        try:
            values = self.spark.read.schema(CONTROL).parquet(self._folder(key))
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return default
        newest = values.orderBy(F.col("set_at").desc()).first()
        return newest["value"] if newest else default

    def set(self, key: str, value: str, set_at: dt.datetime | None = None) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(value).alias("value"), as_timestamp(set_at).alias("set_at")
        )
        row.write.mode("append").parquet(self._folder(key))


    def replace(self, key: str, value: str, keep: int = 5) -> None:
        """As ``set``, for values that change all the time: of the older ones only the last few files stay."""
        self.set(key, value)
        folder = self._folder(key)
        files, place = _file_system(self.spark, folder)
        found = sorted((f for f in files.listStatus(place) if f.getPath().getName().startswith("part-")), key=lambda f: f.getModificationTime())
        for old in found[:-keep]:
            files.delete(old.getPath(), False)


def get_watermark(control: ControlTable, source: str = CRM_MARK) -> str | None:
    """The stored mark as ISO text; None when there is none yet."""
    return control.get(source)


def set_watermark(control: ControlTable, mark: str | None, source: str = CRM_MARK) -> None:
    """Store ``mark``; None leaves the stored one."""
    if mark is not None:
        control.set(source, mark)
