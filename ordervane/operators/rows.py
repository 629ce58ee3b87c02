"""Row filters and column fill-ins shared by several layers."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_timestamp
from ..schemas import COLUMN_DEFAULTS, SOURCE_TABLES


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of ``columns`` is null, as filters the scan can take over."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def stamp_loaded_at(df: DataFrame, loaded_at: dt.datetime | str | None = None,
                    column: str = "extracted_at") -> DataFrame:
    return df.withColumn(column, as_timestamp(loaded_at))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``{old: new}``; the other columns stay."""
    return df.withColumnsRenamed(names)


def fill_defaults(df: DataFrame, table: str, now: dt.datetime | str | None = None,
                  fill_nulls: bool = False) -> DataFrame:
    """Add the columns that ``df`` leaves out, with the source table's defaults.

    As on insertion, a null that is there stays; ``fill_nulls`` replaces it too.
    """
    schema = SOURCE_TABLES[table]
    moment = as_timestamp(now)
    for name, default in COLUMN_DEFAULTS[table].items():
        kind = schema[name].dataType
        if default == "now":
            value = moment
        elif default == "today":
            value = moment.cast("date")
        else:
            value = F.lit(default)
        value = value.cast(kind)
        if name in df.columns:
            given = F.col(name).cast(kind)
            value = F.coalesce(given, value) if fill_nulls else given
        df = df.withColumn(name, value)
    return df


def add_quantity_available(inventory: DataFrame) -> DataFrame:
    """The generated inventory column: on hand minus reserved."""
    return inventory.withColumn(
        "quantity_available", F.col("quantity_on_hand") - F.col("quantity_reserved")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)
