"""Incremental extract by high-water mark, with overlap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import utc_now

# Look-back without a usable mark, overlap, and the status taken.
DEFAULT_LOOKBACK_DAYS = 30
OVERLAP_DAYS = 1
EXTRACT_STATUS = "active"


def extract_start(mark: dt.datetime | str | None, now: dt.datetime | None = None,
                  overlap_days: int = OVERLAP_DAYS,
                  lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> dt.datetime:
    """Rows created after this moment belong to the next extract.

    No mark yet counts as a mark ``lookback_days`` ago, so the overlap comes on
    top. An unreadable mark gives ``lookback_days`` ago, without overlap.
    """
    now = now or utc_now()
    fallback = now - dt.timedelta(days=lookback_days)
    overlap = dt.timedelta(days=overlap_days)
    if mark is None:
        return (fallback - overlap).replace(microsecond=0)
    if isinstance(mark, str):
        try:
            mark = dt.datetime.fromisoformat(mark)
        except ValueError:
            return fallback.replace(microsecond=0)
    if mark.tzinfo is not None:
        mark = mark.astimezone(dt.timezone.utc).replace(tzinfo=None)
    # the start has whole seconds, so a row is rather read twice than missed
    return (mark - overlap).replace(microsecond=0)


def incremental_extract(source: DataFrame, mark: dt.datetime | str | None,
                        now: dt.datetime | None = None, status: str = EXTRACT_STATUS,
                        created: str = "created_at", status_column: str = "status",
                        ordered_by: str | None = None) -> DataFrame:
    """Rows with ``status`` created strictly after the mark less the overlap.

    Both conditions are comparisons with literals of the column's own type, so
    databases and Parquet files evaluate them at the scan. ``ordered_by`` sorts
    the result for readers that want it; the merge needs no order.
    """
    start = extract_start(mark, now)
    bound = F.lit(start.isoformat(sep=" ")).cast(source.schema[created].dataType)
    rows = source.filter((F.col(status_column) == status) & (F.col(created) > bound))
    return rows.orderBy(ordered_by) if ordered_by else rows


def mark_columns(created: str = "created_at") -> list[Column]:
    """``extract_count`` and the newest non-null ``created`` as ``new_mark``, to aggregate or to observe."""
    return [F.count(F.lit(1)).alias("extract_count"), F.max(created).cast("timestamp_ntz").alias("new_mark")]


def high_water_mark(extract: DataFrame, created: str = "created_at") -> DataFrame:
    """One row with ``mark_columns``."""
    return extract.agg(*mark_columns(created))


def next_mark(count: int, newest: dt.datetime | None, now: dt.datetime | None = None) -> str | None:
    """The mark to store: none for an empty extract, the run time when all
    creation times were null, else the newest one."""
    if count == 0:
        return None
    return (newest or now or utc_now()).isoformat()
