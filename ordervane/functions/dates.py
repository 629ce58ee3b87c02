"""Dates and timestamps. Every 'now' is a parameter, so runs can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO text with microseconds.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def as_date(as_of: dt.date | str | Column | None) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    day = as_of if as_of is not None else utc_now().date()
    return F.lit(str(day)[:10]).cast("date")


def as_timestamp(moment: dt.datetime | str | Column | None) -> Column:
    """A zone-free timestamp; zoned datetimes are turned to UTC first."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    moment = moment if moment is not None else utc_now()
    if isinstance(moment, dt.datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def days_since(day: Column, as_of: dt.date | str | Column | None) -> Column:
    return F.datediff(as_date(as_of), day.cast("date"))


def iso_text(moment: Column) -> Column:
    """A zone-free timestamp as ISO text with six decimals, whatever the session's zone."""
    text = F.translate(moment.cast("timestamp_ntz").cast("string"), " ", "T")
    point = F.when(text.contains("."), F.lit("")).otherwise(F.lit("."))
    return F.rpad(F.concat(text, point), 26, "0")


def order_calendar(moment: Column) -> dict[str, Column]:
    return {
        "order_year": F.year(moment),
        "order_month": F.month(moment),
        "order_quarter": F.quarter(moment),
        "order_year_month": F.date_format(moment.cast("date"), "yyyy-MM"),
    }
