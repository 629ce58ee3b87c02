"""Text cleaning and text checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_upper(text: Column) -> Column:
    return F.upper(F.trim(text))


def clean_lower(text: Column) -> Column:
    return F.lower(F.trim(text))


def has_text(text: Column) -> Column:
    """True when something other than blanks is there; null is False."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def has_at_sign(text: Column) -> Column:
    return F.coalesce(text.contains("@"), F.lit(False))


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def whole_number(text: Column) -> Column:
    """The int a JSON value stands for; null for 2.7, "x" or out of range."""
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))
