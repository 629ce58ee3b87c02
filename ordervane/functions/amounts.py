"""Amounts and rates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount_text(amount: Column, mask_digits: int | None = None) -> Column:
    """``1234.5`` as ``1,234.50``, halves rounded away from zero.

    With ``mask_digits`` the text follows a fixed-width numeric mask of that many
    integer digits: no zero before the point, ``#`` when the number is too long.
    """
    cents = F.round(amount, 2)
    text = F.format_number(cents, 2)
    if mask_digits is None:
        return text
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    overflow = ",".join(["###"] * (mask_digits // 3)) + ".##"
    return F.when(
        F.abs(cents) >= F.lit(10 ** mask_digits), F.concat(sign, F.lit(overflow))
    ).otherwise(F.regexp_replace(text, r"^(-?)0\.", "$1."))


def percent_text(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; ``0%`` when there is no whole."""
    rate = (part.cast("decimal(20,0)") * 100).cast("decimal(24,0)") / whole
    return F.when(
        whole > 0, F.concat(F.round(rate, 2).cast("decimal(5,2)").cast("string"), F.lit("%"))
    ).otherwise(F.lit("0%"))
