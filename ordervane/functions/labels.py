"""Customer segments and order size classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and class bounds.
SEGMENT_NEW = "Yeni Müşteri"
SEGMENT_ACTIVE = "Aktif Müşteri"
SEGMENT_OLD = "Eski Müşteri"
NEW_BELOW_DAYS = 30
ACTIVE_BELOW_DAYS = 365

ORDER_SMALL = "Küçük Sipariş"
ORDER_MEDIUM = "Orta Sipariş"
ORDER_LARGE = "Büyük Sipariş"
SMALL_BELOW = 100
MEDIUM_BELOW = 500


def _banded(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper bound above ``value``; null gets ``otherwise``."""
    label = F.lit(otherwise)
    for bound, name in reversed(bands):
        label = F.when(value < bound, F.lit(name)).otherwise(label)
    return label


def customer_segment(days: Column, new_below: int = NEW_BELOW_DAYS,
                     active_below: int = ACTIVE_BELOW_DAYS) -> Column:
    return _banded(days, [(new_below, SEGMENT_NEW), (active_below, SEGMENT_ACTIVE)], SEGMENT_OLD)


def order_category(total: Column, small_below: float = SMALL_BELOW,
                   medium_below: float = MEDIUM_BELOW) -> Column:
    return _banded(total, [(small_below, ORDER_SMALL), (medium_below, ORDER_MEDIUM)], ORDER_LARGE)
