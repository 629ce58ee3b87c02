"""Marts: the five KPIs, as rows of text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amount_text, as_date, percent_text

# Widths of the strict amount masks, and the recency span.
REVENUE_MASK_DIGITS = 9
AVERAGE_MASK_DIGITS = 6
ACTIVE_WITHIN_DAYS = 30


@dataclass(frozen=True)
class Kpi:
    """A KPI row: label, unit, and an aggregate over the customer metrics giving its text."""

    label: str
    unit: str
    text: Callable[[Column, bool], Column]


def _customers(day: Column, strict: bool) -> Column:
    # customer_id is unique in the metrics, so no distinct is needed
    return F.count("customer_id").cast("string")


def _revenue(day: Column, strict: bool) -> Column:
    total = F.sum("total_revenue")
    return F.coalesce(amount_text(total, REVENUE_MASK_DIGITS if strict else None), F.lit("0"))


def _average(day: Column, strict: bool) -> Column:
    # the mean of the customers' own means, over customers who ordered
    mean = F.avg(F.when(F.col("total_orders") > 0, F.col("avg_order_value")))
    return F.coalesce(amount_text(mean, AVERAGE_MASK_DIGITS if strict else None), F.lit("0"))


def _active_rate(day: Column, strict: bool) -> Column:
    recent = F.col("last_order_date") >= F.date_sub(day, ACTIVE_WITHIN_DAYS)
    return percent_text(F.count_if(recent), F.count("*"))


def _orders(day: Column, strict: bool) -> Column:
    return F.coalesce(F.sum("total_orders").cast("string"), F.lit("0"))


# Metric names and units, in report order.
KPIS = {
    "kpi_total_customers": Kpi("Toplam Müşteri Sayısı", "Adet", _customers),
    "kpi_total_revenue": Kpi("Toplam Gelir", "TL", _revenue),
    "kpi_avg_order_value": Kpi("Ortalama Sipariş Değeri", "TL", _average),
    "kpi_active_customer_rate": Kpi("Aktif Müşteri Oranı", "Yüzde", _active_rate),
    "kpi_total_orders": Kpi("Toplam Sipariş Sayısı", "Adet", _orders),
}


def kpi_rows(metrics: DataFrame, names: list[str], as_of=None, strict_mask: bool = False) -> DataFrame:
    """The named KPIs from one aggregation over ``metrics``, stacked into rows."""
    day = as_date(as_of)
    values = metrics.agg(*[KPIS[n].text(day, strict_mask).alias(n) for n in names])
    cells = [
        part
        for n in names
        for part in (F.lit(KPIS[n].label), F.col(n), F.lit(KPIS[n].unit))
    ]
    return values.select(
        F.stack(F.lit(len(names)), *cells).alias("metric_name", "metric_value", "unit")
    ).withColumn("calculation_date", day)


def kpi(metrics: DataFrame, name: str, as_of=None, strict_mask: bool = False) -> DataFrame:
    return kpi_rows(metrics, [name], as_of, strict_mask)


def executive_dashboard(metrics: DataFrame, as_of=None, strict_mask: bool = False) -> DataFrame:
    """All five KPIs; the metrics are read once.

    ``strict_mask`` prints amounts as the fixed-width masks do: ``.00`` for zero,
    ``#`` on overflow.
    """
    return kpi_rows(metrics, list(KPIS), as_of, strict_mask)
