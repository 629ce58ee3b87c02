"""The view models as SQL text, to be stored in the catalog.

Stored views read the stored raw tables, so they can be selected by ``layer.name`` from any session
that shares the catalog. They say the same as ``staging`` and ``intermediate``, whose DataFrames
a run builds; ``tests`` hold the two against each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from ..functions import labels
from .intermediate import CUSTOMER_COLUMNS, ORDER_COLUMNS

#: From the catalog's name of a model or raw table.
Named = Callable[[str], str]


def _classes(value: str, bands: list[tuple[int, str]], otherwise: str) -> str:
    cases = " ".join(f"WHEN {value} < {bound} THEN '{label}'" for bound, label in bands)
    return f"CASE {cases} ELSE '{otherwise}' END"


def _age(as_of: dt.date) -> str:
    return f"datediff(DATE '{as_of}', registration_date)"


def stg_crm_customers(named: Named, as_of: dt.date) -> str:
    segment = _classes(_age(as_of), [(labels.NEW_BELOW_DAYS, labels.SEGMENT_NEW), (labels.ACTIVE_BELOW_DAYS, labels.SEGMENT_ACTIVE)],
                       labels.SEGMENT_OLD)
    return f"""
SELECT customer_id, upper(trim(customer_name)) AS customer_name, lower(trim(email)) AS email, trim(phone) AS phone,
  upper(trim(city)) AS city, lower(trim(status)) AS status, registration_date, extracted_at,
  ifnull(trim(customer_name) <> '', false) AS has_valid_name, ifnull(contains(email, '@'), false) AS has_valid_email,
  {_age(as_of)} AS days_since_registration, {segment} AS customer_segment
FROM {named("raw.crm_customers")}"""


def stg_erp_orders(named: Named, as_of: dt.date) -> str:
    category = _classes("total_amount", [(labels.SMALL_BELOW, labels.ORDER_SMALL), (labels.MEDIUM_BELOW, labels.ORDER_MEDIUM)],
                        labels.ORDER_LARGE)
    return f"""
SELECT order_id, customer_id, product_id, quantity, unit_price, total_amount, status, order_date, extracted_at,
  quantity > 0 AND unit_price > 0 AS has_valid_amounts, product_id IS NOT NULL AS has_valid_product,
  year(order_date) AS order_year, month(order_date) AS order_month, quarter(order_date) AS order_quarter,
  date_format(CAST(order_date AS DATE), 'yyyy-MM') AS order_year_month, {category} AS order_category
FROM {named("raw.erp_orders")}
WHERE quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL"""


def int_customer_cleaned(named: Named, as_of: dt.date) -> str:
    return f"""
SELECT {", ".join(CUSTOMER_COLUMNS)} FROM {named("stg_crm_customers")}
WHERE customer_id IS NOT NULL AND customer_name IS NOT NULL AND email IS NOT NULL"""


def int_order_cleaned(named: Named, as_of: dt.date) -> str:
    return f"""
SELECT {", ".join(ORDER_COLUMNS)} FROM {named("stg_erp_orders")}
WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount >= 0"""


VIEWS: dict[str, Callable[[Named, dt.date], str]] = {
    view.__name__: view for view in (stg_crm_customers, stg_erp_orders, int_customer_cleaned, int_order_cleaned)
}
