"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

# The sample tables in source shape; the rules of sources/sample_tables.py in SQL.
CUSTOMERS = """
crm AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 23 <> 0 THEN concat('  ', lower(c_name), ' ') END AS customer_name,
    CASE WHEN c_custkey % 17 = 0 THEN NULL
         WHEN c_custkey % 13 = 0 THEN 'no-at-sign'
         ELSE concat(' User', CAST(c_custkey AS VARCHAR), '@Example.COM ') END AS email,
    CAST(NULL AS VARCHAR) AS phone, c_mktsegment AS city, 'Active' AS status,
    DATE '2001-08-02' - CAST(c_custkey % 3650 AS INTEGER) AS registration_date,
    TIMESTAMP '2001-08-02 00:00:00' AS extracted_at
  FROM customer
)"""

ORDERS = """
erp AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
    CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 200 AS VARCHAR) END AS product_id,
    CAST(o_orderkey % 7 AS INTEGER) AS quantity,
    CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 10000 AS INTEGER)
         * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price,
    CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100000 AS INTEGER)
         * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS total_amount,
    o_orderstatus AS status, o_orderdate AS order_date,
    TIMESTAMP '2001-08-02 00:00:00' AS extracted_at
  FROM orders
)"""

# Labels and bounds of the segments and size classes, units and names of the figures.
STG_CUSTOMERS = CUSTOMERS + """,
aged AS (SELECT *, CAST(DATE '2001-08-02' - registration_date AS INTEGER) AS days FROM crm),
stg_c AS (
  SELECT customer_id, upper(trim(customer_name)) AS customer_name, lower(trim(email)) AS email,
    trim(phone) AS phone, upper(trim(city)) AS city, lower(trim(status)) AS status,
    registration_date, extracted_at,
    coalesce(length(trim(customer_name)) > 0, false) AS has_valid_name,
    coalesce(strpos(email, '@') > 0, false) AS has_valid_email,
    days AS days_since_registration,
    CASE WHEN days < 30 THEN 'Yeni Müşteri' WHEN days < 365 THEN 'Aktif Müşteri' ELSE 'Eski Müşteri' END AS customer_segment
  FROM aged
)"""

STG_ORDERS = ORDERS + """,
stg_o AS (
  SELECT *, true AS has_valid_amounts, true AS has_valid_product,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(quarter(order_date) AS INTEGER) AS order_quarter,
    strftime(order_date, '%Y-%m') AS order_year_month,
    CASE WHEN total_amount < 100 THEN 'Küçük Sipariş' WHEN total_amount < 500 THEN 'Orta Sipariş'
         ELSE 'Büyük Sipariş' END AS order_category,
    CAST(quantity * unit_price AS DECIMAL(20,2)) AS calculated_total
  FROM erp
  WHERE quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL
)"""

STARS = f"""{STG_CUSTOMERS},{STG_ORDERS},
dim AS (
  SELECT customer_id, customer_name, email, city, customer_segment, registration_date
  FROM stg_c WHERE customer_id IS NOT NULL AND customer_name IS NOT NULL AND email IS NOT NULL
),
fact AS (
  SELECT order_id, customer_id, order_date, total_amount, order_category
  FROM stg_o WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount >= 0
)"""


def _metrics(dim: str = "dim", fact: str = "fact") -> str:
    return f"""
metrics AS (
  SELECT d.customer_id, count(f.order_id) AS total_orders,
    coalesce(sum(f.total_amount), 0) AS total_revenue,
    sum(f.total_amount) AS revenue, count(f.total_amount) AS amounts,
    max(f.order_date) AS last_order_date
  FROM {dim} d LEFT JOIN {fact} f USING (customer_id)
  GROUP BY d.customer_id
)"""


def _dashboard(as_of: str) -> str:
    """A CTE per KPI cell; ``as_of`` is a date literal."""
    return f"""
totals AS (
  SELECT count(*) AS customers, sum(total_revenue) AS revenue,
    avg(CAST(revenue AS DOUBLE) / amounts) FILTER (WHERE total_orders > 0) AS mean,
    count(*) FILTER (WHERE last_order_date >= {as_of} - INTERVAL 30 DAY) AS active,
    sum(total_orders) AS orders
  FROM metrics
),
dashboard AS (
  SELECT 'kpi_total_customers' AS kpi, 'Toplam Müşteri Sayısı' AS metric_name,
    CAST(customers AS VARCHAR) AS metric_value, 'Adet' AS unit, {as_of} AS calculation_date FROM totals
  UNION ALL SELECT 'kpi_total_revenue', 'Toplam Gelir',
    format('{{:,.2f}}', round(CAST(revenue AS DOUBLE), 2)), 'TL', {as_of} FROM totals
  UNION ALL SELECT 'kpi_avg_order_value', 'Ortalama Sipariş Değeri',
    coalesce(format('{{:,.2f}}', round(mean, 2)), '0'), 'TL', {as_of} FROM totals
  UNION ALL SELECT 'kpi_active_customer_rate', 'Aktif Müşteri Oranı',
    concat(printf('%.2f', round(active * 100.0 / customers, 2)), '%'), 'Yüzde', {as_of} FROM totals
  UNION ALL SELECT 'kpi_total_orders', 'Toplam Sipariş Sayısı',
    CAST(orders AS VARCHAR), 'Adet', {as_of} FROM totals
)"""


KPI_COLUMNS = "metric_name, metric_value, unit, calculation_date"
AS_OF = "DATE '2001-08-02'"
BOARD = f"WITH {STARS},{_metrics()},{_dashboard(AS_OF)}"

# Per line key, the greatest line by ship date and then by the other columns in order.
LATEST_LINES = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
      l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS place
  FROM lineitem {where}
) WHERE place = 1"""

LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"""

EVENTS = """
sent AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS customer_id,
    json_extract_string(props, '$.k') AS product_id,
    CAST(event_id % 5 + 1 AS INTEGER) AS quantity, value AS price, ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
    CASE event_type WHEN 'purchase' THEN 'order_event' WHEN 'signup' THEN 'crm_data'
      WHEN 'view' THEN 'erp_data' ELSE event_type END AS event_type,
    CASE event_type WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'crm'
      WHEN 'view' THEN 'erp' ELSE 'events' END AS route,
    event_id AS message_id
  FROM events
)"""

RAW_ORDERS = EVENTS + """,
loaded AS (
  SELECT event_id AS order_id, customer_id, product_id, quantity,
    CAST(price AS DECIMAL(10,2)) AS unit_price,
    CAST(quantity * price AS DECIMAL(10,2)) AS total_amount,
    'completed' AS status, ts AS order_date, TIMESTAMP '2024-02-01 00:00:00' AS extracted_at
  FROM sent WHERE route = 'order'
)"""

DQ_TESTS = f"""WITH {STARS},{_metrics()},{_dashboard(AS_OF)},
counted AS (
  SELECT 'unique' AS test_type, 'raw.crm_customers' AS dataset, 'customer_id' AS column_name,
    (SELECT count(*) FROM (SELECT 1 FROM crm GROUP BY customer_id HAVING count(customer_id) > 1)) AS failures
  UNION ALL SELECT 'not_null', 'raw.crm_customers', 'customer_id',
    (SELECT count(*) FROM crm WHERE customer_id IS NULL)
  UNION ALL SELECT 'unique', 'raw.crm_customers', 'email',
    (SELECT count(*) FROM (SELECT 1 FROM crm GROUP BY email HAVING count(email) > 1))
  UNION ALL SELECT 'not_null', 'raw.crm_customers', 'email',
    (SELECT count(*) FROM crm WHERE email IS NULL)
  UNION ALL SELECT 'unique', 'raw.erp_orders', 'order_id',
    (SELECT count(*) FROM (SELECT 1 FROM erp GROUP BY order_id HAVING count(order_id) > 1))
  UNION ALL SELECT 'not_null', 'raw.erp_orders', 'order_id',
    (SELECT count(*) FROM erp WHERE order_id IS NULL)
  UNION ALL SELECT 'not_null', 'raw.erp_orders', 'customer_id',
    (SELECT count(*) FROM erp WHERE customer_id IS NULL)
  UNION ALL SELECT 'not_null', 'raw.erp_orders', 'quantity',
    (SELECT count(*) FROM erp WHERE quantity IS NULL)
  UNION ALL SELECT 'accepted_range', 'raw.erp_orders', 'quantity',
    (SELECT count(*) FROM erp WHERE quantity < 0)
  UNION ALL SELECT 'not_null', 'raw.erp_orders', 'unit_price',
    (SELECT count(*) FROM erp WHERE unit_price IS NULL)
  UNION ALL SELECT 'accepted_range', 'raw.erp_orders', 'unit_price',
    (SELECT count(*) FROM erp WHERE unit_price < 0)
  UNION ALL SELECT 'unique', 'stg_crm_customers', 'customer_id',
    (SELECT count(*) FROM (SELECT 1 FROM stg_c GROUP BY customer_id HAVING count(customer_id) > 1))
  UNION ALL SELECT 'not_null', 'stg_crm_customers', 'customer_id',
    (SELECT count(*) FROM stg_c WHERE customer_id IS NULL)
  UNION ALL SELECT 'not_null', 'stg_crm_customers', 'has_valid_email',
    (SELECT count(*) FROM stg_c WHERE has_valid_email IS NULL)
  UNION ALL SELECT 'unique', 'stg_erp_orders', 'order_id',
    (SELECT count(*) FROM (SELECT 1 FROM stg_o GROUP BY order_id HAVING count(order_id) > 1))
  UNION ALL SELECT 'not_null', 'stg_erp_orders', 'order_id',
    (SELECT count(*) FROM stg_o WHERE order_id IS NULL)
  UNION ALL SELECT 'not_null', 'stg_erp_orders', 'total_amount',
    (SELECT count(*) FROM stg_o WHERE total_amount IS NULL)
  UNION ALL SELECT 'accepted_range', 'stg_erp_orders', 'total_amount',
    (SELECT count(*) FROM stg_o WHERE total_amount < 0)
  UNION ALL SELECT 'unique', 'int_customer_metrics', 'customer_id',
    (SELECT count(*) FROM (SELECT 1 FROM metrics GROUP BY customer_id HAVING count(customer_id) > 1))
  UNION ALL SELECT 'not_null', 'int_customer_metrics', 'customer_id',
    (SELECT count(*) FROM metrics WHERE customer_id IS NULL)
  UNION ALL SELECT 'not_null', 'int_customer_metrics', 'total_revenue',
    (SELECT count(*) FROM metrics WHERE total_revenue IS NULL)
  UNION ALL SELECT 'not_null', 'executive_dashboard', 'metric_name',
    (SELECT count(*) FROM dashboard WHERE metric_name IS NULL)
  UNION ALL SELECT 'not_null', 'executive_dashboard', 'metric_value',
    (SELECT count(*) FROM dashboard WHERE metric_value IS NULL)
)
SELECT concat(test_type, '_', replace(dataset, '.', '_'), '_', column_name) AS test_name,
  dataset, column_name, test_type, failures,
  CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status
FROM counted"""

# The same tables with repeated rows, and amounts that are missing or negative.
FAULTY_STARS = STARS.replace("crm AS (", "crm0 AS (", 1).replace("FROM customer\n)", """FROM customer
),
crm AS (SELECT * FROM crm0 UNION ALL SELECT * FROM crm0 WHERE customer_id % 29 = 0)""", 1).replace(
    "erp AS (", "erp0 AS (", 1).replace("FROM orders\n)", """FROM orders
),
erp1 AS (
  SELECT * REPLACE (
    CASE WHEN CAST(order_id AS BIGINT) % 31 <> 0 THEN CASE WHEN CAST(order_id AS BIGINT) % 37 = 0 THEN -1 ELSE quantity END END AS quantity,
    CASE WHEN CAST(order_id AS BIGINT) % 41 <> 0 THEN CASE WHEN CAST(order_id AS BIGINT) % 43 = 0 THEN CAST(-1 AS DECIMAL(10,2))
      ELSE unit_price END END AS unit_price,
    CASE WHEN CAST(order_id AS BIGINT) % 47 <> 0 THEN CASE WHEN CAST(order_id AS BIGINT) % 53 = 0 THEN CAST(-1 AS DECIMAL(10,2))
      ELSE total_amount END END AS total_amount) FROM erp0
),
erp AS (SELECT * FROM erp1 UNION ALL SELECT * FROM erp1 WHERE CAST(order_id AS BIGINT) % 23 = 0)""", 1)

# Of each declared test: table, key, dataset and column, and which rows fail.
_TESTED = [
    ("crm", "customer_id", "raw_crm_customers", "customer_id", "unique"), ("crm", "customer_id", "raw_crm_customers", "customer_id", "not_null"),
    ("crm", "customer_id", "raw_crm_customers", "email", "unique"), ("crm", "customer_id", "raw_crm_customers", "email", "not_null"),
    ("erp", "order_id", "raw_erp_orders", "order_id", "unique"), ("erp", "order_id", "raw_erp_orders", "order_id", "not_null"),
    ("erp", "order_id", "raw_erp_orders", "customer_id", "not_null"),
    ("erp", "order_id", "raw_erp_orders", "quantity", "not_null"), ("erp", "order_id", "raw_erp_orders", "quantity", "accepted_range"),
    ("erp", "order_id", "raw_erp_orders", "unit_price", "not_null"), ("erp", "order_id", "raw_erp_orders", "unit_price", "accepted_range"),
    ("stg_c", "customer_id", "stg_crm_customers", "customer_id", "unique"), ("stg_c", "customer_id", "stg_crm_customers", "customer_id", "not_null"),
    ("stg_c", "customer_id", "stg_crm_customers", "has_valid_email", "not_null"),
    ("stg_o", "order_id", "stg_erp_orders", "order_id", "unique"), ("stg_o", "order_id", "stg_erp_orders", "order_id", "not_null"),
    ("stg_o", "order_id", "stg_erp_orders", "total_amount", "not_null"), ("stg_o", "order_id", "stg_erp_orders", "total_amount", "accepted_range"),
    ("metrics", "customer_id", "int_customer_metrics", "customer_id", "unique"),
    ("metrics", "customer_id", "int_customer_metrics", "customer_id", "not_null"),
    ("metrics", "customer_id", "int_customer_metrics", "total_revenue", "not_null"),
    ("dashboard", "metric_name", "executive_dashboard", "metric_name", "not_null"),
    ("dashboard", "metric_name", "executive_dashboard", "metric_value", "not_null"),
]


def _stored_failures() -> str:
    parts = []
    for table, key, dataset, column, kind in _TESTED:
        name = f"'{kind}_{dataset}_{column}' AS test_name"
        if kind == "unique":
            parts.append(f"SELECT {name}, NULL AS row_key, CAST({column} AS VARCHAR) AS value, count(*) AS n_records "
                         f"FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1")
        else:
            fails = f"{column} IS NULL" if kind == "not_null" else f"{column} < 0"
            parts.append(f"SELECT {name}, CAST({key} AS VARCHAR), CAST({column} AS VARCHAR), NULL FROM {table} WHERE {fails}")
    return "\nUNION ALL ".join(parts)


ORACLES = {
    "stg_crm_customers": f"WITH {STG_CUSTOMERS} SELECT * FROM stg_c",
    "stg_erp_orders": f"WITH {STG_ORDERS} SELECT * FROM stg_o",
    "int_customer_cleaned": f"WITH {STARS} SELECT * FROM dim",
    "int_order_cleaned": f"WITH {STARS} SELECT * FROM fact",
    "dim_customer": f"WITH {STARS} SELECT * FROM dim",
    "fact_order": f"WITH {STARS} SELECT * FROM fact",
    "dim_fact_left_join": f"WITH {STARS} SELECT * FROM dim LEFT JOIN fact USING (customer_id)",
    # the mean in ten-thousandths, halves rounded up, in whole numbers
    "customer_metrics": f"""WITH {STARS},{_metrics()}
SELECT customer_id, total_orders, CAST(total_revenue AS DECIMAL(22,2)) AS total_revenue,
  CAST(CASE WHEN amounts = 0 THEN 0 ELSE
    CAST((2 * CAST(revenue * 10000 AS HUGEINT) + amounts) // (2 * amounts) AS DECIMAL(24,0)) END
    * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(28,4)) AS avg_order_value,
  last_order_date
FROM metrics""",
    "executive_dashboard": f"{BOARD} SELECT {KPI_COLUMNS} FROM dashboard",
    "executive_dashboard_strict_mask": f"""{BOARD}
SELECT metric_name, CASE WHEN unit = 'TL' THEN regexp_replace(metric_value, '^0[.]', '.')
  ELSE metric_value END AS metric_value, unit, calculation_date FROM dashboard""",
    "kpi_union_all": f"{BOARD} SELECT {KPI_COLUMNS} FROM dashboard",
    "run_layers": f"{BOARD} SELECT {KPI_COLUMNS} FROM dashboard",
    "customer_segments": f"""WITH {STG_CUSTOMERS}
SELECT customer_segment, count(*) AS customers FROM stg_c GROUP BY customer_segment""",
    "order_categories": f"""WITH {STG_ORDERS}
SELECT order_category, count(*) AS orders FROM stg_o GROUP BY order_category""",
    "dq_unique": """SELECT concat(l_orderkey, '-', l_linenumber) AS line_key, count(*) AS n_records
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_not_null": f"WITH {CUSTOMERS} SELECT customer_id, city FROM crm WHERE email IS NULL",
    "dq_stored_failures": f"WITH {FAULTY_STARS},{_metrics()},{_dashboard(AS_OF)} " + _stored_failures(),
    "dq_accepted_range": f"WITH {ORDERS} SELECT order_id, total_amount FROM erp WHERE total_amount < 100",
    "dq_relationship": f"""WITH {STARS} SELECT * FROM fact
WHERE customer_id NOT IN (SELECT customer_id FROM dim)""",
    "dq_relationship_count": f"""WITH {STARS} SELECT count(*) AS failures FROM fact
WHERE customer_id NOT IN (SELECT customer_id FROM dim)""",
    "dq_foreign_keys": """SELECT 'l_partkey' AS foreign_key, count(*) AS failures FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "dq_total_mismatch": f"""WITH {ORDERS} SELECT order_id, quantity, unit_price, total_amount
FROM erp WHERE total_amount <> quantity * unit_price""",
    "dq_report": DQ_TESTS,
    "incremental_extract": """SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate AS created_at
FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2001-05-31 00:00:00'""",
    "high_water_mark": """SELECT count(*) AS extract_count, max(o_orderdate) AS new_mark
FROM orders WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2001-05-31 00:00:00'""",
    "watermark_state": """SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate AS created_at
FROM orders WHERE o_orderstatus = 'P' AND o_orderdate > (
  SELECT max(o_orderdate) - INTERVAL 1 DAY FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate > TIMESTAMP '2001-05-31 00:00:00')""",
    "upsert_latest": LATEST_LINES.format(where=""),
    "upsert_idempotent": LATEST_LINES.format(where=""),
    "upsert_merge": f"""WITH base AS ({LATEST_LINES.format(where="")}),
batch AS ({LATEST_LINES.format(where="WHERE l_returnflag = 'R'")})
SELECT {LINE_COLUMNS} FROM batch
UNION ALL SELECT {LINE_COLUMNS} FROM base
WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM batch)""",
    "validate_events": f"""WITH {EVENTS}
SELECT message_id, event_id, customer_id, product_id, quantity, price, "timestamp", event_type
FROM sent WHERE message_id % 10 IN (0, 6, 8, 9)""",
    "dead_letter_events": """SELECT event_id AS message_id, CASE event_id % 10
  WHEN 1 THEN 'customer_id' WHEN 2 THEN 'quantity' WHEN 3 THEN 'quantity'
  WHEN 7 THEN 'product_id' ELSE 'not a JSON object' END AS reject_reason
FROM events WHERE event_id % 10 IN (1, 2, 3, 4, 5, 7)""",
    "enrich_order_event": f"""WITH {EVENTS}
SELECT event_id, customer_id, product_id, quantity, price,
  CASE WHEN quantity IN (2, 3) THEN "timestamp" ELSE '2024-02-01T08:30:00.250000' END AS order_date,
  CASE WHEN quantity = 2 THEN 'paid' ELSE 'pending' END AS status,
  '2024-02-01T08:30:00.250000' AS "timestamp", 'order_event' AS event_type
FROM sent""",
    "order_event_mapping": f"WITH {RAW_ORDERS} SELECT * FROM loaded",
    "stream_upsert_orders": f"WITH {RAW_ORDERS} SELECT * FROM loaded",
    "event_messages": f"""WITH {EVENTS}
SELECT concat('{{"event_id":"', event_id, '","customer_id":', customer_id, ',"product_id":"', product_id,
  '","quantity":', quantity, ',"price":', price, ',"timestamp":"', "timestamp",
  '","event_type":"', event_type, '"}}') AS value FROM sent""",
    "order_key_hash": f"""WITH {EVENTS}
SELECT 'hash:' || sha256(concat('{{"event_id":null,"order_id":null,"customer_id":"', customer_id, '","product_id":"',
  product_id, '","quantity":"', quantity, '","price":"', price, '","order_date":null,"status":null,"timestamp":"',
  "timestamp", '","event_type":"', event_type, '"}}')) AS order_id, ts AS order_date FROM sent""",
    "order_keys": f"""WITH {EVENTS}
SELECT CASE WHEN message_id % 4 > 1 THEN CAST(message_id AS VARCHAR)
    WHEN message_id % 8 = 4 THEN concat('order:', message_id + 2) WHEN message_id % 4 = 1 THEN concat('order:', message_id + 2)
    ELSE 'hash:' || sha256(concat('{{"event_id":"","order_id":null,"customer_id":"', customer_id, '","product_id":"',
      product_id, '","quantity":"', quantity, '","price":"', price, '","order_date":null,"status":null,"timestamp":"',
      "timestamp", '","event_type":"', event_type, '"}}')) END AS order_id, customer_id, ts AS order_date FROM sent""",
    "route_counts": f"WITH {EVENTS} SELECT route, count(*) AS n_events FROM sent GROUP BY route",
    "recent_events": "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 100",
    "recent_total": "SELECT least(count(*), 100) AS total FROM events",
    "upsert_erp_orders": f"""WITH {EVENTS},
keyed AS (
  SELECT concat(customer_id, '-', product_id) AS order_id, customer_id, product_id, quantity,
    CAST(price AS DECIMAL(10,2)) AS unit_price, CAST(quantity * price AS DECIMAL(10,2)) AS total_amount,
    'completed' AS status, ts AS order_date,
    CASE WHEN route = 'order' THEN TIMESTAMP '2024-02-02 00:00:00'
      ELSE TIMESTAMP '2024-02-01 00:00:00' END AS extracted_at
  FROM sent
)
SELECT order_id, customer_id, product_id, quantity, unit_price, total_amount, status, order_date, extracted_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY extracted_at DESC, order_date DESC) AS place
      FROM keyed) WHERE place = 1""",
    "upsert_crm_customers": """
SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS customer_name,
  concat('user', c_custkey, '@example.com') AS email, CAST(NULL AS VARCHAR) AS phone,
  CASE WHEN renewed THEN 'moved' ELSE c_mktsegment END AS city,
  CASE WHEN c_custkey % 11 = 0 THEN 'passive' ELSE 'active' END AS status,
  DATE '2024-01-31' - CAST(c_custkey % 3650 AS INTEGER) AS registration_date,
  CASE WHEN renewed THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2024-01-30 00:00:00' END AS extracted_at
FROM (SELECT *, c_custkey % 11 <> 0 AND TIMESTAMP '2024-01-31 12:00:00' - to_days(CAST(c_custkey % 60 AS INTEGER))
      > TIMESTAMP '2024-01-19 00:00:00' AS renewed FROM customer)""",
    "land_events_stream": f"""WITH {EVENTS}
SELECT message_id AS event_id, customer_id, product_id, quantity, price, ts AS "timestamp",
  event_type, route FROM sent""",
    "recent_landed": f"""WITH {EVENTS}
SELECT event_id, "timestamp", route FROM sent ORDER BY "timestamp" DESC, event_id DESC LIMIT 25""",
    "dedup_events": "SELECT * FROM events",
    "snapshot_roundtrip": f"WITH {CUSTOMERS} SELECT * FROM crm",
    "lake_prefix": f"""WITH {ORDERS} SELECT order_id, CAST(customer_id AS INTEGER) AS customer_id,
  product_id, quantity, unit_price, total_amount, status, order_date FROM erp""",
    "lake_listing": f"""WITH {EVENTS}
SELECT route, CAST(sum(strlen(concat('{{"event_id":"', event_id, '","customer_id":', customer_id, ',"product_id":"', product_id,
  '","quantity":', quantity, ',"price":', price, ',"timestamp":"', "timestamp",
  '","event_type":"', event_type, '"}}')) + 1) AS BIGINT) AS total_bytes,
  true AS same_names, true AS in_the_past, CAST(2 AS BIGINT) AS capped FROM sent GROUP BY route""",
    "lake_objects": f"WITH {CUSTOMERS} SELECT * FROM crm",
    "landed_dead_letters": f"""WITH {EVENTS}
SELECT CASE WHEN message_id % 10 = 4 THEN left(concat('{{"event_id":"', event_id, '","customer_id":', customer_id, ',"product_id":"',
    product_id, '"}}'), 30) END AS value,
  CASE WHEN message_id % 10 = 4 THEN 'not a JSON object' ELSE 'no text' END AS reason, 'etl_events' AS topic,
  CAST(message_id % 3 AS INTEGER) AS "partition", CAST(message_id AS BIGINT) AS "offset", 0 AS replays
FROM sent WHERE message_id % 10 IN (4, 5)""",
    "replayed_dead_letters": f"""WITH {EVENTS}
SELECT route, CAST(NULL AS INTEGER) AS replays, count(*) AS n_messages FROM (
  SELECT CASE WHEN message_id % 10 = 4 THEN 'events' ELSE route END AS route FROM sent WHERE message_id % 10 <> 5) GROUP BY route
UNION ALL SELECT 'dead_letter', 0, count(*) FROM sent WHERE message_id % 10 IN (4, 5)
UNION ALL SELECT 'dead_letter', 1, count(*) FROM sent WHERE message_id % 10 = 5""",
    "inventory_available": """
SELECT p_partkey AS product_id, p_brand AS warehouse_id, p_size * 100 AS quantity_on_hand,
  coalesce(reserved, 0) AS quantity_reserved, p_size * 100 - coalesce(reserved, 0) AS quantity_available
FROM part LEFT JOIN (
  SELECT l_partkey, CAST(sum(l_quantity) AS INTEGER) AS reserved FROM lineitem GROUP BY l_partkey
) ON l_partkey = p_partkey""",
    "customer_defaults": """SELECT c_custkey AS customer_id,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS customer_type, 'Active' AS customer_status,
  TIMESTAMP '2001-08-02 00:00:00' AS created_at, TIMESTAMP '2001-08-02 00:00:00' AS updated_at FROM customer""",
    "product_defaults": """SELECT p_partkey AS product_id, 'Active' AS product_status,
  DATE '2001-08-02' AS created_date, DATE '2001-08-02' AS updated_date FROM part""",
    "inventory_defaults": """SELECT p_partkey AS product_id, p_size * 100 AS quantity_on_hand, 0 AS quantity_reserved,
  0 AS reorder_point, 0 AS max_stock_level, TIMESTAMP '2001-08-02 00:00:00' AS last_updated FROM part""",
    "order_flags": f"""WITH {ORDERS} SELECT order_id, coalesce(quantity > 0 AND unit_price > 0, false) AS has_valid_amounts,
  product_id IS NOT NULL AS has_valid_product FROM erp""",
    "send_orders": f"""WITH {EVENTS}
SELECT CAST(message_id AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
  product_id, CAST(quantity AS VARCHAR) AS quantity, CAST(price AS VARCHAR) AS price,
  '2024-02-01T08:30:00.250000' AS order_date, 'pending' AS status, '2024-02-01T08:30:00.250000' AS "timestamp",
  'order_event' AS event_type, CAST(NULL AS VARCHAR) AS reject_reason
FROM sent WHERE message_id % 10 IN (0, 6, 8, 9)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE event_id % 10
  WHEN 1 THEN 'customer_id' WHEN 2 THEN 'quantity' WHEN 3 THEN 'quantity'
  WHEN 7 THEN 'product_id' ELSE 'not a JSON object' END
FROM events WHERE event_id % 10 IN (1, 2, 3, 4, 5, 7)""",
    "send_order_stream": f"""WITH {EVENTS}
SELECT CAST(message_id AS VARCHAR) AS event_id, CAST(NULL AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
  product_id, CAST(quantity AS VARCHAR) AS quantity, CAST(price AS VARCHAR) AS price,
  '2024-02-01T08:30:00.250000' AS order_date, 'pending' AS status, '2024-02-01T08:30:00.250000' AS "timestamp",
  'order_event' AS event_type, CAST(NULL AS VARCHAR) AS reject_reason
FROM sent WHERE message_id % 10 IN (0, 6, 8, 9)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE event_id % 10
  WHEN 1 THEN 'customer_id' WHEN 2 THEN 'quantity' WHEN 3 THEN 'quantity'
  WHEN 7 THEN 'product_id' ELSE 'not a JSON object' END
FROM events WHERE event_id % 10 IN (1, 2, 3, 4, 5, 7)""",
    "load_order_documents": f"WITH {RAW_ORDERS} SELECT * FROM loaded",
    "column_defaults": """
SELECT l_orderkey AS sale_id, l_linenumber AS line, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS sale_date,
  CASE WHEN l_returnflag = 'N' THEN 1 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
  CAST(CASE WHEN l_discount > 0.05 THEN l_discount ELSE 0 END AS DECIMAL(10,2)) AS discount_amount,
  TIMESTAMP '2001-08-02 00:00:00' AS created_at, TIMESTAMP '2001-08-02 00:00:00' AS updated_at
FROM lineitem""",
    "run_batch": f"""WITH {RAW_ORDERS},
extracted AS (
  SELECT c_custkey AS customer_id, c_name, c_mktsegment,
    TIMESTAMP '2024-01-31 12:00:00' - to_days(CAST(c_custkey % 60 AS INTEGER)) AS created_at
  FROM customer WHERE c_custkey % 11 <> 0
),
dim AS (
  SELECT * FROM extracted WHERE created_at > TIMESTAMP '2023-12-31 18:00:00' AND c_name IS NOT NULL
),
fact AS (
  SELECT * FROM loaded WHERE quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL
    AND total_amount >= 0 AND customer_id IS NOT NULL
),{_metrics()},{_dashboard("DATE '2024-01-31'")}
SELECT {KPI_COLUMNS}, (SELECT max(created_at) FROM dim) AS watermark FROM dashboard""",
}

for _kpi in ("kpi_total_customers", "kpi_total_revenue", "kpi_avg_order_value",
             "kpi_active_customer_rate", "kpi_total_orders"):
    ORACLES[_kpi] = f"{BOARD} SELECT {KPI_COLUMNS} FROM dashboard WHERE kpi = '{_kpi}'"


for _stored, _same in (("stored_stg_crm_customers", "stg_crm_customers"), ("stored_int_customer_cleaned", "int_customer_cleaned"),
                       ("stored_int_order_cleaned", "int_order_cleaned"), ("merged_landed_days", "land_events_stream")):
    ORACLES[_stored] = ORACLES[_same]
ORACLES["stream_progress"] = "SELECT false AS running, count(*) AS run_rows, CAST(1 AS INTEGER) AS sources FROM events"
