"""Declarative data tests. A check returns its failing rows; none means passed."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DQ_REPORT
from .rows import union_all


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values occurring more than once, with their counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_accepted_range(df: DataFrame, column: str, min_value=0) -> DataFrame:
    """Rows below ``min_value``; the bound itself and nulls pass."""
    return df.filter(F.col(column) < min_value)


def check_relationship(child: DataFrame, column: str, parent: DataFrame,
                       parent_column: str | None = None) -> DataFrame:
    """Child rows whose non-null ``column`` is in no parent row.

    Null keys pass, and are dropped before the shuffle. Large groups of one key
    are split by adaptive execution, as the child is the left side.
    """
    keys = parent.select(F.col(parent_column or column).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def count_orphans(child: DataFrame, column: str, parent: DataFrame,
                  parent_column: str | None = None) -> DataFrame:
    """How many rows ``check_relationship`` would return, counted per key before the join."""
    per_key = child.groupBy(column).agg(F.count("*").alias("rows_per_key"))
    orphans = check_relationship(per_key, column, parent, parent_column)
    return orphans.agg(F.coalesce(F.sum("rows_per_key"), F.lit(0)).cast("bigint").alias("failures"))


def check_total_mismatch(orders: DataFrame) -> DataFrame:
    """Orders whose stored total is not quantity times unit price; null totals pass."""
    return orders.filter(F.col("total_amount") != F.col("quantity") * F.col("unit_price"))


@dataclass(frozen=True)
class DataTest:
    """A declared test of one column of one dataset."""

    dataset: str
    column: str
    kind: str
    min_value: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.dataset.replace('.', '_')}_{self.column}"

    def failing_rows(self, df: DataFrame) -> DataFrame:
        if self.kind == "unique":
            return check_unique(df, self.column)
        if self.kind == "not_null":
            return check_not_null(df, self.column)
        return check_accepted_range(df, self.column, self.min_value)

    def row_fails(self) -> Column:
        """For the tests that look at one row at a time."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        return F.col(self.column) < self.min_value


# Fixed value: tables built at a time.
THREADS = 4

UNIQUE, NOT_NULL, RANGE = "unique", "not_null", "accepted_range"

# The declared tests, as (dataset, column, kinds). Ranges start at 0.
DECLARED = [
    ("raw.crm_customers", "customer_id", [UNIQUE, NOT_NULL]),
    ("raw.crm_customers", "email", [UNIQUE, NOT_NULL]),
    ("raw.erp_orders", "order_id", [UNIQUE, NOT_NULL]),
    ("raw.erp_orders", "customer_id", [NOT_NULL]),
    ("raw.erp_orders", "quantity", [NOT_NULL, RANGE]),
    ("raw.erp_orders", "unit_price", [NOT_NULL, RANGE]),
    ("stg_crm_customers", "customer_id", [UNIQUE, NOT_NULL]),
    ("stg_crm_customers", "has_valid_email", [NOT_NULL]),
    ("stg_erp_orders", "order_id", [UNIQUE, NOT_NULL]),
    ("stg_erp_orders", "total_amount", [NOT_NULL, RANGE]),
    ("int_customer_metrics", "customer_id", [UNIQUE, NOT_NULL]),
    ("int_customer_metrics", "total_revenue", [NOT_NULL]),
    ("executive_dashboard", "metric_name", [NOT_NULL]),
    ("executive_dashboard", "metric_value", [NOT_NULL]),
]

DECLARED_TESTS = [
    DataTest(dataset, column, kind, 0 if kind == RANGE else None)
    for dataset, column, kinds in DECLARED
    for kind in kinds
]


def _stacked(counts: DataFrame, tests: list[DataTest]) -> DataFrame:
    """One row holding a count per test, turned into a row per test."""
    cells = [
        cell
        for t in tests
        for cell in (F.lit(t.name), F.lit(t.dataset), F.lit(t.column), F.lit(t.kind), F.col(t.name))
    ]
    return counts.select(
        F.stack(F.lit(len(tests)), *cells).alias(
            "test_name", "dataset", "column_name", "test_type", "failures"
        )
    )


def _row_test_counts(df: DataFrame, tests: list[DataTest]) -> DataFrame:
    return df.agg(*[F.count_if(t.row_fails()).alias(t.name) for t in tests])


def _unique_test_counts(df: DataFrame, tests: list[DataTest]) -> DataFrame:
    """All unique tests of a dataset from one scan and one shuffle.

    The tested columns are unpivoted to (column, value) pairs, counted per pair
    with a partial count in each task.
    """
    values = [F.col(t.column).cast("string").alias(t.column) for t in tests]
    pairs = df.select(*values).unpivot([], [t.column for t in tests], "column_name", "value")
    counted = (
        pairs.filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_records"))
    )
    return counted.agg(*[
        F.count_if((F.col("column_name") == t.column) & (F.col("n_records") > 1)).alias(t.name)
        for t in tests
    ])


def dq_report(datasets: dict[str, DataFrame], tests: list[DataTest] | None = None) -> DataFrame:
    """One row per test with its failure count and ``pass`` or ``fail``.

    Each dataset is read once for its row tests and once for its unique tests.
    """
    tests = DECLARED_TESTS if tests is None else tests
    parts = []
    for dataset in dict.fromkeys(t.dataset for t in tests):
        own = [t for t in tests if t.dataset == dataset]
        unique = [t for t in own if t.kind == UNIQUE]
        by_row = [t for t in own if t.kind != UNIQUE]
        if by_row:
            parts.append(_stacked(_row_test_counts(datasets[dataset], by_row), by_row))
        if unique:
            parts.append(_stacked(_unique_test_counts(datasets[dataset], unique), unique))
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    return union_all(parts).withColumn("status", status).select(*DQ_REPORT.names)


def store_failures(datasets: dict[str, DataFrame], report: list, write: Callable[[DataFrame, str], None],
                   tests: list[DataTest] | None = None, threads: int = THREADS) -> list[str]:
    """Write the failing rows of each test by its name; returns the failed tests.

    ``report`` holds the collected report, a row per declared test. A passed test
    gets an empty table without reading its dataset again. ``threads`` tables are
    written at a time.
    """
    failures = {row["test_name"]: row["failures"] for row in report}
    tests = DECLARED_TESTS if tests is None else tests

    def store(test: DataTest) -> None:
        rows = test.failing_rows(datasets[test.dataset])
        write(rows if failures[test.name] else rows.limit(0), test.name)

    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(store, tests))
    return [test.name for test in tests if failures[test.name]]
