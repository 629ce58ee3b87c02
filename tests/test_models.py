import datetime as dt
from decimal import Decimal

import golden
import pytest
from ordervane.plans import intermediate, marts, staging, warehouse
from pyspark.sql import functions as F

NEW, ACTIVE, OLD = "Yeni Müşteri", "Aktif Müşteri", "Eski Müşteri"
SMALL, MEDIUM, LARGE = "Küçük Sipariş", "Orta Sipariş", "Büyük Sipariş"


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_staged_customers(spark):
    rows = golden.stg_customers(spark).orderBy("customer_id").collect()
    seen = [
        (r.customer_name, r.email, r.has_valid_name, r.has_valid_email,
         r.days_since_registration, r.customer_segment) for r in rows
    ]
    assert seen == [
        ("ADA LOVELACE", "ada@example.com", True, True, 20, NEW),
        ("BOB", "bob@x.io", True, True, 30, ACTIVE),
        ("", "blank@x.io", False, True, 364, ACTIVE),
        (None, "noname@x.io", False, True, 365, OLD),
        ("EVE", None, True, False, 790, OLD),
        ("FAY", "not-an-email", True, False, None, OLD),
        ("GUS", "gus@x.io", True, True, -14, NEW),
    ]
    assert {(r.phone, r.city) for r in rows} == {("555", "ANKARA")}
    assert [r.status for r in rows][:2] == ["active", "active"]


def test_staged_orders(spark):
    rows = {r.order_id: r for r in golden.stg_orders(spark).collect()}
    assert set(rows) == {"o1", "o2", "o3", "o4", "o7", "o8", "o9", "o10", "o11"}
    assert {k: r.order_category for k, r in rows.items()} == {
        "o1": SMALL, "o2": MEDIUM, "o3": LARGE, "o4": MEDIUM, "o7": LARGE,
        "o8": SMALL, "o9": LARGE, "o10": SMALL, "o11": SMALL,
    }
    first = rows["o1"]
    assert (first.order_year, first.order_month, first.order_quarter, first.order_year_month) == (
        2024, 2, 1, "2024-02")
    assert all(r.has_valid_amounts and r.has_valid_product for r in rows.values())


def test_calculated_total_is_optional(spark):
    staged = staging.stg_erp_orders(golden.orders(spark), with_calculated_total=True)
    assert {r.order_id: r.calculated_total for r in staged.collect()}["o1"] == Decimal("100.00")
    assert "calculated_total" not in golden.stg_orders(spark).columns


def test_dimension_and_fact(spark):
    assert [r.customer_id for r in golden.dim(spark).orderBy("customer_id").collect()] == [1, 2, 3, 6, 7]
    assert {r.order_id for r in golden.fact(spark).collect()} == {"o1", "o2", "o3", "o4", "o8", "o9"}


def test_customer_metrics(spark):
    rows = golden.metrics(spark).orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 2, Decimal("199.99"), Decimal("99.995"), dt.datetime(2024, 2, 20)),
        (2, 1, Decimal("500.00"), Decimal("500"), dt.datetime(2024, 1, 31)),
        (3, 1, Decimal("499.99"), Decimal("499.99"), dt.datetime(2024, 1, 30, 23, 59, 59)),
        (6, 0, Decimal("0"), Decimal("0"), None),
        (7, 0, Decimal("0"), Decimal("0"), None),
    ]


def test_metrics_equal_join_then_group_with_repeated_customers(spark):
    dim = golden.dim(spark)
    dim = dim.union(dim.filter("customer_id in (1, 6)"))
    fact = golden.fact(spark).union(
        golden.frame(spark, [("o20", 3, dt.datetime(2024, 2, 2), None, SMALL)], golden.fact(spark).schema)
    )
    joined = dim.select("customer_id").join(fact, "customer_id", "left").groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(22,2)").alias("total_revenue"),
        F.coalesce(F.avg("total_amount"), F.lit(0)).cast("decimal(28,6)").alias("avg_order_value"),
        F.max("order_date").alias("last_order_date"),
    )
    seen = intermediate.int_customer_metrics(dim, fact).withColumn(
        "avg_order_value", F.col("avg_order_value").cast("decimal(28,6)"))
    assert values(seen, *joined.columns) == values(joined, *joined.columns)


def test_left_join_keeps_customers_without_orders(spark):
    dim, fact = golden.dim(spark), golden.fact(spark)
    seen = warehouse.dim_fact_left_join(dim, fact)
    plain = dim.join(fact, "customer_id", "left")
    assert seen.columns == plain.columns
    assert values(seen, *plain.columns) == values(plain, *plain.columns)
    assert seen.count() == 6


def test_dashboard(spark):
    rows = marts.executive_dashboard(golden.metrics(spark), golden.AS_OF).collect()
    assert [tuple(r) for r in rows] == [
        ("Toplam Müşteri Sayısı", "5", "Adet", golden.AS_OF),
        ("Toplam Gelir", "1,199.98", "TL", golden.AS_OF),
        ("Ortalama Sipariş Değeri", "366.66", "TL", golden.AS_OF),
        ("Aktif Müşteri Oranı", "40.00%", "Yüzde", golden.AS_OF),
        ("Toplam Sipariş Sayısı", "4", "Adet", golden.AS_OF),
    ]


@pytest.mark.parametrize("name", list(marts.KPIS))
def test_single_kpi_equals_dashboard_row(spark, name):
    metrics = golden.metrics(spark)
    label = marts.KPIS[name].label
    whole = marts.executive_dashboard(metrics, golden.AS_OF).filter(F.col("metric_name") == label)
    assert marts.kpi(metrics, name, golden.AS_OF).collect() == whole.collect()


def test_dashboard_of_nothing(spark):
    empty = golden.metrics(spark).limit(0)
    assert [r.metric_value for r in marts.executive_dashboard(empty, golden.AS_OF).collect()] == [
        "0", "0", "0", "0%", "0"]


def test_dashboard_without_orders(spark):
    metrics = intermediate.int_customer_metrics(golden.dim(spark), golden.fact(spark).limit(0))
    plain = marts.executive_dashboard(metrics, golden.AS_OF)
    assert [r.metric_value for r in plain.collect()] == ["5", "0.00", "0", "0.00%", "0"]
    strict = marts.executive_dashboard(metrics, golden.AS_OF, strict_mask=True)
    assert [r.metric_value for r in strict.collect()] == ["5", ".00", "0", "0.00%", "0"]


@pytest.mark.parametrize("amount, plain, strict", [
    ("999999999.99", "999,999,999.99", "999,999,999.99"),
    ("1000000000.00", "1,000,000,000.00", "###,###,###.##"),
    ("0.5", "0.50", ".50"),
    ("-0.5", "-0.50", "-.50"),
    ("2.345", "2.35", "2.35"),
])
def test_amount_text(spark, amount, plain, strict):
    from ordervane.functions import amount_text

    value = F.lit(amount).cast("decimal(20,3)")
    row = spark.range(1).select(amount_text(value).alias("p"), amount_text(value, 9).alias("s")).first()
    assert (row.p, row.s) == (plain, strict)


def test_label_bounds_are_parameters(spark):
    staged = staging.stg_erp_orders(golden.orders(spark), small_below=10, medium_below=600)
    assert {r.order_id: r.order_category for r in staged.collect()}["o3"] == MEDIUM
