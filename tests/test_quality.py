import golden
from ordervane.operators import quality
from ordervane.operators.rows import add_quantity_available, fill_defaults
from ordervane.plans import marts


def ids(df, column="order_id"):
    return sorted(r[column] for r in df.collect())


def datasets(spark):
    metrics = golden.metrics(spark)
    return {
        "raw.crm_customers": golden.customers(spark),
        "raw.erp_orders": golden.orders(spark),
        "stg_crm_customers": golden.stg_customers(spark),
        "stg_erp_orders": golden.stg_orders(spark),
        "int_customer_metrics": metrics,
        "executive_dashboard": marts.executive_dashboard(metrics, golden.AS_OF),
    }


FAILING = {
    "not_null_raw_crm_customers_email": 1,
    "not_null_raw_erp_orders_customer_id": 1,
    "not_null_stg_erp_orders_total_amount": 1,
    "accepted_range_stg_erp_orders_total_amount": 1,
}


def test_single_checks(spark):
    raw, orders = golden.customers(spark), golden.orders(spark)
    staged = golden.stg_orders(spark)
    assert ids(quality.check_not_null(raw, "email"), "customer_id") == [5]
    assert ids(quality.check_not_null(orders, "customer_id")) == ["o10"]
    assert ids(quality.check_accepted_range(orders, "quantity")) == []
    assert ids(quality.check_not_null(staged, "total_amount")) == ["o7"]
    assert ids(quality.check_accepted_range(staged, "total_amount")) == ["o11"]
    assert ids(quality.check_relationship(orders, "customer_id", raw)) == ["o8"]
    assert quality.count_orphans(orders, "customer_id", raw).first().failures == 1
    assert ids(quality.check_total_mismatch(orders)) == ["o1", "o11"]
    assert quality.check_unique(raw, "email").count() == 0
    assert [tuple(r) for r in quality.check_unique(orders, "product_id").orderBy("product_id").collect()] == [
        ("p1", 9)]


def test_unmatched_count_of_no_orphans_is_zero(spark):
    raw = golden.customers(spark)
    assert quality.count_orphans(raw, "customer_id", raw).first().failures == 0


def test_report_lists_every_declared_test(spark):
    assert len(quality.DECLARED_TESTS) == 23
    rows = quality.dq_report(datasets(spark)).collect()
    assert len(rows) == 23
    assert {r.test_name: r.failures for r in rows if r.status == "fail"} == FAILING
    assert all(r.failures == 0 for r in rows if r.status == "pass")


def test_report_agrees_with_the_single_checks(spark):
    frames = datasets(spark)
    frames["raw.crm_customers"] = frames["raw.crm_customers"].union(
        frames["raw.crm_customers"].filter("customer_id in (2, 5)"))
    counts = {r.test_name: r.failures for r in quality.dq_report(frames).collect()}
    for test in quality.DECLARED_TESTS:
        assert counts[test.name] == test.failing_rows(frames[test.dataset]).count(), test.name
    assert counts["unique_raw_crm_customers_customer_id"] == 2
    assert counts["unique_raw_crm_customers_email"] == 1


def test_report_of_empty_datasets_passes(spark):
    frames = {name: df.limit(0) for name, df in datasets(spark).items()}
    assert {r.status for r in quality.dq_report(frames).collect()} == {"pass"}


def test_stored_failures(spark, tmp_path):
    frames = datasets(spark)
    report = quality.dq_report(frames).collect()
    failed = quality.store_failures(
        frames, report, lambda df, name: df.write.mode("overwrite").parquet(f"{tmp_path}/{name}"))
    assert set(failed) == set(FAILING)
    assert ids(spark.read.parquet(f"{tmp_path}/not_null_raw_crm_customers_email"), "customer_id") == [5]
    assert spark.read.parquet(f"{tmp_path}/unique_raw_erp_orders_order_id").count() == 0


def test_defaults_and_generated_column(spark):
    stock = golden.frame(spark, [(1, 7, None), (2, None, 3)],
                                  "product_id int, quantity_on_hand int, quantity_reserved int")
    kept = fill_defaults(stock, "erp.inventory", "2024-03-01 01:02:03").orderBy("product_id").first()
    assert (kept.quantity_reserved, kept.reorder_point) == (None, 0)
    filled = fill_defaults(stock, "erp.inventory", "2024-03-01 01:02:03", fill_nulls=True)
    rows = add_quantity_available(filled).orderBy("product_id").collect()
    assert [r.quantity_available for r in rows] == [7, -3]
    assert [r.reorder_point for r in rows] == [0, 0]
    assert str(rows[0].last_updated) == "2024-03-01 01:02:03"
    product = golden.frame(spark, [(1,)], "product_id int")
    row = fill_defaults(product, "erp.products", "2024-03-01 23:00:00").first()
    assert (row.product_status, str(row.created_date)) == ("Active", "2024-03-01")
