import datetime as dt
import json

import golden
import pytest
from ordervane.plans import batch, layers
from ordervane.sources.state import ControlTable, get_watermark
from ordervane.sources.tables import ModelTables
from ordervane.streaming import landing


def model_run(spark, tmp_path, **sources):
    raw = {"raw.crm_customers": golden.customers(spark), "raw.erp_orders": golden.orders(spark), **sources}
    tables = ModelTables(spark, str(tmp_path / "warehouse"), ControlTable(spark, str(tmp_path / "control")))
    return layers.ModelRun(spark, raw, tables, golden.AS_OF)


def board(run):
    return [r.metric_value for r in run.tables.read_table("marts", "executive_dashboard").collect()]


GOLDEN_BOARD = ["5", "1,199.98", "366.66", "40.00%", "4"]


def test_all_layers_then_tests(spark, tmp_path):
    run = model_run(spark, tmp_path)
    result = layers.run_layers(run)
    assert list(result["stages"]) == ["staging", "intermediate", "warehouse", "marts", "tests"]
    assert board(run) == GOLDEN_BOARD
    assert spark.table("stg_erp_orders").count() == 9
    assert spark.table(run.tables.table_name("warehouse", "dim_customer")).count() == 5
    # the golden rows break four of the declared tests
    assert result["status"] == "completed_with_errors"
    assert len(result["stages"]["tests"]["failed"]) == 4
    kept = spark.read.parquet(f"{run.tables.root}/test_results/not_null_raw_crm_customers_email")
    assert [r.customer_id for r in kept.collect()] == [5]


def test_stored_views_equal_the_models(spark, tmp_path):
    run = model_run(spark, tmp_path)
    names = {}
    for source, rows in run.sources.items():
        layer, name = source.split(".")
        rows.write.parquet(str(tmp_path / "raw" / name))
        names[source] = run.tables.register(layer, name, str(tmp_path / "raw" / name), rows.schema)
    stored = layers.ModelRun(spark, run.sources, run.tables, golden.AS_OF, stored=names)
    assert layers.run_layers(stored, with_tests=False)["status"] == "completed"
    other = spark.newSession()
    for name in layers.VIEWS:
        view = other.table(stored.stored_name(name))
        assert view.schema == layers.MODELS[name].rows(run).schema or view.dtypes == layers.MODELS[name].rows(run).dtypes
        assert sorted(map(repr, view.collect())) == sorted(map(repr, layers.MODELS[name].rows(run).collect()))


def test_clean_rows_complete(spark, tmp_path):
    orders = golden.orders(spark).filter("order_id in ('o1', 'o2', 'o3', 'o4')")
    customers = golden.customers(spark).filter("email is not null")
    run = model_run(spark, tmp_path, **{"raw.crm_customers": customers, "raw.erp_orders": orders})
    assert layers.run_layers(run)["status"] == "completed"


def test_selection(spark, tmp_path):
    run = model_run(spark, tmp_path)
    result = layers.run_layers(run, select=["warehouse", "int_order_cleaned", "int_customer_metrics"], with_tests=False)
    assert {k: v["models"] for k, v in result["stages"].items()} == {
        "intermediate": ["int_order_cleaned", "int_customer_metrics"], "warehouse": ["dim_customer", "fact_order"]}
    later = layers.ModelRun(spark, run.sources, run.tables, golden.AS_OF)
    assert layers.run_layer(later, "marts")["status"] == "success"
    assert board(later) == GOLDEN_BOARD


def test_stops_after_a_failed_layer(spark, tmp_path):
    run = model_run(spark, tmp_path, **{"raw.erp_orders": golden.orders(spark).drop("unit_price")})
    result = layers.run_layers(run)
    assert list(result["stages"]) == ["staging"]
    assert result["status"] == "completed_with_errors"
    assert "unit_price" in result["stages"]["staging"]["error"]


SOURCE = ("id int, customer_name string, email string, phone string, city string, status string, "
          "registration_date date, created_at timestamp_ntz")
NOW = dt.datetime(2024, 3, 1, 6)


def source(spark, *rows):
    return golden.frame(spark, [
        (i, name, f"{name}@x.io", None, "izmir", "active", dt.date(2024, 2, 20), created) for i, name, created in rows
    ], SOURCE)


def land(spark, places, tmp_path, *events):
    sent = tmp_path / "sent"
    sent.mkdir(exist_ok=True)
    number = len(list(sent.iterdir()))
    (sent / f"{number}.txt").write_text("\n".join(json.dumps(e) for e in events) + "\n")
    landing.land_events(spark.readStream.text(str(sent)), places.lake, str(tmp_path / "land-checkpoint"),
                        once=True).awaitTermination()


def order(number, customer, price, at="2024-02-25T10:00:00"):
    return {"event_id": f"e{number}", "customer_id": customer, "product_id": "p", "quantity": 1,
            "price": price, "timestamp": at, "event_type": "order_event"}


def values(spark, places):
    tables = ModelTables(spark, places.warehouse, ControlTable(spark, f"{places.state}/control"))
    return [r.metric_value for r in tables.read_table("marts", "executive_dashboard").collect()]


def test_batches_build_on_each_other(spark, tmp_path):
    places = batch.Places.below(str(tmp_path / "root"))
    customers = source(spark, (1, "ada", dt.datetime(2024, 2, 20)), (2, "bob", dt.datetime(2024, 2, 28, 12)))
    land(spark, places, tmp_path, order(1, 1, 50.0), order(2, 2, 100.0), {"event_type": "click"})
    first = batch.run_batch(spark, customers, places, "2024-03-01", NOW, NOW.date())
    assert (first["status"], first["extracted"], first["watermark"]) == ("completed", 2, "2024-02-28T12:00:00")
    assert values(spark, places) == ["2", "150.00", "75.00", "100.00%", "2"]

    repeated = batch.run_batch(spark, customers, places, "2024-03-01", NOW, NOW.date())
    assert repeated["extracted"] == 1  # the overlap
    assert values(spark, places) == ["2", "150.00", "75.00", "100.00%", "2"]

    more = customers.union(source(spark, (3, "cem", dt.datetime(2024, 3, 1, 1))))
    land(spark, places, tmp_path, order(2, 2, 300.0), order(3, 3, 10.0))
    second = batch.run_batch(spark, more, places, "2024-03-01", NOW + dt.timedelta(hours=6), NOW.date(),
                            compact=True)
    assert (second["extracted"], second["watermark"]) == (2, "2024-03-01T01:00:00")
    assert values(spark, places) == ["3", "360.00", "120.00", "100.00%", "3"]


def test_the_source_is_read_once_and_an_empty_extract_leaves_the_snapshot(spark, tmp_path):
    from ordervane.sources import lake
    from pyspark.sql import functions as F

    places = batch.Places.below(str(tmp_path / "root"))
    control = ControlTable(spark, f"{places.state}/control")
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    customers = source(spark, (1, "ada", dt.datetime(2024, 2, 20)), (2, "bob", dt.datetime(2024, 2, 28, 12)))
    found = batch.extract_crm(spark, customers.withColumn("phone", counted("email")), places, control, "2024-03-01", NOW)
    assert found == {"count": 2, "mark": "2024-02-28T12:00:00"} and reads.value == 2
    again = batch.extract_crm(spark, customers.limit(0), places, control, "2024-03-01", NOW)
    assert again == {"count": 0, "mark": None}
    assert lake.read_lake_snapshot(spark, places.lake, "crm", "2024-03-01", batch.CRM_EXTRACT).count() == 2
    assert not list((tmp_path / "root/lake/_writing").iterdir())


def test_run_without_anything_new_keeps_the_mark(spark, tmp_path):
    places = batch.Places.below(str(tmp_path / "root"))
    result = batch.run_batch(spark, source(spark).limit(0), places, "2024-03-01", NOW, NOW.date())
    assert (result["status"], result["extracted"], result["watermark"]) == ("completed", 0, None)
    assert values(spark, places) == ["0", "0", "0", "0%", "0"]


def test_mark_stays_when_the_load_fails(spark, tmp_path, monkeypatch):
    places = batch.Places.below(str(tmp_path / "root"))
    customers = source(spark, (1, "ada", dt.datetime(2024, 2, 20)))

    def fail(*args, **kwargs):
        raise RuntimeError("load failed")

    monkeypatch.setattr(batch, "load_orders", fail)
    with pytest.raises(RuntimeError, match="load failed"):
        batch.run_batch(spark, customers, places, "2024-03-01", NOW, NOW.date())
    assert get_watermark(ControlTable(spark, f"{places.state}/control")) is None


def test_unreadable_customers_are_kept_apart(spark, tmp_path):
    places = batch.Places.below(str(tmp_path / "root"))
    control = ControlTable(spark, f"{places.state}/control")
    raw = batch.create_raw_tables(spark, places.warehouse, control)
    folder = tmp_path / "root/lake/raw/crm/ds=2024-03-01"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text(
        '{"customer_id": 1, "customer_name": "ada"}\n{"customer_id": "x"}\n{"customer_name": "nokey"}\n')
    batch.load_crm(spark, raw["raw.crm_customers"], places, "2024-03-01", NOW)
    assert [r.customer_id for r in raw["raw.crm_customers"].read().collect()] == [1]
    rejected = raw["raw.crm_customers"].rejected().collect()
    assert sorted((r.load_error, r.rejected_row) for r in rejected) == [
        ("customer_id", '{"customer_name":"nokey"}'), ("not a readable customer", '{"customer_id": "x"}')]
