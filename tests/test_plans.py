"""Properties of the physical plans that the results alone do not show."""

import pathlib
import re

import pytest
from ordervane import checks, session
from ordervane.operators import events as ev

FOLDER = "/root/testdata/sf0.001"
STREAMS = {"land_events_stream", "recent_landed", "stream_upsert_orders", "dedup_events", "lake_listing", "run_batch",
           "run_layers", "dq_stored_failures", "upsert_idempotent", "watermark_state", "snapshot_roundtrip",
           "lake_prefix"}
PLAIN = [name for name in checks.QUERIES if name not in STREAMS]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(checks.QUERIES[name](spark, FOLDER))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in text


def test_dashboard_scans_each_input_once(spark):
    text = plan(checks.executive_dashboard(spark, FOLDER))
    assert len(re.findall(r"FileScan|Scan parquet", text)) == 2
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_orders_are_summed_before_they_are_shuffled_for_the_join(spark):
    text = plan(checks.customer_metrics(spark, FOLDER))
    assert "partial_sum(total_amount" in text
    assert text.index("Join") < text.index("partial_sum(total_amount")


def test_raw_filters_reach_the_scan(spark, tmp_path):
    import golden
    from ordervane.plans import intermediate, staging

    golden.orders(spark).write.parquet(str(tmp_path / "o"))
    rows = intermediate.int_order_cleaned(staging.stg_erp_orders(spark.read.parquet(str(tmp_path / "o"))))
    pushed = next(line for line in plan(rows).splitlines() if "PushedFilters" in line)
    for part in ("GreaterThan(quantity,0)", "IsNotNull(product_id)", "IsNotNull(customer_id)",
                 "GreaterThanOrEqual(total_amount,0"):
        assert part in pushed
    assert "status" not in pushed.split("ReadSchema")[1]


def test_json_is_parsed_once_per_row(spark):
    validated = ev.validate_order_event(ev.parse_events(spark.range(1).selectExpr("cast(id AS string) AS value")))
    assert plan(ev.valid_events(validated)).count("from_json(") == 1


def test_recent_events_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(checks.recent_events(spark, FOLDER).limit(100))
    assert "Exchange rangepartitioning" not in plan(ev.recent_events(
        spark.range(10).selectExpr("id AS timestamp", "id AS event_id"))).split("TakeOrdered")[-1]


def test_upsert_reads_both_sides_once(spark):
    from ordervane.operators import merge

    target = spark.range(1000).selectExpr("id AS k", "id AS v")
    text = plan(merge.upsert(target, spark.range(5).selectExpr("id AS k", "id AS v"), ["k"], ["v"]))
    assert "FullOuter" in text and text.count("Range (") == 2


def test_folded_rows_are_read_without_merging(spark, tmp_path):
    from ordervane.sources.state import ControlTable
    from ordervane.sources.tables import KeyedTable

    rows = spark.range(1000).selectExpr("id AS k", "id AS v")
    table = KeyedTable(spark, str(tmp_path), "t", rows.schema, ["k"], ["v"],
                       ControlTable(spark, str(tmp_path / "control")))
    table.load(rows, "a")
    assert "Exchange" in plan(table.read())
    table.compact()
    assert "Exchange" not in plan(table.read())
    table.load(rows.selectExpr("k", "v + 1 AS v"), "b")
    current = table.read()
    assert "FullOuter" in plan(current)
    assert sum(r.v for r in current.collect()) == sum(range(1, 1001))


def test_loading_does_not_shuffle(spark, tmp_path):
    from ordervane.sources.state import ControlTable
    from ordervane.sources.tables import erp_orders_table

    table = erp_orders_table(spark, str(tmp_path), ControlTable(spark, str(tmp_path / "control")))
    events = checks._landed_text(checks.sample.table(spark, FOLDER, "events"))
    mapped = ev.map_order_event(events, "2024-02-01")
    assert "Exchange" not in plan(mapped)
    table.load(mapped, "one")
    assert table.read().count() == events.count()


def test_scratch_lies_in_the_shared_folder(spark):
    folder = session.scratch_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_folder(spark, "x") != folder


def test_package_uses_no_udf_and_no_local_checkpoint():
    sources = pathlib.Path(checks.__file__).parent.rglob("*.py")
    text = "\n".join(path.read_text() for path in sources if path.parent.name != "llm")
    for word in ("udf(", "localCheckpoint", "mapInPandas", "applyInPandas", ".rdd", "toPandas", "broadcast("):
        assert word not in text
