import datetime as dt
import json

import golden
import pytest
from ordervane.schemas import CRM_EXTRACT, EVENT_TEXT
from ordervane.sources import databases, lake
from ordervane.sources.state import ControlTable, get_watermark, set_watermark
from ordervane.sources.tables import KeyedTable, ModelTables, create_raw_tables


def extract(spark, *ids, created=dt.datetime(2024, 3, 1, 1, 2, 3, 456)):
    rows = [(i, f"İnci {i}", None, None, "Ankara", "active", dt.date(2024, 1, 2), created) for i in ids]
    return golden.frame(spark, rows, CRM_EXTRACT)


def test_snapshot_is_replaced_and_read_back(spark, tmp_path):
    root = str(tmp_path)
    lake.write_lake_snapshot(extract(spark, 1, 2), root, "crm", "2024-03-01")
    lake.write_lake_snapshot(extract(spark, 3), root, "crm", "2024-03-01")
    lake.write_lake_snapshot(extract(spark, 4), root, "crm", "2024-03-02")
    rows = lake.read_lake_snapshot(spark, root, "crm", "2024-03-01", CRM_EXTRACT).collect()
    assert rows == extract(spark, 3).collect()
    path = next((tmp_path / "raw/crm/ds=2024-03-01").glob("part-*"))
    stored = json.loads(path.read_text(encoding="utf-8"))
    assert list(stored) == CRM_EXTRACT.names and stored["customer_name"] == "İnci 3"


def test_objects_and_arrays_are_both_read(spark, tmp_path):
    (tmp_path / "in" / "deeper").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text(json.dumps({"event_id": "1"}, indent=2))
    (tmp_path / "in" / "deeper" / "b.json").write_text(json.dumps([{"event_id": "2"}, {"event_id": "3"}], indent=2))
    rows = lake.read_lake_prefix(spark, str(tmp_path / "in"), EVENT_TEXT, documents=True)
    assert sorted(r.event_id for r in rows.collect()) == ["1", "2", "3"]
    one = lake.read_lake_object(spark, str(tmp_path / "in" / "a.json"), EVENT_TEXT)
    assert [r.event_id for r in one.collect()] == ["1"]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "c.json").write_text('{"event_id": "4"}\n[{"event_id": "5"}, {"event_id": "6"}]\n')
    rows = lake.read_lake_prefix(spark, str(tmp_path / "lines"), EVENT_TEXT)
    assert sorted(r.event_id for r in rows.collect()) == ["4", "5", "6"]


def test_listing(spark, tmp_path):
    for name in ("raw/crm/b.json", "raw/crm/a.json", "raw/order/c.json", "other/d.json"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{}")
    rows = lake.list_lake_objects(spark, str(tmp_path)).collect()
    assert [(r.name, r.size) for r in rows] == [
        ("raw/crm/a.json", 2), ("raw/crm/b.json", 2), ("raw/order/c.json", 2)]
    assert all(r.last_modified is not None for r in rows)
    assert lake.list_lake_objects(spark, str(tmp_path), max_items=2).count() == 2
    assert lake.list_lake_objects(spark, str(tmp_path), prefix="raw/order/").first().name == "raw/order/c.json"
    assert lake.list_lake_objects(spark, str(tmp_path), prefix="none/").count() == 0
    assert lake.object_count(lake.list_lake_objects(spark, str(tmp_path), "")).first().object_count == 4


@pytest.mark.parametrize("root, path", [
    ("/d/raw-zone/lake", "file:/d/raw-zone/lake/raw/a.json"),
    ("file:///d/lake", "file:/d/lake/raw/a.json"),
    ("s3a://orders/orders", "s3a://orders/orders/raw/a.json"),
    ("hdfs:///lake", "hdfs://name:8020/lake/raw/a.json"),
    ("s3a://bucket", "s3a://bucket/raw/a.json"),
])
def test_names_are_relative_to_the_lake(spark, root, path):
    from pyspark.sql import functions as F

    name = F.regexp_replace(F.lit(path), lake._leading(root), "")
    assert spark.range(1).select(name.alias("name")).first().name == "raw/a.json"


def test_listing_is_done_by_tasks_and_agrees_with_sparks_own(spark, tmp_path):
    for i in range(40):
        path = tmp_path / f"raw/k{i % 9}/d={i % 5}/{'_tmp' if i == 3 else 'q'}/{'.' if i == 4 else ''}f{i}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * (i + 1))  # Spark's readers pass over empty files
    (tmp_path / "raw" / "top.json").write_text("12")
    rows = lake.list_lake_objects(spark, str(tmp_path), max_items=None)
    own = lake._driver_listing(spark, str(tmp_path), "raw/")
    assert sorted(map(tuple, rows.select("name", "size").collect())) == sorted(map(tuple, own.select("name", "size").collect()))
    assert rows.count() == 39 and rows.rdd.getNumPartitions() > 9
    assert lake.list_lake_objects(spark, f"file://{tmp_path}").first().name == "raw/k0/d=0/q/f0.json"


def test_listing_splits_folders_among_tasks(spark, tmp_path, monkeypatch):
    from ordervane.sources import listing

    monkeypatch.setattr(listing, "FOLDERS", 4)
    for i in range(12):
        path = tmp_path / f"raw/a{i % 6}/b/f{i}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    reader = listing._Reader(str(tmp_path), "raw")
    parts = reader.partitions()
    assert [p.deep for p in parts] == [False] + [True] * 6
    names = [n for p in parts for batch in reader.read(p) for n in batch.column("name").to_pylist()]
    assert sorted(names) == sorted(f"raw/a{i % 6}/b/f{i}" for i in range(12))


def test_control_table(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    assert get_watermark(control) is None
    assert control.get("x", "default") == "default"
    set_watermark(control, "2024-03-01T00:00:00")
    set_watermark(control, None)
    assert get_watermark(control) == "2024-03-01T00:00:00"
    set_watermark(control, "2024-02-01T00:00:00")
    assert get_watermark(ControlTable(spark, str(tmp_path / "control"))) == "2024-02-01T00:00:00"


def test_replaced_values_leave_few_files(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    for i in range(9):
        control.replace("p", str(i))
    assert control.get("p") == "8"
    assert len(list((tmp_path / "control/key=p").glob("part-*"))) <= 5


SCHEMA = "k int not null, seq int, v string"


def keyed(spark, tmp_path):
    from pyspark.sql.types import StructType

    return KeyedTable(spark, str(tmp_path), "t", StructType.fromDDL(SCHEMA), ["k"], ["seq"],
                      ControlTable(spark, str(tmp_path / "control")))


def current(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_keyed_table(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert current(table) == []
    table.create()
    table.create()
    table.load(golden.frame(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, v string"), "l1")
    assert current(table) == [(1, 2, "b"), (2, 1, "c")]
    table.load(golden.frame(spark, [(2, 5, "d"), (None, 5, "lost")], "k int, seq int, v string"), "l2")
    table.load(golden.frame(spark, [(2, 5, "d"), (3, 1, "e")], "k int, seq int, v string"), "l2")
    expected = [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]
    assert current(table) == expected
    table.compact()
    assert current(keyed(spark, tmp_path)) == expected
    table.load(golden.frame(spark, [(3, 0, "later load wins"), (4, 1, "f")], "k int, seq int, v string"), "l3")
    assert current(table) == [(1, 2, "b"), (2, 5, "d"), (3, 0, "later load wins"), (4, 1, "f")]
    table.compact()
    assert current(table) == [(1, 2, "b"), (2, 5, "d"), (3, 0, "later load wins"), (4, 1, "f")]
    # the row without key was replaced with its load, before any folding
    assert table.rejected().count() == 0
    table.load(golden.frame(spark, [(None, 1, "keyless")], "k int, seq int, v string"), "l4")
    table.compact()
    assert [(r.v, r.load_error) for r in table.rejected().collect()] == [("keyless", "k")]
    assert table.loads().count() == 0 and len(current(table)) == 4


def test_loads_during_folding_are_kept_and_old_generations_go(spark, tmp_path, monkeypatch):
    table = keyed(spark, tmp_path)
    table.load(golden.frame(spark, [(1, 1, "a")], "k int, seq int, v string"), "l1")
    table.compact()
    merged, number = KeyedTable._merged, iter(range(2, 9))

    def slow(self, generation, loads):
        i = next(number)
        keyed(spark, tmp_path).load(golden.frame(spark, [(i, 1, "b")], "k int, seq int, v string"), f"l{i}")
        return merged(self, generation, loads)

    table.load(golden.frame(spark, [(0, 1, "z")], "k int, seq int, v string"), "l0")
    monkeypatch.setattr(KeyedTable, "_merged", slow)
    table.compact()
    table.compact()
    monkeypatch.undo()
    assert [r[0] for r in current(table)] == [0, 1, 2, 3]
    folders = sorted(p.name for p in (tmp_path / "t/folded").iterdir() if p.is_dir())
    assert folders == ["generation=2", "generation=3"]


def test_only_a_missing_path_means_empty(spark, tmp_path, monkeypatch):
    from ordervane.sources import batch_folders, state
    from pyspark.errors import AnalysisException

    monkeypatch.setattr(state, "is_missing_path", lambda error: False)
    monkeypatch.setattr(batch_folders, "is_missing_path", lambda error: False)
    monkeypatch.setattr(lake, "is_missing_path", lambda error: False)
    none = str(tmp_path / "none")
    for read in (lambda: ControlTable(spark, none).get("x"), lambda: state.path_exists(spark, none),
                 lambda: lake._driver_listing(spark, none, "raw/"), lambda: lake.read_landed(spark, none, EVENT_TEXT, route="order")):
        with pytest.raises(AnalysisException):
            read()


def test_a_load_that_is_being_moved_is_neither_read_nor_folded(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.load(golden.frame(spark, [(1, 1, "a")], "k int, seq int, v string"), "l1")
    ten = golden.frame(spark, [(i, 1, "b") for i in range(10, 20)], "k int, seq int, v string")
    table.load(ten.repartition(2), "l2")
    folder = tmp_path / "t/loads/load_id=l2"
    late = sorted(folder.glob("rejected=false/part-*"))[0]
    aside = [(p, p.read_bytes()) for p in (folder / "_SUCCESS", late)]
    for p, _ in aside:
        p.unlink()
    assert [r[0] for r in current(table)] == [1]
    table.compact()
    assert table.loads().count() == 0
    for p, content in reversed(aside):
        p.write_bytes(content)
    assert [r[0] for r in current(table)] == [1, *range(10, 20)]
    table.compact()
    assert [r[0] for r in current(table)] == [1, *range(10, 20)]


def test_folded_loads_are_deleted_and_do_not_come_back(spark, tmp_path):
    table = keyed(spark, tmp_path)

    def load(k, name, v="a"):
        table.load(golden.frame(spark, [(k, 1, v), (None, k, "keyless")], "k int, seq int, v string"), name)

    def there():
        return sorted(p.name for p in (tmp_path / "t/loads").iterdir() if p.is_dir())

    for i, name in enumerate(("l a/1", "l2", "l3", "l4")):
        load(i, name)
        table.compact()
    # what was folded two generations ago and before is gone
    assert there() == ["load_id=l3", "load_id=l4"]
    assert [r[0] for r in current(table)] == [0, 1, 2, 3]
    load(0, "l a/1", "again")
    assert (0, 1, "a") in current(table) and table.loads().count() == 0
    assert sorted(r.seq for r in table.rejected().collect()) == [0, 1, 2, 3]
    load(7, "l5")
    table.compact()
    assert there() == ["load_id=l4", "load_id=l5"] and len(current(table)) == 5
    assert sorted({r.load_id for r in table.rejected().collect()}) == ["l a/1", "l2", "l3", "l4", "l5"]


def test_raw_tables_are_created_once(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    tables = create_raw_tables(spark, str(tmp_path), control)
    assert set(tables) == {"raw.crm_customers", "raw.erp_orders"}
    assert tables["raw.erp_orders"].read().count() == 0
    row = (1, "a", "b", "c", "d", "e", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1))
    customers = tables["raw.crm_customers"]
    customers.load(golden.frame(spark, [row], golden.nullable(customers.schema)), "l")
    again = create_raw_tables(spark, str(tmp_path), control)["raw.crm_customers"]
    assert [tuple(r) for r in again.read().collect()] == [row]


def model_tables(spark, path):
    return ModelTables(spark, str(path), ControlTable(spark, str(path / "control")))


def test_model_table_swaps_and_registers(spark, tmp_path):
    tables = model_tables(spark, tmp_path)
    with pytest.raises(LookupError):
        tables.read_table("marts_test", "numbers")
    first = tables.materialize_table(spark.range(3), "marts_test", "numbers")
    second = tables.materialize_table(first.selectExpr("id + 1 AS id"), "marts_test", "numbers")
    name = tables.table_name("marts_test", "numbers")
    assert sorted(r.id for r in second.collect()) == [1, 2, 3]
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3]
    assert sorted(r.id for r in spark.newSession().table(name).collect()) == [1, 2, 3]
    assert sorted(r.id for r in first.collect()) == [0, 1, 2]  # the previous result stays readable
    tables.materialize_view(spark.range(2), "two")
    assert spark.table("two").count() == 2
    tables.materialize_table(spark.range(2).selectExpr("id", "'x' AS more"), "marts_test", "numbers")
    assert spark.table(name).columns == ["id", "more"]


def test_two_roots_have_their_own_entries(spark, tmp_path):
    one, two = model_tables(spark, tmp_path / "one"), model_tables(spark, tmp_path / "two")
    one.materialize_table(spark.range(3), "marts_roots", "numbers")
    two.materialize_table(spark.range(5), "marts_roots", "numbers")
    assert one.table_name("marts_roots", "numbers") == "`marts_roots`.`numbers`" != two.table_name("marts_roots", "numbers")
    assert [spark.table(t.table_name("marts_roots", "numbers")).count() for t in (one, two)] == [3, 5]
    assert model_tables(spark, tmp_path / "two").database("marts_roots") == two.database("marts_roots")


def test_readers_always_find_the_table_while_it_is_refreshed(spark, tmp_path):
    import threading

    tables = model_tables(spark, tmp_path)
    tables.materialize_table(spark.range(1), "marts_busy", "numbers")
    name, done, seen = tables.table_name("marts_busy", "numbers"), threading.Event(), []

    def read():
        session = spark.newSession()
        while not done.is_set():
            seen.append(session.catalog.tableExists(name) and len(session.table(name).columns))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 6):
        tables.materialize_table(spark.range(n), "marts_busy", "numbers")
    done.set()
    reader.join()
    assert len(seen) > 5 and set(seen) == {1}
    assert spark.table(name).count() == 5


def test_stored_views_are_seen_by_other_sessions(spark, tmp_path):
    tables = model_tables(spark, tmp_path)
    tables.materialize_table(spark.range(4), "views_test", "numbers")
    name = tables.store_view("views_test", "even", f"SELECT id FROM {tables.table_name('views_test', 'numbers')} WHERE id % 2 = 0")
    assert spark.newSession().table(name).count() == 2
    tables.materialize_table(spark.range(9), "views_test", "numbers")
    assert spark.newSession().table(name).count() == 5


def test_failed_refresh_keeps_the_last_result(spark, tmp_path):
    from pyspark.sql import functions as F

    tables = ModelTables(spark, str(tmp_path), ControlTable(spark, str(tmp_path / "control")))
    tables.materialize_table(spark.range(3), "marts_test", "kept")
    with pytest.raises(Exception, match="no good"):
        tables.materialize_table(
            spark.range(3).select(F.raise_error(F.lit("no good")).cast("bigint").alias("id")), "marts_test", "kept")
    assert tables.read_table("marts_test", "kept").count() == 3


def test_drop_rename_and_catalog_settings(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS scratch")
    databases.drop_table(spark, "scratch.a")
    databases.drop_table(spark, "scratch.b")
    spark.range(2).write.saveAsTable("scratch.a")
    databases.rename_table(spark, "scratch.a", "scratch.b")
    assert spark.table("scratch.b").count() == 2
    databases.drop_table(spark, "scratch.b")
    assert not spark.catalog.tableExists("scratch.b")
    databases.attach_jdbc_catalog(spark, "sales_db", "jdbc:postgresql://db/warehouse", "reader", "secret")
    assert spark.conf.get("spark.sql.catalog.sales_db").endswith("JDBCTableCatalog")
    assert spark.conf.get("spark.sql.catalog.sales_db.url") == "jdbc:postgresql://db/warehouse"
    assert databases.hive_settings("thrift://m:1")["spark.hadoop.hive.metastore.uris"] == "thrift://m:1"


def test_source_columns(spark):
    source = extract(spark, 1).withColumnRenamed("customer_id", "id")
    assert databases.crm_extract_columns(source).columns == CRM_EXTRACT.names
