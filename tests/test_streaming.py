import datetime as dt
import json
from decimal import Decimal

from ordervane import checks
from ordervane.schemas import EVENT_TEXT
from ordervane.sources import lake
from ordervane.sources.event_streams import read_file_stream
from ordervane.sources.state import ControlTable
from ordervane.sources.tables import erp_orders_table
from ordervane.streaming import control, dedup, landing, orders

LOADED = dt.datetime(2024, 3, 2)


def event(number, kind="order_event", **changes):
    return json.dumps({
        "event_id": f"e{number}", "customer_id": 1, "product_id": "p", "quantity": number % 4 + 1,
        "price": 2.5, "timestamp": f"2024-03-01T00:00:{number % 60:02d}.000000", "event_type": kind, **changes,
    })


def send(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def land(spark, tmp_path, **options):
    stream = spark.readStream.text(str(tmp_path / "sent"))
    query = landing.land_events(stream, str(tmp_path / "lake"), str(tmp_path / "checkpoint"), once=True, **options)
    query.awaitTermination()
    return query


def counts(spark, tmp_path):
    rows = lake.read_landed(spark, str(tmp_path / "lake"), EVENT_TEXT, with_dead_letters=True).groupBy("route").count().collect()
    return {r.route: r["count"] for r in rows}


def test_landing_routes_everything_once(spark, tmp_path):
    sent = tmp_path / "sent"
    kinds = ["order_event", "order_event", "crm_data", "erp_data", "click"]
    send(sent, "a.txt", [event(i, kinds[i % 5]) for i in range(50)] + ["broken {"])
    land(spark, tmp_path)
    expected = {"order": 20, "crm": 10, "erp": 10, "events": 10, "dead_letter": 1}
    assert counts(spark, tmp_path) == expected
    land(spark, tmp_path)  # a restart reads nothing again
    assert counts(spark, tmp_path) == expected
    send(sent, "b.txt", [event(100, "crm_data")])
    land(spark, tmp_path)
    assert counts(spark, tmp_path) == {**expected, "crm": 11}
    letters = landing.read_dead_letters(spark, str(tmp_path / "lake")).collect()
    assert [(r.value, r.reason, r.topic, r.offset, r.replays) for r in letters] == [("broken {", "not a JSON object", None, None, 0)]


def test_landed_text_is_the_sent_text(spark, tmp_path):
    text = event(1, extra={"deep": [1, 2.50, "ü"]})
    send(tmp_path / "sent", "a.txt", [text])
    land(spark, tmp_path)
    stored = next((tmp_path / "lake/raw/landed/batches/route=order").glob("*/*/*/part-*")).read_text(encoding="utf-8")
    assert stored == text + "\n"


def test_only_the_route_read_is_scanned(spark, tmp_path):
    send(tmp_path / "sent", "a.txt", [event(1), event(2, "crm_data")])
    land(spark, tmp_path)
    rows = lake.read_landed(spark, str(tmp_path / "lake"), EVENT_TEXT, route="crm")
    assert [r.event_id for r in rows.collect()] == ["e2"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "batches/route=crm]" in plan  # the other routes are not listed either


def test_recent_landed_reads_the_newest_days_first(spark, tmp_path):
    def write(day, numbers):
        folder = tmp_path / f"lake/raw/landed/batches/route=order/landed_on={day}/query=q/batch=0"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text("\n".join(event(i) for i in numbers) + "\n")

    def seen(**options):
        rows = lake.recent_landed(spark, str(tmp_path / "lake"), EVENT_TEXT, today=dt.date(2024, 3, 1), **options)
        return rows, [r.event_id for r in rows.collect()]

    write("2020-01-01", range(10, 20))
    write("2024-02-28", range(20, 24))
    write("2024-03-01", range(30, 33))
    rows, ids = seen(limit=2, capacity=3)
    assert ids == ["e31", "e32"]
    assert "landed_on#" in rows._jdf.queryExecution().executedPlan().toString()
    assert {r.landed_on for r in rows.collect()} == {dt.date(2024, 3, 1)}
    assert seen(limit=0, capacity=7)[1] == [f"e{i}" for i in (20, 21, 22, 23, 30, 31, 32)]
    assert seen(limit=0, capacity=9)[1] == [f"e{i}" for i in (18, 19, 20, 21, 22, 23, 30, 31, 32)]
    assert len(seen(limit=0)[1]) == 17


def test_recent_landed_leaves_out_dead_letters(spark, tmp_path):
    for route, day, lines in (("dead_letter", "2024-03-01", ["broken {"] * 4), ("order", "2024-03-01", [event(9)]),
                              ("order", "2024-02-27", [event(i) for i in range(5)])):
        folder = tmp_path / f"lake/raw/landed/batches/route={route}/landed_on={day}/query=q/batch=0"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text("\n".join(lines) + "\n")
    rows = lake.recent_landed(spark, str(tmp_path / "lake"), EVENT_TEXT, limit=0, capacity=5, today=dt.date(2024, 3, 1))
    assert [r.event_id for r in rows.collect()] == ["e1", "e2", "e3", "e4", "e9"]


def test_a_retried_batch_replaces_its_folders(spark, tmp_path):
    from ordervane.sources.batch_folders import DAY
    from pyspark.sql import functions as F

    events = lake.landed_events(spark, str(tmp_path / "lake"))

    def write(numbers, batch, query="q", route="order"):
        rows = spark.createDataFrame([(event(i), route) for i in numbers], "value string, route string")
        events.write(rows.withColumn(DAY.name, F.lit("2024-03-01").cast("date")), query, batch)

    write(range(5), 0)
    write(range(5, 8), 1)
    write(range(5, 9), 1)
    write(range(20, 22), 1, "other")
    write([30], 1, route="crm")
    assert counts(spark, tmp_path) == {"order": 11, "crm": 1}
    assert not (tmp_path / "lake/raw/landed/batches/_spark_metadata").exists()


def test_closed_days_are_merged_and_nothing_is_lost_or_doubled(spark, tmp_path):
    from ordervane.sources.batch_folders import DAY
    from pyspark.sql import functions as F

    place = str(tmp_path / "lake")
    events = lake.landed_events(spark, place)

    def write(day, numbers, batch, route="order"):
        rows = spark.createDataFrame([(event(i), route) for i in numbers], "value string, route string").repartition(2)
        events.write(rows.withColumn(DAY.name, F.lit(day).cast("date")), "q", batch)

    def seen(**options):
        return sorted(int(r.event_id[1:]) for r in lake.read_landed(spark, place, EVENT_TEXT, **options).collect())

    def files(part):
        return len(list((tmp_path / "lake/raw/landed" / part).glob("**/part-*")))

    for batch in range(6):
        write("2024-03-01", range(10 * batch, 10 * batch + 5), batch)
        write("2024-03-01", [100 + batch], batch, "crm")
    write("2024-03-02", range(60, 63), 6)
    before = seen()
    assert files("batches") > 12
    assert lake.merge_landed_days(spark, place, dt.date(2024, 3, 2)) == 2
    assert seen() == before and files("batches") == 2 and files("merged") <= 8
    assert seen(route="crm") == [100 + i for i in range(6)]
    assert seen(since=dt.date(2024, 3, 2)) == [60, 61, 62]
    assert seen(route="order", since=dt.date(2024, 3, 1)) == [i for i in before if i < 100]
    # the last batch may be repeated, on an old day too, and is not merged before another one is there
    assert lake.merge_landed_days(spark, place, dt.date(2024, 3, 9)) == 0
    write("2024-03-02", range(60, 64), 6)
    assert seen() == [*[i for i in before if i < 63], 63, *[100 + i for i in range(6)]]
    write("2024-03-05", [70], 7)
    assert lake.merge_landed_days(spark, place, dt.date(2024, 3, 9)) == 1
    assert seen() == sorted([*before, 63, 70])
    assert files("batches") == 1


def test_a_merge_that_stopped_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    from ordervane.sources.batch_folders import DAY, BatchFolders
    from ordervane.sources.state import ControlTable
    from pyspark.sql import functions as F

    place = str(tmp_path / "lake")
    events = lake.landed_events(spark, place)
    for batch in range(3):
        rows = spark.createDataFrame([(event(batch), "order")], "value string, route string")
        events.write(rows.withColumn(DAY.name, F.lit("2024-03-01").cast("date")), "q", batch)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    for owner, step in ((ControlTable, "set"), (BatchFolders, "_delete_merged")):
        with monkeypatch.context() as patch:
            patch.setattr(owner, step, stop)
            try:
                lake.merge_landed_days(spark, place, dt.date(2024, 3, 9))
            except RuntimeError:
                pass
        assert counts(spark, tmp_path) == {"order": 3}
    lake.merge_landed_days(spark, place, dt.date(2024, 3, 9))
    assert counts(spark, tmp_path) == {"order": 3}


def test_dead_letters_keep_their_origin_and_are_replayed_once(spark, tmp_path):
    from pyspark.sql import functions as F

    place = str(tmp_path / "lake")
    rows = [("{\"event_id\": \"a\"", "t", 1, 7), (None, "t", 2, 8), ("two\nlines", "t", 0, 9), (event(3), "t", 0, 10)]
    spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint").write.parquet(str(tmp_path / "sent"))
    stream = spark.readStream.schema("value string, topic string, partition int, offset bigint").parquet(str(tmp_path / "sent"))
    landing.land_events(stream, place, str(tmp_path / "checkpoint"), once=True).awaitTermination()

    def letters():
        found = landing.read_dead_letters(spark, place).collect()
        return sorted((r.offset, r.topic, r.partition, r.value, r.reason, r.replays) for r in found)

    first = [(7, "t", 1, rows[0][0], "not a JSON object", 0), (8, "t", 2, None, "no text", 0), (9, "t", 0, "two\nlines", "not a JSON object", 0)]
    assert letters() == first
    for _ in range(2):
        landing.replay_dead_letters(spark, place, str(tmp_path / "replay"), lambda df: df.withColumn(
            "value", F.when(F.col("value").startswith("{"), F.concat("value", F.lit("}"))).otherwise(F.col("value")))).awaitTermination()
        assert counts(spark, tmp_path) == {"order": 1, "events": 1, "dead_letter": 5}
        again = [(8, "t", 2, None, "no text", 1), (9, "t", 0, "two\nlines", "not a JSON object", 1)]
        assert letters() == sorted(first + again, key=str)


def load(spark, tmp_path, table):
    stream = landing.read_landed_stream(spark, str(tmp_path / "lake"), "order")
    orders.stream_upsert_orders(
        stream, table, str(tmp_path / "orders-checkpoint"), once=True,
        loaded_at=lambda: LOADED,
    ).awaitTermination()


def test_landed_orders_reach_the_raw_table_once(spark, tmp_path):
    table = erp_orders_table(spark, str(tmp_path / "raw"), ControlTable(spark, str(tmp_path / "control")))
    send(tmp_path / "sent", "a.txt", [event(i) for i in range(20)] + [event(50, price="1e300")])
    land(spark, tmp_path)
    load(spark, tmp_path, table)
    assert table.read().count() == 20
    load(spark, tmp_path, table)
    assert table.read().count() == 20 and table.loads().count() == 21
    loads = {r.load_id for r in table.loads().select("load_id").distinct().collect()}
    assert len(loads) == 1 and loads.pop().endswith("-000000000000")
    bad = table.rejected().collect()
    assert [(r.order_id, r.load_error) for r in bad] == [("e50", "price")]
    assert json.loads(bad[0].rejected_row)["price"] == "1e300"
    send(tmp_path / "sent", "b.txt", [event(3, quantity=9), event(20)])
    land(spark, tmp_path)
    load(spark, tmp_path, table)
    rows = {r.order_id: r for r in table.read().collect()}
    assert len(rows) == 21
    assert (rows["e3"].quantity, rows["e3"].total_amount) == (9, Decimal("22.50"))
    assert rows["e3"].extracted_at == LOADED


def test_later_load_wins_over_event_time_when_load_times_differ(spark, tmp_path):
    table = erp_orders_table(spark, str(tmp_path / "raw"), ControlTable(spark, str(tmp_path / "control")))
    times = iter([LOADED, LOADED + dt.timedelta(hours=6)])
    for name, line in (("a.txt", event(7, timestamp="2024-03-01T10:00:00")),
                       ("b.txt", event(7, timestamp="2024-03-01T09:00:00", quantity=8))):
        send(tmp_path / "sent", name, [line])
        land(spark, tmp_path)
        orders.stream_upsert_orders(
            landing.read_landed_stream(spark, str(tmp_path / "lake"), "order"), table,
            str(tmp_path / "orders-checkpoint"), once=True,
            loaded_at=lambda: next(times),
        ).awaitTermination()
    assert [r.quantity for r in table.read().collect()] == [8]


EVENT = "event_id string, at timestamp_ntz, n int"


def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path):
    sent = tmp_path / "sent"

    def run():
        stream = read_file_stream(spark, str(sent), EVENT, max_files_per_trigger=1)
        once = dedup.dedup_events(stream, salts=4)
        (
            once.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True).start().awaitTermination()
        )

    def line(name, minute, n):
        return json.dumps({"event_id": name, "at": f"2024-03-01T10:{minute:02d}:00", "n": n})

    # one id holds most rows of the first files
    for part in range(3):
        send(sent, f"a{part}.json", [line("hot", i % 60, i) for i in range(40)] + [line(f"x{part}", 1, 0)])
    run()
    send(sent, "b.json", [line("hot", 5, 99), line("y", 30, 1), line("y", 31, 1)])
    run()
    send(sent, "c.json", [line("late", 0, 1).replace("T10", "T07"), line("x0", 59, 2)])
    run()
    seen = sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert seen == ["hot", "late", "x0", "x1", "x2", "y"]


def write_once(spark, tmp_path, sent, places=64):
    from ordervane.sources.batch_folders import DAY, BatchFolders
    from pyspark.sql import functions as F

    stream = read_file_stream(spark, str(sent), EVENT, max_files_per_trigger=1)
    out = BatchFolders(spark, str(tmp_path / "kept"), stream.schema, [])
    seen = dedup.SeenIds(spark, str(tmp_path / "seen"), places=places)

    def write(rows, query, number):
        out.write(rows.withColumn(DAY.name, F.lit("2024-03-01").cast("date")), query, number)

    days = iter(dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(99))
    dedup.write_distinct(stream, seen, write, str(tmp_path / "checkpoint"), once=True, today=lambda: next(days)).awaitTermination()
    return out, seen


def test_ids_on_disk_keep_repeats_out_however_late(spark, tmp_path):
    sent = tmp_path / "sent"

    def lines(*numbers):
        return [json.dumps({"event_id": f"x{i}", "at": "2024-03-01T10:00:00", "n": i}) for i in numbers]

    def ids(out):
        return sorted(int(r.event_id[1:]) for r in out.read().filter("event_id IS NOT NULL").collect())

    for part in range(4):  # each file repeats half of the one before, and some lines twice
        send(sent, f"a{part}.json", lines(*range(50 * part, 50 * part + 100), *range(50 * part, 50 * part + 10)))
    out, seen = write_once(spark, tmp_path, sent)
    assert ids(out) == list(range(250))
    assert seen.ids.read().count() == 250
    seen.merge_days(dt.date(2030, 1, 1))
    assert seen.ids.read().count() == 250 and seen.words.read().count() <= 4 * 64
    send(sent, "b.json", lines(0, 60, 120, 249, 300) + [json.dumps({"n": 1}), json.dumps({"n": 2})])
    out, seen = write_once(spark, tmp_path, sent)
    assert ids(out) == [*range(250), 300]
    assert out.read().filter("event_id IS NULL").count() == 1  # a missing id is a key as well


def test_a_batch_taken_again_does_not_count_its_own_ids(spark, tmp_path):
    seen = dedup.SeenIds(spark, str(tmp_path / "seen"))
    batch = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("a", "x", 3)], "event_id string, id string, hash int")
    for _ in range(2):
        fresh = seen.new_rows(batch, "q", 0)
        assert sorted((r.event_id, r.id) for r in fresh.collect()) == [("a", "x"), ("b", "y")]
        seen.add(fresh, "q", 0, dt.date(2024, 3, 1))
    assert seen.new_rows(batch, "q", 1).count() == 0
    assert seen.new_rows(batch, "other", 0).count() == 0


def test_a_new_reader_of_orders_gets_merged_days_too(spark, tmp_path):
    from ordervane.plans import batch

    places = batch.Places(str(tmp_path / "lake"), str(tmp_path / "warehouse"), str(tmp_path / "state"))
    for name, numbers in (("a.txt", range(5)), ("b.txt", range(5, 8)), ("c.txt", range(8, 10))):
        send(tmp_path / "sent", name, [event(i) for i in numbers])
        land(spark, tmp_path)
    assert lake.merge_landed_days(spark, places.lake, dt.date(2999, 1, 1)) == 1
    table = erp_orders_table(spark, places.warehouse, ControlTable(spark, str(tmp_path / "control")))
    for _ in range(2):
        batch.load_orders(spark, table, places, LOADED)
        assert table.read().count() == 10


def test_progress_is_kept_after_the_stream_ended(spark, tmp_path):
    import time

    kept = ControlTable(spark, str(tmp_path / "control"))
    listener = control.KeepProgress(kept)
    spark.streams.addListener(listener)
    try:
        send(tmp_path / "sent", "a.txt", [event(i) for i in range(7)])
        land(spark, tmp_path, name="kept-landing")
        for _ in range(100):
            if control.last_progress(kept, "kept-landing"):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    progress = control.last_progress(kept, "kept-landing")
    assert (progress["batch_id"], progress["input_rows"], progress["run_rows"]) == (0, 7, 7)
    assert progress["rows_per_second"] > 0 and "logOffset" in str(progress["offsets"][0]["end"])
    now = control.status(spark, "kept-landing", kept)
    assert (now["running"], now["batch_id"], now["input_rows"]) == (False, 0, 7) and now["offsets"] == progress["offsets"]


def test_requests_are_sent_or_rejected_once(spark, tmp_path):
    from ordervane.plans import sending

    good = json.dumps({"customer_id": 1, "product_id": "p", "quantity": 2, "price": 1.5})
    outbox = sending.FileOutbox(spark, str(tmp_path / "out"))
    calls = []

    def send_twice(messages, query, number):
        outbox(messages, query, number)
        calls.append((query, number))
        outbox(messages, query, number)  # as a batch taken again does

    def run():
        stream = spark.readStream.text(str(tmp_path / "sent"))
        sending.send_order_stream(stream, send_twice, outbox.rejects, str(tmp_path / "checkpoint"), LOADED, once=True).awaitTermination()

    send(tmp_path / "sent", "a.txt", [good, "{", json.dumps({"customer_id": 1})])
    run()
    run()
    send(tmp_path / "sent", "b.txt", [good])
    run()
    assert len(calls) == 2 and len({q for q, _ in calls}) == 1
    messages = [json.loads(r.value) for r in outbox.messages.read().collect()]
    assert [(m["customer_id"], m["status"], m["event_type"]) for m in messages] == [(1, "pending", "order_event")] * 2
    assert sorted(r.reject_reason for r in outbox.rejects.read().collect()) == ["not a JSON object", "product_id"]


def test_start_status_stop(spark, tmp_path):
    send(tmp_path / "sent", "a.txt", [event(1)])

    def launch():
        stream = spark.readStream.text(str(tmp_path / "sent"))
        return landing.land_events(stream, str(tmp_path / "lake"), str(tmp_path / "checkpoint"),
                                   name="landing-test", trigger="1 second")

    assert control.status(spark, "landing-test")["running"] is False
    assert control.start(spark, "landing-test", launch)["status"] == "started"
    assert control.start(spark, "landing-test", launch)["status"] == "already_running"
    control.running(spark, "landing-test").processAllAvailable()
    now = control.status(spark, "landing-test")
    assert now["running"] is True and now["batch_id"] is not None
    assert control.stop(spark, "landing-test")["status"] == "stopped"
    assert control.stop(spark, "landing-test")["status"] == "already_stopped"
    assert counts(spark, tmp_path) == {"order": 1}


def test_independent_readers_each_see_everything(spark, tmp_path):
    send(tmp_path / "sent", "a.txt", [event(i) for i in range(5)])
    for group in ("one", "two"):
        stream = spark.readStream.text(str(tmp_path / "sent"))
        landing.land_events(stream, str(tmp_path / group), str(tmp_path / f"{group}-checkpoint"),
                            once=True).awaitTermination()
        assert lake.read_landed(spark, str(tmp_path / group), EVENT_TEXT).count() == 5


def test_files_and_documents_of_the_checks_stay_bounded(spark):
    assert checks._sent_files(spark.range(1000)) == 6
    files = checks._sent_files(spark.range(10_000_000))
    assert files % 3 == 0 and 10_000_000 / files <= checks.SENT_ROWS
    assert checks._document_ids(100_000) == 100
    assert 36_000_000 / checks._document_ids(36_000_000) <= 1001
    assert checks._document_ids(10**9) == 50_000


def test_a_merge_sends_no_rows_to_the_task_of_their_query(spark, tmp_path, monkeypatch):
    """Rows meet the last batches by key, day and query; only names of batches are gathered by query."""
    send(tmp_path / "sent", "a.txt", [event(i) for i in range(20)])
    land(spark, tmp_path)
    send(tmp_path / "sent", "b.txt", [event(i) for i in range(20, 30)])
    land(spark, tmp_path)
    plans, place = [], lake.landed_events(spark, str(tmp_path / "lake"))

    def combined(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return rows

    place.combine = combined
    assert place.merge_days(dt.date(9999, 1, 1)) == 1
    assert plans[0].count("Join") == 1 and "Aggregate" not in plans[0]
    assert counts(spark, tmp_path) == {"order": 30}
