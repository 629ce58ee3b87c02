"""The registered queries: each operator over the whole sample tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import as_timestamp
from .operators import events as ev
from .operators import extract, merge, quality, rows
from .plans import batch, intermediate, layers, marts, sending, staging, warehouse
from .schemas import EVENT_TEXT, RAW_ERP_ORDERS
from .session import scratch_folder
from .sources import event_streams as streams
from .sources import lake
from .sources import sample_tables as sample
from .sources.batch_folders import DAY, BatchFolders
from .sources.state import ControlTable, get_watermark, set_watermark
from .sources.tables import KeyedTable, ModelTables, erp_orders_table
from .streaming import control, dedup, landing, orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Most events that a task sends to one file.
SENT_ROWS = 500_000
LINE_KEYS = ["l_orderkey", "l_linenumber"]
DATASET_KEYS = {"raw.crm_customers": "customer_id", "raw.erp_orders": "order_id", "stg_crm_customers": "customer_id",
                "stg_erp_orders": "order_id", "int_customer_metrics": "customer_id", "executive_dashboard": "metric_name"}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- models -----------------------------------------------------------------

@query
def stg_crm_customers(spark, folder):
    return staging.stg_crm_customers(sample.crm_customers(spark, folder), sample.AS_OF)


@query
def stg_erp_orders(spark, folder):
    return staging.stg_erp_orders(sample.erp_orders(spark, folder), with_calculated_total=True)


@query
def int_customer_cleaned(spark, folder):
    return intermediate.int_customer_cleaned(stg_crm_customers(spark, folder))


@query
def int_order_cleaned(spark, folder):
    return intermediate.int_order_cleaned(stg_erp_orders(spark, folder))


@query
def dim_customer(spark, folder):
    return warehouse.dim_customer(int_customer_cleaned(spark, folder))


@query
def fact_order(spark, folder):
    return warehouse.fact_order(int_order_cleaned(spark, folder))


@query
def dim_fact_left_join(spark, folder):
    return warehouse.dim_fact_left_join(dim_customer(spark, folder), fact_order(spark, folder))


def _metrics(spark, folder):
    return intermediate.int_customer_metrics(dim_customer(spark, folder), fact_order(spark, folder))


@query
def customer_metrics(spark, folder):
    return _metrics(spark, folder).withColumn(
        "avg_order_value", F.round("avg_order_value", 4).cast("decimal(28,4)")
    )


@query
def executive_dashboard(spark, folder):
    return marts.executive_dashboard(_metrics(spark, folder), sample.AS_OF)


@query
def executive_dashboard_strict_mask(spark, folder):
    return marts.executive_dashboard(_metrics(spark, folder), sample.AS_OF, strict_mask=True)


def _kpi(name: str) -> None:
    def run(spark, folder):
        return marts.kpi(_metrics(spark, folder), name, sample.AS_OF)

    run.__name__ = name
    query(run)


for _name in marts.KPIS:
    _kpi(_name)


def _stored_metrics(spark, folder) -> DataFrame:
    """The metrics as the written table they are in a run, for readers of several passes."""
    root = scratch_folder(spark, "metrics")
    tables = ModelTables(spark, root, ControlTable(spark, f"{root}/control"))
    return tables.materialize_table(_metrics(spark, folder), "marts", "int_customer_metrics")


@query
def kpi_union_all(spark, folder):
    metrics = _stored_metrics(spark, folder)
    return rows.union_all([marts.kpi(metrics, name, sample.AS_OF) for name in marts.KPIS])


@query
def order_flags(spark, folder):
    """The validity flags of all orders, before any is left out."""
    return sample.erp_orders(spark, folder).select(
        "order_id", *[flag.alias(name) for name, flag in staging.order_flags().items()])


@query
def customer_segments(spark, folder):
    return stg_crm_customers(spark, folder).groupBy("customer_segment").agg(F.count("*").alias("customers"))


@query
def order_categories(spark, folder):
    return stg_erp_orders(spark, folder).groupBy("order_category").agg(F.count("*").alias("orders"))


# --- data quality -----------------------------------------------------------

@query
def dq_unique(spark, folder):
    """Order lines repeating a line key, as a two-column key in one."""
    lines = sample.table(spark, folder, "lineitem").select(
        F.concat_ws("-", *LINE_KEYS).alias("line_key")
    )
    return quality.check_unique(lines, "line_key")


@query
def dq_not_null(spark, folder):
    return quality.check_not_null(sample.crm_customers(spark, folder), "email").select("customer_id", "city")


@query
def dq_accepted_range(spark, folder):
    failing = quality.check_accepted_range(sample.erp_orders(spark, folder), "total_amount", 100)
    return failing.select("order_id", "total_amount")


@query
def dq_relationship(spark, folder):
    """Orders of customers that are not in the dimension."""
    facts = fact_order(spark, folder)
    return quality.check_relationship(facts, "customer_id", dim_customer(spark, folder))


@query
def dq_relationship_count(spark, folder):
    return quality.count_orphans(fact_order(spark, folder), "customer_id", dim_customer(spark, folder))


@query
def dq_foreign_keys(spark, folder):
    """Lines without their part, order or supplier, counted per foreign key."""
    lines = sample.table(spark, folder, "lineitem")
    parents = (("l_partkey", "part", "p_partkey"), ("l_orderkey", "orders", "o_orderkey"),
               ("l_suppkey", "supplier", "s_suppkey"))
    return rows.union_all([
        quality.count_orphans(lines, child, sample.table(spark, folder, parent), key)
        .withColumn("foreign_key", F.lit(child))
        for child, parent, key in parents
    ])


@query
def dq_total_mismatch(spark, folder):
    failing = quality.check_total_mismatch(sample.erp_orders(spark, folder))
    return failing.select("order_id", "quantity", "unit_price", "total_amount")


def _datasets(spark, folder) -> dict[str, DataFrame]:
    """What the declared tests look at."""
    metrics = _stored_metrics(spark, folder)
    return {
        "raw.crm_customers": sample.crm_customers(spark, folder),
        "raw.erp_orders": sample.erp_orders(spark, folder),
        "stg_crm_customers": stg_crm_customers(spark, folder),
        "stg_erp_orders": stg_erp_orders(spark, folder),
        "int_customer_metrics": metrics,
        "executive_dashboard": marts.executive_dashboard(metrics, sample.AS_OF),
    }


@query
def dq_report(spark, folder):
    return quality.dq_report(_datasets(spark, folder))


# --- extract and merge --------------------------------------------------------

def _orders_as_source(spark, folder) -> DataFrame:
    return sample.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


@query
def incremental_extract(spark, folder):
    return extract.incremental_extract(
        _orders_as_source(spark, folder), "2001-06-01T00:00:00", status="F", ordered_by="id"
    )


@query
def high_water_mark(spark, folder):
    return extract.high_water_mark(incremental_extract(spark, folder))


@query
def watermark_state(spark, folder):
    """The mark of an extract, stored, read back and used by the next extract."""
    control = ControlTable(spark, scratch_folder(spark, "control"))
    found = high_water_mark(spark, folder).first()
    set_watermark(control, extract.next_mark(found["extract_count"], found["new_mark"]))
    return extract.incremental_extract(
        _orders_as_source(spark, folder), get_watermark(control), status="P"
    )


@query
def upsert_latest(spark, folder):
    """The latest line per line key."""
    return merge.latest_per_key(sample.table(spark, folder, "lineitem"), LINE_KEYS, ["l_shipdate"])


@query
def upsert_merge(spark, folder):
    """Returned lines merged over all lines."""
    lines = sample.table(spark, folder, "lineitem")
    target = merge.latest_per_key(lines, LINE_KEYS, ["l_shipdate"])
    returned = lines.filter(F.col("l_returnflag") == "R")
    return merge.upsert(target, returned, LINE_KEYS, ["l_shipdate"])


@query
def upsert_idempotent(spark, folder):
    """The lines loaded three times into a keyed table, folded in between."""
    lines = sample.table(spark, folder, "lineitem")
    root = scratch_folder(spark, "keyed")
    table = KeyedTable(spark, root, "lines", lines.schema, LINE_KEYS, ["l_shipdate"],
                       ControlTable(spark, f"{root}/control"))
    table.load(lines, "first")
    table.load(lines, "first")
    table.compact()
    table.load(lines, "second")
    return table.read()


# --- events -------------------------------------------------------------------

@query
def validate_events(spark, folder):
    validated = ev.validate_order_event(ev.parse_events(sample.faulty_messages(spark, folder)))
    return ev.valid_events(validated).select(
        "message_id", "event_id", "customer_id", "product_id", "quantity", "price", "timestamp", "event_type"
    )


@query
def dead_letter_events(spark, folder):
    validated = ev.validate_order_event(ev.parse_events(sample.faulty_messages(spark, folder)))
    return ev.dead_letters(validated, keep=["message_id"]).select("message_id", "reject_reason")


@query
def send_orders(spark, folder):
    """Order requests sent to files and read back, with the rejected ones beside them."""
    root = scratch_folder(spark, "sent")
    messages, rejects = sending.send_orders(sample.faulty_messages(spark, folder), "2024-02-01 08:30:00.25")
    messages.write.text(f"{root}/messages")
    rejects.write.parquet(f"{root}/rejects")
    return _sent(spark.read.text(f"{root}/messages"), spark.read.schema("value string, reject_reason string").parquet(f"{root}/rejects"))


def _sent(messages: DataFrame, rejects: DataFrame) -> DataFrame:
    sent = ev.parse_events(messages).select("event.*").select(*EVENT_TEXT.names, F.lit(None).cast("string").alias("reject_reason"))
    nothing = [F.lit(None).cast("string").alias(name) for name in EVENT_TEXT.names]
    return sent.unionByName(rejects.select(*nothing, "reject_reason"))


@query
def send_order_stream(spark, folder):
    """Order requests taken from a stream and sent to files, with the rejected ones beside them."""
    root = scratch_folder(spark, "sent")
    sample.faulty_messages(spark, folder).select("value").write.parquet(f"{root}/requests")
    requests = spark.readStream.schema("value string").option("maxFilesPerTrigger", 2).parquet(f"{root}/requests")
    outbox = sending.FileOutbox(spark, root)
    sending.send_order_stream(requests, outbox, outbox.rejects, f"{root}/checkpoint", "2024-02-01 08:30:00.25",
                              once=True).awaitTermination()
    return _sent(outbox.messages.read(), outbox.rejects.read())


def _document_ids(n_events: int) -> int:
    """Event ids to a document: a hundred, and more where there would be over a thousand documents, up to some MB of text."""
    return min(50_000, max(100, n_events // 1000))


@query
def load_order_documents(spark, folder):
    """Purchases lying as one JSON document per file, loaded into the raw orders."""
    root = scratch_folder(spark, "documents")
    events = sample.table(spark, folder, "events")
    messages = sample.order_events(events)
    purchases = messages.filter(F.col("event_type") == ev.ORDER_EVENT)
    # purchases of following event ids to a document, as an array; a row to a file, written by all tasks
    array = F.concat(F.lit("["), F.concat_ws(",", F.collect_list(ev.event_json(purchases))), F.lit("]"))
    file = F.floor(F.col("event_id").cast("bigint") / _document_ids(events.count()))
    spread = purchases.withColumn("file", file).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")
    documents = spread.groupBy("file").agg(array.alias("value")).select("value")
    documents.write.option("maxRecordsPerFile", 1).text(f"{root}/raw/order")
    table = erp_orders_table(spark, f"{root}/warehouse", ControlTable(spark, f"{root}/control"))
    batch.load_order_documents(spark, table, f"{root}/raw/order", dt.datetime(2024, 2, 1), "documents")
    return table.read()


@query
def enrich_order_event(spark, folder):
    sent = sample.order_events(sample.table(spark, folder, "events")).select(
        "event_id", "customer_id", "product_id", "quantity", "price",
        F.when(F.col("quantity") > 3, F.lit("")).when(F.col("quantity") > 1, F.col("timestamp"))
        .alias("order_date"),
        F.when(F.col("quantity") == 2, F.lit("paid")).alias("status"),
    )
    return ev.enrich_order_event(sent, "2024-02-01 08:30:00.25")


def _landed_text(events: DataFrame) -> DataFrame:
    """Order events as they are read back from the lake: all fields as text."""
    shaped = sample.order_events(events)
    return shaped.select(*[
        F.col(f.name).cast("string").alias(f.name) if f.name in shaped.columns
        else F.lit(None).cast("string").alias(f.name)
        for f in EVENT_TEXT.fields
    ])


@query
def order_event_mapping(spark, folder):
    """Purchases as raw orders."""
    events = _landed_text(sample.table(spark, folder, "events"))
    purchases = events.filter(F.col("event_type") == ev.ORDER_EVENT)
    return ev.loadable(ev.map_order_event(purchases, "2024-02-01 00:00:00"))


@query
def event_messages(spark, folder):
    """Events as they are sent."""
    return streams.event_messages(sample.order_events(sample.table(spark, folder, "events")))


@query
def order_key_hash(spark, folder):
    """Keys of events that carry no id."""
    events = _landed_text(sample.table(spark, folder, "events"))
    nameless = events.withColumn("event_id", F.lit(None).cast("string"))
    return ev.map_order_event(nameless, "2024-02-01 00:00:00").select("order_id", "order_date")


@query
def order_keys(spark, folder):
    """Orders by key, where some events have a blank id, and some an order id that is another's event id."""
    number = F.col("event_id").cast("bigint")
    events = _landed_text(sample.table(spark, folder, "events"))
    mixed = events.withColumns({
        "event_id": F.when(number % 4 == 0, "").when(number % 4 > 1, F.col("event_id")),
        "order_id": F.when(number % 8 == 4, (number + 2).cast("string")).when(number % 4 == 1, (number + 2).cast("string")),
    })
    mapped = ev.map_order_event(mixed, "2024-02-01 00:00:00")
    return merge.latest_per_key(mapped, ["order_id"], ["order_date"]).select("order_id", "customer_id", "order_date")


@query
def route_counts(spark, folder):
    messages = sample.order_events(sample.table(spark, folder, "events"))
    texts = messages.select(ev.event_json(messages).alias("value"))
    routed = ev.route_events(ev.parse_events(texts, fields=["event_type"]))
    return routed.groupBy("route").agg(F.count("*").alias("n_events"))


@query
def recent_events(spark, folder):
    events = sample.table(spark, folder, "events")
    return ev.recent_events(events, limit=0, order_by=("ts", "event_id"))


@query
def recent_total(spark, folder):
    return ev.recent_total(sample.table(spark, folder, "events"))


@query
def upsert_erp_orders(spark, folder):
    """Purchases merged over the signups and views, taken as orders of the same keys."""
    events = _landed_text(sample.table(spark, folder, "events")).withColumn(
        "event_id", F.concat_ws("-", "customer_id", "product_id")
    )
    purchase = F.col("event_type") == ev.ORDER_EVENT
    earlier = ev.loadable(ev.map_order_event(events.filter(~purchase), "2024-02-01 00:00:00"))
    target = merge.latest_per_key(earlier, ["order_id"], ["order_date"])
    return merge.upsert_erp_orders(target, events.filter(purchase), "2024-02-02 00:00:00")


@query
def upsert_crm_customers(spark, folder):
    """Newly created customers merged over all customers."""
    source = sample.crm_source(spark, folder).withColumnRenamed("id", "customer_id")
    target = rows.stamp_loaded_at(source, "2024-01-30 00:00:00").drop("created_at")
    batch_rows = extract.incremental_extract(source, "2024-01-20T00:00:00").withColumn("city", F.lit("moved"))
    return merge.upsert_crm_customers(target, batch_rows, "2024-01-31 00:00:00")


# --- streams ------------------------------------------------------------------

def _landed(spark, folder) -> tuple[str, str]:
    """Land all events by a stream; gives the lake and the folder around it."""
    root = scratch_folder(spark, "landing")
    messages = sample.order_events(sample.event_stream(spark, folder))
    texts = messages.select(ev.event_json(messages).alias("value"))
    landing.land_events(texts, f"{root}/lake", f"{root}/checkpoint", once=True).awaitTermination()
    return f"{root}/lake", root


def _typed_events(landed: DataFrame) -> DataFrame:
    return landed.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("customer_id").cast("int").alias("customer_id"),
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("price").cast("double").alias("price"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "event_type", "route",
    )


def _landed_with_faults(spark, folder) -> tuple[str, str]:
    """Land the faulty messages by a stream as if they came from a topic; gives the lake and the folder around it."""
    root = scratch_folder(spark, "faults")
    number = F.col("message_id")
    sample.faulty_messages(spark, folder).select(
        number.cast("bigint").alias("offset"), "value", F.lit(streams.EVENT_TOPIC).alias("topic"),
        (number.cast("bigint") % 3).cast("int").alias("partition"),
    ).write.parquet(f"{root}/sent")
    sent = spark.readStream.schema("offset bigint, value string, topic string, partition int").parquet(f"{root}/sent")
    landing.land_events(sent, f"{root}/lake", f"{root}/checkpoint", once=True).awaitTermination()
    return f"{root}/lake", root


@query
def landed_dead_letters(spark, folder):
    """The unreadable messages in the lake, with why and where they came from."""
    place, _ = _landed_with_faults(spark, folder)
    return landing.read_dead_letters(spark, place).drop(DAY.name)


@query
def replayed_dead_letters(spark, folder):
    """What the lake holds by route and replays after unreadable messages were mended and landed again, twice."""
    place, root = _landed_with_faults(spark, folder)

    def repair(letters: DataFrame) -> DataFrame:
        """Of texts that are cut off the event id stays; the others cannot be mended."""
        begun = F.regexp_extract("value", r'^\{"event_id":"\d+"', 0)
        return letters.withColumn("value", F.when(begun != "", F.concat(begun, F.lit("}"))).otherwise(F.col("value")))

    for _ in range(2):
        landing.replay_dead_letters(spark, place, f"{root}/replay", repair).awaitTermination()
    letters = landing.read_dead_letters(spark, place)
    landed = lake.read_landed(spark, place, EVENT_TEXT).select("route", F.lit(None).cast("int").alias("replays"))
    return landed.unionByName(letters.select(F.lit(ev.DEAD_LETTER_ROUTE).alias("route"), "replays")).groupBy("route", "replays").agg(
        F.count("*").alias("n_messages"))


@query
def recent_landed(spark, folder):
    """The newest of the landed events."""
    place, _ = _landed(spark, folder)
    return lake.recent_landed(spark, place, EVENT_TEXT, limit=25).select("event_id", "timestamp", "route")


@query
def land_events_stream(spark, folder):
    place, _ = _landed(spark, folder)
    return _typed_events(lake.read_landed(spark, place, EVENT_TEXT))


def _sent_files(events: DataFrame) -> int:
    """Number of files to send events in, three batches of equal numbers: no file, and no task, grows with the events."""
    return 3 * max(2, -(-events.count() // (3 * SENT_ROWS)))


@query
def merged_landed_days(spark, folder):
    """Events landed in several batches, and read after all days but what may be repeated were merged."""
    root = scratch_folder(spark, "merged")
    rows = sample.table(spark, folder, "events")
    events, files = sample.order_events(rows), _sent_files(rows)
    events.select(ev.event_json(events).alias("value")).repartition(files).write.text(f"{root}/sent")
    sent = streams.read_file_stream(spark, f"{root}/sent", "value string", "text", max_files_per_trigger=files // 3)
    landing.land_events(sent, f"{root}/lake", f"{root}/checkpoint", once=True).awaitTermination()
    lake.merge_landed_days(spark, f"{root}/lake", dt.date(9999, 1, 1))
    return _typed_events(lake.read_landed(spark, f"{root}/lake", EVENT_TEXT))


@query
def stream_progress(spark, folder):
    """Rows of a landing that has ended, as its kept progress tells them."""
    root = scratch_folder(spark, "progress")
    kept = ControlTable(spark, f"{root}/control")
    listener = control.KeepProgress(kept)
    spark.streams.addListener(listener)
    name = f"landing-{uuid.uuid4().hex}"
    try:
        messages = sample.order_events(sample.event_stream(spark, folder))
        landing.land_events(messages.select(ev.event_json(messages).alias("value")), f"{root}/lake", f"{root}/checkpoint",
                            name=name, once=True).awaitTermination()
        for _ in range(150):  # events reach listeners a little later
            if control.last_progress(kept, name):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    now = control.status(spark, name, kept)
    return spark.range(0, 1, 1, 1).select(
        F.lit(now["running"]).alias("running"), F.lit(control.last_progress(kept, name)["run_rows"]).cast("bigint").alias("run_rows"),
        F.lit(len(now["offsets"])).alias("sources"))


@query
def stream_upsert_orders(spark, folder):
    place, root = _landed(spark, folder)
    table = erp_orders_table(spark, f"{root}/warehouse", ControlTable(spark, f"{root}/control"))
    orders.stream_upsert_orders(
        landing.read_landed_stream(spark, place, "order"), table, f"{root}/orders-checkpoint",
        once=True, loaded_at=lambda: dt.datetime(2024, 2, 1),
    ).awaitTermination()
    return table.read()


@query
def dedup_events(spark, folder):
    """Every event sent twice over several micro-batches, in no order of time; each is kept once."""
    root = scratch_folder(spark, "dedup")
    events = sample.table(spark, folder, "events")
    sent = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    files = _sent_files(sent)
    sent.repartition(files, F.xxhash64("event_id", "copy")).drop("copy").write.parquet(f"{root}/sent")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files // 3).parquet(f"{root}/sent")
    kept = BatchFolders(spark, f"{root}/events", events.schema, [])

    def write(fresh: DataFrame, query_id: str, number: int) -> None:
        kept.write(fresh.withColumn(DAY.name, F.current_date()), query_id, number)

    dedup.write_distinct(stream, dedup.SeenIds(spark, f"{root}/seen"), write, f"{root}/checkpoint", once=True).awaitTermination()
    return kept.read().drop(DAY.name)


# --- lake ---------------------------------------------------------------------

@query
def snapshot_roundtrip(spark, folder):
    root = scratch_folder(spark, "snapshot")
    customers = sample.crm_customers(spark, folder)
    lake.write_lake_snapshot(customers, root, "crm", "2001-08-02")
    return lake.read_lake_snapshot(spark, root, "crm", "2001-08-02", customers.schema)


@query
def lake_prefix(spark, folder):
    """All days' snapshots below one prefix."""
    root = scratch_folder(spark, "prefix")
    shaped = sample.erp_orders(spark, folder)
    part = F.pmod(F.xxhash64("order_id"), F.lit(3))
    for number, ds in enumerate(("2001-08-01", "2001-08-02", "2001-08-03")):
        lake.write_lake_snapshot(shaped.filter(part == number), root, "erp", ds)
    return lake.read_lake_prefix(spark, f"{root}/raw/erp", RAW_ERP_ORDERS).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
        "status", "order_date",
    )


@query
def lake_listing(spark, folder):
    """The landed files by route: their bytes, whether they are the files read, and how many a cap leaves."""
    place, _ = _landed(spark, folder)
    files = lake.list_lake_objects(spark, place, max_items=None)
    path = F.regexp_replace("_metadata.file_path", r"^.*/(raw/)", "$1")
    read = spark.read.text(lake.landed_events(spark, place).batches_path).select(path.alias("read")).distinct()
    both = files.join(read, F.col("name") == F.col("read"), "full")
    name = F.coalesce("name", "read")
    capped = lake.object_count(lake.list_lake_objects(spark, place, "raw/landed", max_items=2)).first()["object_count"]
    return both.groupBy(F.regexp_extract(name, r"^raw/landed/batches/route=(\w+)/landed_on=", 1).alias("route")).agg(
        F.sum("size").alias("total_bytes"), F.bool_and(F.col("name").isNotNull() & F.col("read").isNotNull()).alias("same_names"),
        (F.min("last_modified") <= F.current_timestamp()).alias("in_the_past"), F.lit(capped).cast("bigint").alias("capped"),
    )


@query
def lake_objects(spark, folder):
    """A snapshot's files read one by one, as an object each."""
    root = scratch_folder(spark, "objects")
    customers = sample.crm_customers(spark, folder)
    lake.write_lake_snapshot(customers.repartition(3), root, "crm", "2001-08-02")
    names = [r["name"] for r in lake.list_lake_objects(spark, root, "raw/crm").collect()]
    return rows.union_all([lake.read_lake_object(spark, f"{root}/{name}", customers.schema, documents=False) for name in names])


# --- source tables --------------------------------------------------------------

@query
def inventory_available(spark, folder):
    stock = sample.erp_inventory(spark, folder).na.fill(0, ["quantity_reserved"])
    return rows.add_quantity_available(stock)


@query
def column_defaults(spark, folder):
    return rows.fill_defaults(sample.crm_sales(spark, folder), "crm.sales", "2001-08-02 00:00:00", fill_nulls=True)


def _omitted(name: str, table: str, columns) -> None:
    """A query that inserts without the columns that have defaults; given nulls stay."""
    def run(spark, folder):
        return rows.fill_defaults(columns(spark, folder), table, "2001-08-02 00:00:00")

    run.__name__ = name
    query(run)


_omitted("customer_defaults", "crm.customers", lambda spark, folder: sample.table(spark, folder, "customer").select(
    F.col("c_custkey").alias("customer_id"),
    F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("customer_type")))
_omitted("product_defaults", "erp.products", lambda spark, folder: sample.table(spark, folder, "part").select(
    F.col("p_partkey").alias("product_id")))
_omitted("inventory_defaults", "erp.inventory", lambda spark, folder: sample.erp_inventory(spark, folder).select(
    "product_id", "quantity_on_hand"))


# --- runs -----------------------------------------------------------------------

@query
def run_layers(spark, folder):
    """All layers built as tables and views; the dashboard table as read back."""
    root = scratch_folder(spark, "layers")
    raw = {
        "raw.crm_customers": sample.crm_customers(spark, folder),
        "raw.erp_orders": sample.erp_orders(spark, folder),
    }
    tables = ModelTables(spark, root, ControlTable(spark, f"{root}/control"))
    run = layers.ModelRun(spark, raw, tables, sample.AS_OF)
    result = layers.run_layers(run, with_tests=False)
    if result["status"] != "completed":
        raise RuntimeError(str(result))
    return tables.read_table("marts", "executive_dashboard")


def _stored_view(name: str) -> None:
    """A view model, stored over stored raw tables, as any session of the catalog selects it."""
    def run(spark, folder):
        root = scratch_folder(spark, "views")
        tables = ModelTables(spark, root, ControlTable(spark, f"{root}/control"))
        raw, stored = {"raw.crm_customers": sample.crm_customers(spark, folder), "raw.erp_orders": sample.erp_orders(spark, folder)}, {}
        for source, rows_ in raw.items():
            layer, table = source.split(".")
            rows_.write.parquet(f"{root}/{table}")
            stored[source] = tables.register(layer, table, f"{root}/{table}", rows_.schema)
        model_run = layers.ModelRun(spark, raw, tables, sample.AS_OF, stored=stored)
        for layer in ("staging", "intermediate"):
            result = layers.run_layer(model_run, layer, select=list(layers.VIEWS))
            if result["status"] != "success":
                raise RuntimeError(str(result))
        spark.newSession().table(model_run.stored_name(name))
        return spark.table(model_run.stored_name(name))

    run.__name__ = f"stored_{name}"
    query(run)


for _name in ("stg_crm_customers", "int_customer_cleaned", "int_order_cleaned"):
    _stored_view(_name)


def _faulty_raw(spark, folder) -> dict[str, DataFrame]:
    """The raw tables with repeated rows, and amounts that are missing or negative."""
    customers, orders = sample.crm_customers(spark, folder), sample.erp_orders(spark, folder)
    number = F.col("order_id").cast("bigint")

    def spoilt(column: str, missing: int, negative: int):
        kept = F.when(number % negative == 0, F.lit(-1)).otherwise(F.col(column))
        return F.when(number % missing != 0, kept).cast(orders.schema[column].dataType)

    faulty = orders.withColumns({"quantity": spoilt("quantity", 31, 37), "unit_price": spoilt("unit_price", 41, 43),
                                 "total_amount": spoilt("total_amount", 47, 53)})
    return {"raw.crm_customers": customers.unionByName(customers.filter("customer_id % 29 = 0")),
            "raw.erp_orders": faulty.unionByName(faulty.filter(number % 23 == 0))}


@query
def dq_stored_failures(spark, folder):
    """The stored failing rows of all declared tests: key and value, or value and count of repeated ones."""
    root = scratch_folder(spark, "tests")
    run = layers.ModelRun(
        spark, _faulty_raw(spark, folder), ModelTables(spark, root, ControlTable(spark, f"{root}/control")), sample.AS_OF
    )
    result = layers.run_layers(run)
    if result["stages"]["tests"]["error"]:
        raise RuntimeError(str(result))

    def stored(test: quality.DataTest) -> DataFrame:
        kept = spark.read.parquet(f"{root}/test_results/{test.name}")
        unique = test.kind == quality.UNIQUE
        return kept.select(
            F.lit(test.name).alias("test_name"), (F.lit(None) if unique else F.col(DATASET_KEYS[test.dataset])).cast("string").alias("row_key"),
            F.col(test.column).cast("string").alias("value"),
            (F.col("n_records") if unique else F.lit(None)).cast("bigint").alias("n_records"))

    return rows.union_all([stored(test) for test in quality.DECLARED_TESTS])


@query
def run_batch(spark, folder):
    """Customers extracted, events landed, both loaded, all models run."""
    place, root = _landed(spark, folder)
    places = batch.Places(place, f"{root}/warehouse", f"{root}/state")
    moment = dt.datetime(2024, 1, 31, 18)
    result = batch.run_batch(
        spark, sample.crm_source(spark, folder), places, "2024-01-31",
        now=moment, as_of=sample.EVENTS_AS_OF,
    )
    if result["status"] != "completed":
        raise RuntimeError(str(result))
    tables = ModelTables(spark, places.warehouse, ControlTable(spark, f"{places.state}/control"))
    mark = as_timestamp(result["watermark"])
    return tables.read_table("marts", "executive_dashboard").withColumn("watermark", mark)
