"""The scheduled batch: extract customers, load the raw tables, run the models."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import utc_now
from ..operators.events import map_order_event
from ..operators.extract import incremental_extract, mark_columns, next_mark
from ..operators.rows import stamp_loaded_at
from ..schemas import CORRUPT_COLUMN, CRM_EXTRACT, EVENT_TEXT_WITH_CORRUPT
from ..sources.databases import crm_extract_columns
from ..sources.lake import landed_events, read_lake_prefix, read_lake_snapshot, replace_lake_snapshot, snapshot_path
from ..sources.state import ControlTable, get_watermark, path_exists, set_watermark
from ..sources.tables import KeyedTable, ModelTables, create_raw_tables
from ..streaming.landing import read_landed_stream
from ..streaming.orders import stream_upsert_orders
from .layers import ModelRun, run_layers


@dataclass(frozen=True)
class Places:
    """Where things lie. All folders must be reachable from every executor."""

    lake: str
    warehouse: str
    state: str

    @classmethod
    def below(cls, root: str) -> Places:
        root = root.rstrip("/")
        return cls(f"{root}/lake", f"{root}/warehouse", f"{root}/state")


def extract_crm(spark: SparkSession, source: DataFrame, places: Places, control: ControlTable,
                ds: str, now: dt.datetime) -> dict:
    """Snapshot the customers created since the mark.

    Count and new mark are observed while the snapshot is written: the source is queried
    once, and the snapshot is not read again. Without new rows an earlier
    snapshot of the day stays. The mark is returned, not stored yet.
    """
    extract = incremental_extract(crm_extract_columns(source), get_watermark(control), now)
    seen = Observation()
    observed = extract.observe(seen, *mark_columns())
    if not replace_lake_snapshot(observed, places.lake, "crm", ds, lambda: seen.get["extract_count"] > 0):
        return {"count": 0, "mark": None}
    return {"count": seen.get["extract_count"], "mark": next_mark(seen.get["extract_count"], seen.get["new_mark"], now)}


def load_crm(spark: SparkSession, table: KeyedTable, places: Places, ds: str,
             now: dt.datetime, documents: bool = False) -> None:
    """Load the day's customer snapshot. Rows that cannot be read, or lack a key, are kept apart.

    Every call is a load of its own: a repeated run may find fewer rows, as the
    mark has moved, and must not replace those found before.
    """
    if not path_exists(spark, snapshot_path(places.lake, "crm", ds)):
        return
    schema = StructType(CRM_EXTRACT.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    rows = read_lake_snapshot(spark, places.lake, "crm", ds, schema, documents)
    corrupt = F.col(CORRUPT_COLUMN)
    rows = (
        stamp_loaded_at(rows, now)
        .withColumn("load_error", F.when(corrupt.isNotNull(), "not a readable customer"))
        .withColumn("rejected_row", F.coalesce(corrupt, F.to_json(F.struct(*CRM_EXTRACT.names))))
    )
    table.load(rows, f"crm-{ds}-{uuid.uuid4().hex}", F.col("created_at"))


def load_orders(spark: SparkSession, table: KeyedTable, places: Places, now: dt.datetime,
                order_date_from: str = "timestamp") -> None:
    """Load the order events landed since the last load.

    The first load takes the days that have been merged by then; the stream sees new files only.
    """
    checkpoint = f"{places.state}/checkpoints/orders"
    landed = landed_events(spark, places.lake)
    if not path_exists(spark, checkpoint):
        merged = landed.read_merged(EVENT_TEXT_WITH_CORRUPT, "json", route="order").drop("route", "landed_on")
        if not merged.isEmpty():
            table.load(map_order_event(merged, now, order_date_from), "merged-days")
    if not path_exists(spark, f"{landed.batches_path}/route=order"):
        return
    stream_upsert_orders(
        read_landed_stream(spark, places.lake, "order"), table, checkpoint=checkpoint, once=True,
        order_date_from=order_date_from, loaded_at=lambda: now,
    ).awaitTermination()


def load_order_documents(spark: SparkSession, table: KeyedTable, prefix: str, now: dt.datetime,
                         load_id: str, order_date_from: str = "timestamp") -> None:
    """Load all order events below ``prefix`` that lie as one JSON object, or array, per file.

    Such files come from other writers than ``land_events``. A file that cannot be read is
    kept as a rejected row. The same ``load_id`` again replaces the load.
    """
    events = read_lake_prefix(spark, prefix, EVENT_TEXT_WITH_CORRUPT, documents=True)
    table.load(map_order_event(events, now, order_date_from), load_id)


def run_batch(spark: SparkSession, crm_source: DataFrame, places: Places, ds: str,
              now: dt.datetime | None = None, as_of: dt.date | None = None,
              with_tests: bool = False, order_date_from: str = "timestamp",
              compact: bool = True) -> dict:
    """One scheduled run for the day ``ds``; repeating it adds nothing.

    The mark moves only after the raw tables are loaded. ``compact`` folds the
    loads of the raw tables before the models read them: they are merged once, and
    the models and tests, about ten readers, take the rows as they are. Without it
    each of them merges anew. Folded raw tables are registered in the catalog, and the
    views over them are stored there.
    """
    now = now or utc_now()
    control = ControlTable(spark, f"{places.state}/control")
    raw = create_raw_tables(spark, places.warehouse, control)
    extracted = extract_crm(spark, crm_source, places, control, ds, now)
    load_crm(spark, raw["raw.crm_customers"], places, ds, now)
    load_orders(spark, raw["raw.erp_orders"], places, now, order_date_from)
    set_watermark(control, extracted["mark"])
    if compact:
        for table in raw.values():
            table.compact()
    tables = ModelTables(spark, places.warehouse, control)
    sources = {
        name: tables.materialize_view(table.read(), name.replace(".", "_")) for name, table in raw.items()
    }
    stored = {}
    if compact:
        stored = {name: tables.register("raw", name.split(".")[1], table.folded_rows(), table.schema) for name, table in raw.items()}
    run = ModelRun(spark, sources, tables, as_of or now.date(), stored=stored)
    result = run_layers(run, with_tests=with_tests)
    return {**result, "extracted": extracted["count"], "watermark": get_watermark(control)}
