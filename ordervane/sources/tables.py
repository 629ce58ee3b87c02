"""Tables in the lake: keyed raw tables and fully refreshed model tables."""

from __future__ import annotations

import zlib
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from ..operators.merge import latest_per_key, upsert
from ..schemas import RAW_CRM_CUSTOMERS, RAW_ERP_ORDERS
from .state import ControlTable, delete_folder, names_below, path_exists, qualified

# Columns a load keeps next to the table's own.
LOAD_FIELDS = [
    StructField("load_order", TimestampNTZType(), True),
    StructField("load_error", StringType(), True),
    StructField("rejected_row", StringType(), True),
    StructField("load_id", StringType(), True),
    StructField("rejected", BooleanType(), True),
]

LISTED = StructType([StructField("load_id", StringType(), True), StructField("generation", IntegerType(), True)])


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0, 0, 1, 1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


class KeyedTable:
    """A raw table loaded by insert-or-update on its keys, on plain Parquet.

    Every load is appended as a folder of its own, in one pass and without a
    shuffle; a repeated load replaces its own folder. Rows that do not fit lie
    beside the others in that folder. A load counts from when its ``_SUCCESS`` file is
    there, which Spark writes after it has moved the last of the load's files; a load that is
    being written, or moved, is neither read nor folded. Reading takes the row loaded last for
    each key.

    ``compact`` folds the loads it finds into one table, lists their names beside it and
    keeps their rejected rows apart; then the pointer moves. What is not listed counts as not
    folded, so loads that end while it runs are not lost. A generation stays until the next but
    one is there, for those still reading it, and so do the loads it needs: loads listed two
    generations ago are deleted. Names stay listed, so a folded load can't come back when it is
    repeated. Where the catalog has transactional tables, use ``merge_into``.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, schema: StructType,
                 keys: list[str], order_by: list[str], control: ControlTable):
        self.spark = spark
        self.name = name
        self.schema = schema
        self.keys = keys
        self.order_by = order_by
        self.control = control
        self.path = f"{root.rstrip('/')}/{name}"

    def _generation(self) -> int:
        return int(self.control.get(f"{self.name}.generation", "0"))

    @property
    def _loads_path(self) -> str:
        return f"{self.path}/loads"

    def _load_path(self, load_id: str) -> str:
        return f"{self._loads_path}/load_id={quote(load_id, safe=' ')}"

    @property
    def _names_path(self) -> str:
        return f"{self.path}/names"

    @property
    def _rejected_path(self) -> str:
        return f"{self.path}/rejected"

    @property
    def _rejected_columns(self) -> list[str]:
        return [*self.schema.names, "load_error", "rejected_row", "load_id"]

    def create(self) -> None:
        """Create the table empty unless it is there."""
        if not path_exists(self.spark, self._loads_path):
            self.load(empty_frame(self.spark, self.schema), "created")

    def load(self, batch: DataFrame, load_id: str, load_order: Column | None = None) -> None:
        """Append ``batch``; ``load_order`` ranks rows of one key within it.

        Rows with a ``load_error``, or without a key, are kept as rejected. A load that
        has been folded stays as it was when it is repeated.
        """
        no_text = F.lit(None).cast("string")
        error = F.col("load_error") if "load_error" in batch.columns else no_text
        text = F.col("rejected_row") if "rejected_row" in batch.columns else no_text
        error = F.coalesce(error, *[F.when(F.col(k).isNull(), F.lit(k)) for k in self.keys])
        order = load_order if load_order is not None else F.lit(None)
        (
            batch.select(
                *self.schema.names,
                order.cast("timestamp_ntz").alias("load_order"),
                error.alias("load_error"),
                F.when(error.isNotNull(), text).alias("rejected_row"),
                error.isNotNull().alias("rejected"),
            )
            .write.mode("overwrite").partitionBy("rejected")
            .parquet(self._load_path(load_id))
        )

    def _finished(self) -> list[str]:
        """The names of all loads that are whole and not deleted yet."""
        found = names_below(self.spark, self._loads_path, "load_id=*/_SUCCESS", depth=2)
        return [unquote(name.split("/")[0].removeprefix("load_id=")) for name in found]

    def _rows_of(self, names: list[str]) -> DataFrame:
        schema = StructType(self.schema.fields + LOAD_FIELDS)
        if not names:
            return empty_frame(self.spark, schema)
        paths = [self._load_path(name) for name in names]
        return self.spark.read.schema(schema).option("basePath", self._loads_path).parquet(*paths)

    def _listed(self, up_to: int) -> DataFrame:
        """The names of loads folded in generations up to this one."""
        if up_to < 1:
            return empty_frame(self.spark, LISTED)
        return self.spark.read.schema(LISTED).parquet(self._names_path).filter(F.col("generation") <= up_to)

    def _pending(self, generation: int) -> list[str]:
        """The whole loads that are not folded yet. Only names on both sides meet, those still on disk."""
        finished = self._finished()
        if not generation or not finished:
            return finished
        there = self.spark.createDataFrame([(name,) for name in finished], "load_id string")
        return sorted(r["load_id"] for r in there.join(self._listed(generation), "load_id", "left_anti").collect())

    def loads(self) -> DataFrame:
        """All rows loaded since the last ``compact``, rejected ones too."""
        return self._rows_of(self._pending(self._generation()))

    def rejected(self) -> DataFrame:
        """The rejected rows of all loads ever."""
        generation = self._generation()
        rows = self._rows_of(self._pending(generation)).filter("rejected").select(*self._rejected_columns)
        if not generation:
            return rows
        schema = StructType([f for f in self.schema.fields + LOAD_FIELDS if f.name in self._rejected_columns]
                            + [StructField("generation", IntegerType(), True)])
        kept = self.spark.read.schema(schema).parquet(self._rejected_path).filter(F.col("generation") <= generation)
        return rows.unionByName(kept.select(*self._rejected_columns))

    def read(self) -> DataFrame:
        """The current rows: folded ones, with later loads merged over them."""
        generation = self._generation()
        names = self._pending(generation)
        return self._merged(generation, self._rows_of(names)) if names else self._folded(generation)

    def _folded(self, generation: int) -> DataFrame:
        if not generation:
            return empty_frame(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self._folded_path(generation)}/rows")

    def _merged(self, generation: int, loads: DataFrame) -> DataFrame:
        columns = self.schema.names
        later = loads.filter("NOT rejected").select(*columns, "load_order")
        ranking = [*self.order_by, "load_order"]
        if not generation:
            return latest_per_key(later, self.keys, ranking).select(*columns)
        return upsert(self._folded(generation), later, self.keys, ranking)

    def folded_rows(self) -> str | None:
        """Where the rows folded last lie; None before the first ``compact``."""
        generation = self._generation()
        return f"{self._folded_path(generation)}/rows" if generation else None

    def _folded_path(self, generation: int) -> str:
        return f"{self.path}/folded/generation={generation}"

    def compact(self) -> None:
        """Fold all loads there are into one table; loads may go on meanwhile.

        Rows are written as the merge leaves them, so their number of files follows
        their size. Folds of one table must not run side by side.
        """
        generation = self._generation()
        names = self._pending(generation)
        if not names:
            return
        following = generation + 1
        loads = self._rows_of(names)
        self._merged(generation, loads).write.mode("overwrite").parquet(f"{self._folded_path(following)}/rows")
        rejected = loads.filter("rejected").select(*self._rejected_columns)
        rejected.write.mode("overwrite").parquet(f"{self._rejected_path}/generation={following}")
        listed = self.spark.createDataFrame([(name,) for name in names], "load_id string")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self._names_path}/generation={following}")
        self.control.set(f"{self.name}.generation", str(following))
        self._delete_older(following)

    def _delete_older(self, generation: int) -> None:
        """Delete the generation before the previous one, and the loads that were folded by then."""
        if generation < 3:
            return
        delete_folder(self.spark, self._folded_path(generation - 2))
        there = self.spark.createDataFrame([(name,) for name in self._finished()], "load_id string")
        for row in there.join(self._listed(generation - 2), "load_id", "left_semi").collect():
            delete_folder(self.spark, self._load_path(row["load_id"]))


def crm_customers_table(spark: SparkSession, root: str, control: ControlTable) -> KeyedTable:
    return KeyedTable(spark, root, "raw.crm_customers", RAW_CRM_CUSTOMERS,
                      ["customer_id"], ["extracted_at"], control)


def erp_orders_table(spark: SparkSession, root: str, control: ControlTable) -> KeyedTable:
    return KeyedTable(spark, root, "raw.erp_orders", RAW_ERP_ORDERS,
                      ["order_id"], ["extracted_at", "order_date"], control)


def create_raw_tables(spark: SparkSession, root: str, control: ControlTable) -> dict[str, KeyedTable]:
    tables = [make(spark, root, control) for make in (crm_customers_table, erp_orders_table)]
    for table in tables:
        table.create()
    return {table.name: table for table in tables}


class ModelTables:
    """Model outputs: views, and tables as refreshed Parquet tables.

    A table has two folders. A refresh writes the one not in use and then moves
    the pointer, so readers keep the previous result until the new one is whole.
    The table is also registered in the catalog, in its layer's database, where a refresh only changes
    its location: it is there at any time. The database of a layer belongs to the root that made
    it; other roots get one with their own mark in its name (``database``).
    """

    def __init__(self, spark: SparkSession, root: str, control: ControlTable):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control = control

    def _path(self, layer: str, name: str, slot: str) -> str:
        return f"{self.root}/{layer}/{name}/slot={slot}"

    def database(self, layer: str) -> str:
        """The catalog's database of a layer of this root; it is made if it is not there."""
        place = qualified(self.spark, f"{self.root}/{layer}")
        own = f"{layer}_{zlib.crc32(place.encode()):08x}"
        for name in (layer, own):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
            if qualified(self.spark, self.spark.catalog.getDatabase(name).locationUri) == place:
                return name
        raise ValueError(f"the databases {layer} and {own} belong to other places than {place}")

    def table_name(self, layer: str, name: str) -> str:
        return f"`{self.database(layer)}`.`{name}`"

    def materialize_view(self, df: DataFrame, name: str) -> DataFrame:
        """A view of this session."""
        df.createOrReplaceTempView(name)
        return df

    def store_view(self, layer: str, name: str, sql: str) -> str:
        """A view in the layer's database, for all sessions that share the catalog; gives its name."""
        stored = self.table_name(layer, name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {stored} AS {sql}")
        return stored

    def materialize_table(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        key = f"{layer}.{name}.slot"
        slot = "b" if self.control.get(key) == "a" else "a"
        path = self._path(layer, name, slot)
        df.write.mode("overwrite").parquet(path)
        self.control.set(key, slot)
        self.register(layer, name, path, df.schema)
        return self.read_table(layer, name, df.schema)

    def read_table(self, layer: str, name: str, schema: StructType | None = None) -> DataFrame:
        slot = self.control.get(f"{layer}.{name}.slot")
        if slot is None:
            raise LookupError(f"{layer}.{name} has not been built")
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(self._path(layer, name, slot))

    def register(self, layer: str, name: str, path: str, schema: StructType) -> str:
        """Let the catalog's table show the files at ``path``; gives its name. Only a new schema makes a new entry."""
        stored = self.table_name(layer, name)
        if self.spark.catalog.tableExists(stored):
            columns = [(f.name, f.dataType) for f in self.spark.table(stored).schema]
            if columns == [(f.name, f.dataType) for f in schema]:
                self.spark.sql(f"ALTER TABLE {stored} SET LOCATION '{qualified(self.spark, path)}'")
                self.spark.catalog.refreshTable(stored)
                return stored
            self.spark.sql(f"DROP TABLE {stored}")
        self.spark.catalog.createTable(stored, path=path, source="parquet", schema=schema)
        return stored
