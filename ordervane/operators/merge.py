"""Keyed merge: the latest row per key, and insert-or-update."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .events import loadable, map_order_event
from .rows import stamp_loaded_at


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One whole row per key: the greatest by ``order_by``, then by all other columns.

    It is a maximum over a struct, so each task reduces its rows to one per key
    before the shuffle. A key with very many copies sends one row per task.
    Nulls sort lowest. Ties are full duplicates, so the result is deterministic.
    """
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_newest"))
    return newest.select(
        *[F.col(c) if c in keys else F.col("_newest").getField(c).alias(c) for c in df.columns]
    )


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted or replaced by key.

    ``target`` holds each key once. Within ``batch`` the latest row of a key
    wins; ``order_by`` may use columns only the batch has. Both sides are read once: they are
    matched in one full join, whose rows come from the batch where it has the key. Keys that
    are null match as equal ones do.
    """
    extra = [c for c in order_by if c not in target.columns]
    newest = latest_per_key(batch.select(*target.columns, *extra), keys, order_by)
    old = target.select(F.struct(*target.columns).alias("old"))
    new = newest.select(F.struct(*target.columns).alias("new"))
    same_key = F.lit(True)
    for name in keys:
        same_key &= F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    return old.join(new, same_key, "full").select(F.coalesce("new", "old").alias("row")).select("row.*")


def merge_into(batch: DataFrame, table: str, keys: list[str], order_by: list[str]) -> None:
    """The same merge by ``MERGE INTO``, for catalogs whose tables support it.

    Preferable for large tables: only the files holding matched keys are rewritten.
    """
    spark = batch.sparkSession
    columns = spark.table(table).columns
    newest = latest_per_key(batch.select(*columns), keys, order_by).alias("batch")
    matches = " AND ".join(f"{table}.`{k}` = batch.`{k}`" for k in keys)
    (
        newest.mergeInto(table, F.expr(matches))
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )


def upsert_crm_customers(target: DataFrame, batch: DataFrame, loaded_at=None) -> DataFrame:
    """The raw customers with an extract merged in, stamped with the load time."""
    return upsert(target, stamp_loaded_at(batch, loaded_at), ["customer_id"], ["created_at"])


def upsert_erp_orders(target: DataFrame, events: DataFrame, loaded_at=None,
                      order_date_from: str = "timestamp") -> DataFrame:
    """The raw orders with landed order events merged in; events that do not fit are left out."""
    mapped = loadable(map_order_event(events, loaded_at, order_date_from))
    return upsert(target, mapped, ["order_id"], ["order_date"])
