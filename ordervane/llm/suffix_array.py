"""Removal of byte strings that occur elsewhere, by distributed prefix doubling.

Every byte is removed that a string of ``length`` bytes covers which also begins
anywhere else, in the same document or another one; occurrences may overlap, and
strings are judged on the input. Matches never cross documents.

Blocks of windows with a core of their own, or that recur as a whole, are settled by
their hashes (``repeats``), first in blocks of ``BLOCK`` windows, what is left of them
in blocks of ``SMALL_BLOCK``. The remaining windows, at the edges of repeated
passages, are ranked by prefix doubling: Spark sorts their quarters, numbers them in
order, then sorts pairs of ranks at twice the offset, and again, until the rank stands
for the whole window. A window with a unique rank on the way is dropped: it has no
equal.

Inputs and results, also for odd ones: a null text is empty; a text shorter than
``length`` keeps all. Rows repeated, with the same key or not, are occurrences of
their own and so remove each other. A row with null key keeps all and is no
occurrence. Texts of any length are read whole. Only the named columns are read,
further ones are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repeats import block_table, cut, settle, windows_of, with_texts
from .text_arrays import SpanHash, covered, slices, utf8_buffers

LENGTH = 200
#: Bytes of the hashed grams, windows of a block, and of a block of what is left.
GRAM, BLOCK, SMALL_BLOCK = 32, 64, 8


def _byte_codes(column: pa.Array) -> tuple[SpanHash, np.ndarray]:
    data, offsets = utf8_buffers(column)
    return SpanHash.of_bytes(data), offsets


def _stored(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _segments(docs: DataFrame, blocks: DataFrame, length: int, key: str, text: str) -> DataFrame:
    """The bytes of each different block that shares its core with others, at one of its places."""
    one = blocks.groupBy("core", "block").agg(
        F.min(F.struct("key", "start", "n", "lead")).alias("at"), F.max("times").alias("times")
    ).select("at.*", "times")

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8_buffers(part.column("text"))
                found = part.column("found")
                rows = found.flatten()
                text_of = np.repeat(np.arange(part.num_rows), np.diff(found.offsets.to_numpy()))
                begins = offsets[text_of] + rows.field("start").to_numpy()
                ends = begins + rows.field("n").to_numpy() + length - 1
                content = [data[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(text_of)), *(rows.field(f) for f in names),
                     pa.array(content, pa.binary())], ["key", *names, "content"])

    names = ["start", "n", "lead", "times"]
    texts = with_texts(docs, one, names, "inner", key, text)
    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(taken, f"key {kind}, start int, n int, lead int, times bigint, content binary")


def _small_blocks(segments: DataFrame, length: int) -> DataFrame:
    """The segments' windows as smaller blocks; ``at`` is the block's first byte in its segment."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 5000):
                part = batch.slice(begin, 5000)
                sizes = np.array([len(c) for c in part.column("content").to_pylist()], np.int64)
                data = np.frombuffer(b"".join(part.column("content").to_pylist()), np.uint8)
                first, n = np.cumsum(sizes) - sizes, part.column("n").to_numpy()
                of = np.repeat(np.arange(len(n)), n)
                starts = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                anchors = (first + part.column("lead").to_numpy())[of]
                start, count, core, block = cut(starts, anchors, SpanHash.of_bytes(data), length, SMALL_BLOCK)
                segment = np.searchsorted(first, start, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(segment)) for c in ("segment", "key", "start", "times")),
                     pa.array((start - first[segment]).astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(core.view(np.int64)), pa.array(block.view(np.int64))],
                    ["segment", "key", "start", "times", "at", "n", "core", "block"])

    kind = segments.schema["key"].dataType.simpleString()
    rows = segments.mapInArrow(found, f"segment bigint, key {kind}, start int, times bigint, at int, n int, "
                                      "core bigint, block bigint")
    by_core, by_block = Window.partitionBy("core"), Window.partitionBy("core", "block")
    return (rows.withColumn("low", F.min("block").over(by_core)).withColumn("high", F.max("block").over(by_core))
            .withColumn("all_times", F.sum("times").over(by_block))
            .withColumn("mixed", F.col("low") != F.col("high")).filter("mixed or all_times > 1").drop("low", "high"))


def _quarters(segments: DataFrame, small: DataFrame, length: int) -> DataFrame:
    """``key``, ``at``, ``times``, ``slot`` and ``code``: the four parts of each window still open.

    The parts of ``length``/4 bytes (rounded up) are two neighbours from the window's
    begin and two up to its end.
    """
    size = -(-length // 4)
    slots = np.array([0, size, length - 2 * size, length - size])
    one = small.groupBy("core", "block").agg(F.min(F.struct("segment", "at", "n")).alias("w"),
                                             F.max("all_times").alias("times")).select("w.*", "times")
    lists = one.groupBy("segment").agg(F.collect_list(F.struct("at", "n", "times")).alias("found"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 5000):
                part = batch.slice(begin, 5000)
                contents = part.column("content").to_pylist()
                sizes = np.array([len(c) for c in contents], np.int64)
                spans = SpanHash.of_bytes(np.frombuffer(b"".join(contents), np.uint8))
                found = part.column("found")
                rows = found.flatten()
                n = rows.field("n").to_numpy()
                segment = np.repeat(np.repeat(np.arange(part.num_rows), np.diff(found.offsets.to_numpy())), n)
                at = np.repeat(rows.field("at").to_numpy() - (np.cumsum(n) - n), n) + np.arange(n.sum())
                begins = ((np.cumsum(sizes) - sizes)[segment] + at)[:, None] + slots
                codes = spans(begins.ravel(), begins.ravel() + size)
                window = np.repeat(np.arange(len(at)), 4)
                places = part.column("start").to_numpy()[segment] + at
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(segment[window])), pa.array(places[window].astype(np.int32)),
                     pa.array(np.repeat(rows.field("times").to_numpy(), n)[window]),
                     pa.array(np.tile(np.arange(4, dtype=np.int32), len(at))), pa.array(codes.view(np.int64))],
                    ["key", "at", "times", "slot", "code"])

    kind = segments.schema["key"].dataType.simpleString()
    return (segments.join(lists, "segment").select("key", "start", "content", "found")
            .mapInArrow(coded, f"key {kind}, at int, times bigint, slot int, code bigint"))


def rank(rows: DataFrame, *codes: str) -> DataFrame:
    """Sorts by whole-number columns and numbers equal rows alike, in order.

    Adds ``rank`` and ``alone``, whether no other row is equal. Ranges of the order are
    dealt to tasks; a rank is the task's number and the place within its range.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch: pa.RecordBatch, new: np.ndarray, following: bool) -> pa.RecordBatch:
            nonlocal last
            ranks = last + np.cumsum(new)
            last = int(ranks[-1])
            alone = new & np.append(new[1:], following)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks), pa.array(alone)],
                                              [*batch.schema.names, "rank", "alone"])

        last, held, held_new = (TaskContext.get().partitionId() << 40) - 1, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            values = [batch.column(c).to_numpy() for c in codes]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
            new[0] = held_new
            if batch.num_rows > 1:
                yield out(batch.slice(0, batch.num_rows - 1), new[:-1], bool(new[-1]))
            held, held_new = batch.slice(batch.num_rows - 1), bool(new[-1])
        if held is not None:
            yield out(held, np.array([held_new]), True)

    schema = T.StructType([*rows.schema.fields, T.StructField("rank", T.LongType()), T.StructField("alone", T.BooleanType())])
    return rows.repartitionByRange(*codes).sortWithinPartitions(*codes).mapInArrow(numbered, schema)


def _doubled(ranked: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """Pairs of ranks at the next offset, for the windows all of whose parts have equals."""

    def of(slot: int):
        return F.max(F.when(F.col("slot") == slot, F.col("rank")))

    parts = [part for pair in pairs for part in pair]
    grouped = ranked.groupBy("key", "at", "times").agg(
        F.max("alone").alias("alone"), *[of(slot).alias(f"r{slot}") for slot in parts]).filter("not alone")
    return grouped.select("key", "at", "times", F.explode(F.array(*[
        F.struct(F.lit(i).alias("slot"), F.col(f"r{a}").alias("left"), F.col(f"r{b}").alias("right"))
        for i, (a, b) in enumerate(pairs)])).alias("pair")).select("key", "at", "times", "pair.*")


def repeated_windows(spark: SparkSession, docs: DataFrame, folder: str, length: int = LENGTH,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``start`` and ``n``: runs of windows to be removed. ``folder`` takes intermediate tables."""
    found = settle(block_table(docs, _byte_codes, length, min(GRAM, length), min(BLOCK, length), key, text))
    blocks = _stored(found.filter("times > 1 or mixed").drop("first"), spark, f"{folder}/blocks")
    segments = _segments(docs, blocks.filter("mixed"), length, key, text)
    segments = _stored(segments.withColumn("segment", F.monotonically_increasing_id()), spark, f"{folder}/segments")
    small = _stored(_small_blocks(segments, length), spark, f"{folder}/small")
    quarters = _stored(_quarters(segments, small.filter("mixed"), length), spark, f"{folder}/quarters")
    halves = rank(_doubled(rank(quarters, "code"), [(0, 1), (2, 3)]), "left", "right")
    whole = rank(_doubled(halves, [(0, 1)]), "left", "right")
    return (blocks.filter("times > 1").select("key", "start", "n")
            .unionByName(small.filter("times = 1 and all_times > 1")
                         .select("key", (F.col("start") + F.col("at")).alias("start"), "n"))
            .unionByName(whole.filter("not alone and times = 1")
                         .select("key", F.col("at").alias("start"), F.lit(1).alias("n"))))


def remove_repeats(spark: SparkSession, docs: DataFrame, folder: str, length: int = LENGTH,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``spans`` (begin and end of each removed run) and ``kept``, the other bytes."""
    texts = with_texts(docs, repeated_windows(spark, docs, folder, length, key, text), ["start", "n"], "left", key, text)

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8_buffers(part.column("text"))
                removed, spans, kept = [], [], []
                for a, b, found in zip(offsets[:-1], offsets[1:], part.column("found"), strict=True):
                    gone = covered(windows_of(found), length, int(b - a))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    removed.append(int(gone.sum()))
                    spans.append(edges.reshape(-1, 2).tolist())
                    kept.append(data[a:b][~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                    ["key", "n_bytes", "n_removed", "spans", "kept"])

    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(shortened, f"key {kind}, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, "
                                       "kept binary").withColumnRenamed("key", key)
