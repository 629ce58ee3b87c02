"""Windows that may repeat, cut into blocks by their content.

Helpers of the operators that look for repeated runs of words or bytes. They turn
one row per window into one row per block of neighbouring windows:

* Every window of ``length`` items has an anchor, the place of its smallest gram
  hash (winnowing). Equal windows have their anchors at equal offsets.
* Neighbouring windows of one anchor whose offsets agree in ``offset // size`` form
  a block. All of them contain the block's ``core``, which hangs on anchor and offset
  only: windows with different cores differ.
* ``block`` is the hash of all items of the block's windows: where it occurs again,
  all of its windows do.

So blocks with a core of their own are settled (no window repeats), and so are blocks
that occur again as a whole. What is left lies at the edges of repeated passages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text_arrays import SpanHash, anchor_of_windows, mix, slices


def cut(starts: np.ndarray, anchors: np.ndarray, spans: SpanHash, length: int, size: int) -> tuple[np.ndarray, ...]:
    """Blocks of the windows at ``starts`` (ascending): start, windows, core hash and block hash."""
    offsets = anchors - starts
    group = offsets // size
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (anchors[1:] != anchors[:-1]) | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin, tag = starts[first], mix((offsets[first] * 4099 + count).astype(np.uint64))
    core_begin = anchors[first] - group[first] * size
    core = spans(core_begin, core_begin + length - size + 1) ^ mix(group[first].astype(np.uint64) + np.uint64(1))
    block = spans(begin, begin + count - 1 + length) ^ tag
    return begin, count, core, block


def blocks(spans: SpanHash, offsets: np.ndarray, length: int, gram: int, size: int) -> tuple[np.ndarray, ...]:
    """All windows of all texts as blocks: start, windows, anchor, core hash and block hash."""
    starts, anchors = anchor_of_windows(spans.windows(gram), offsets, length, gram)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    begin, count, core, block = cut(starts, anchors, spans, length, size)
    return begin, count, anchors[np.searchsorted(starts, begin)], core, block


# --- over tables -----------------------------------------------------------------

#: From a column of texts: hashes of any spans of all texts' items, and each text's first item.
Codes = Callable[[pa.Array], tuple[SpanHash, np.ndarray]]


def block_table(docs: DataFrame, codes: Codes, length: int, gram: int, size: int,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per batch and different block, with all its places: the first aggregation before any shuffle.

    ``core``, ``block``, ``n`` windows, ``lead`` (items from the block's start to its anchor)
    and ``places``, each a ``key`` and a ``start``. Rows without key take no part.
    """
    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans, offsets = codes(part.column("text"))
                start, n, anchor, core, block = blocks(spans, offsets, length, gram, size)
                if not len(start):
                    continue
                order = np.lexsort((block, core))
                start, n, anchor, core, block = (x[order] for x in (start, n, anchor, core, block))
                new = np.ones(len(start), bool)
                new[1:] = (core[1:] != core[:-1]) | (block[1:] != block[:-1])
                first = np.flatnonzero(new)
                text_of = np.searchsorted(offsets, start, side="right") - 1
                places = pa.StructArray.from_arrays(
                    [part.column("key").take(pa.array(text_of)), pa.array((start - offsets[text_of]).astype(np.int32))],
                    ["key", "start"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core[first].view(np.int64)), pa.array(block[first].view(np.int64)),
                     pa.array(n[first].astype(np.int32)), pa.array((anchor - start)[first].astype(np.int32)),
                     pa.ListArray.from_arrays(np.append(first, len(start)).astype(np.int32), places)],
                    ["core", "block", "n", "lead", "places"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(found, "core bigint, block bigint, n int, lead int, "
                                  f"places array<struct<key:{kind},start:int>>")


def settle(table: DataFrame) -> DataFrame:
    """The places of all blocks whose core occurs more than once.

    ``key``, ``start``, ``n``, ``lead``, ``core``, ``block``; ``first``, the smallest key with that
    block; ``times``, the block's occurrences; ``mixed``: whether other blocks have the same core.
    """
    by_core, by_block = Window.partitionBy("core"), Window.partitionBy("core", "block")
    seen = F.size("places")
    marked = (table.withColumn("core_times", F.sum(seen).over(by_core))
              .withColumn("low", F.min("block").over(by_core)).withColumn("high", F.max("block").over(by_core))
              .filter("core_times > 1")
              .withColumn("times", F.sum(seen).over(by_block))
              .withColumn("first", F.min(F.array_min("places.key")).over(by_block)))
    return marked.select("core", "block", "n", "lead", "times", "first", (F.col("low") != F.col("high")).alias("mixed"),
                         F.explode("places").alias("place")).select(
        "place.key", "place.start", "n", "lead", "core", "block", "first", "times", "mixed")


def with_texts(docs: DataFrame, found: DataFrame, names: list[str], how: str,
               key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``key``, ``text``, ``found``, a list of structs of ``names``, and what to ``keep`` of each document."""
    lists = found.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("found"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *keep)
    return rows.join(lists, "key", how)


def windows_of(found: pa.ListScalar | None) -> np.ndarray:
    """The starts of all windows of a list of blocks."""
    if found is None or not found.is_valid:
        return np.zeros(0, np.int64)
    start, n = (found.values.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "n"))
    first = np.cumsum(n) - n
    return np.repeat(start - first, n) + np.arange(n.sum())
