"""Finding benchmark passages in documents by spaced-seed hashing.

Tokens are runs of letters, digits and non-ASCII bytes, in lower case; in scripts written without
spaces every character is one. A document shares a passage with a benchmark item where ``SPAN``
tokens in a row agree in all but at most ``SUBSTITUTIONS`` places. Each of the fixed masks ignores two
of the four residue classes of positions; whichever two positions differ, some mask ignores both,
so a shared passage always has an equal seed. Items' and documents' seeds are joined by
hash, and the tokens around every hit are compared. Items of fewer tokens must occur whole: those
of ``ONE_FROM`` or more with one substitution at most, for which two masks ignore every second position,
those of ``LEAST_TOKENS`` or more unchanged. Shorter ones are in too many texts by chance.

Only document seeds that may be an item's are shuffled: a bit table of fixed size
(``SLOT_BITS``) over all items' seeds is broadcast and looked up first.

Inputs and results, also for odd ones: null or empty texts, on either side, share
nothing, nor do items of fewer than ``LEAST_TOKENS`` tokens. Rows with null key take no
part. Repeated rows give their rows once. Texts of any length are compared whole. Only
the named columns are read, further ones are dropped. Empty tables give an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text_arrays import mix, slices, utf8_buffers, word_hashes, word_spans

SPAN, SUBSTITUTIONS, ONE_FROM, LEAST_TOKENS = 13, 2, 8, 5
SLOT_BITS = 26
#: The positions that each mask of a span looks at.
MASKS = [[i for i in range(SPAN) if i % 4 not in (a, b)] for a in range(4) for b in range(a + 1, 4)]
#: Length, positions looked at and tag of all seeds.
PATTERNS = [(SPAN, mask, i) for i, mask in enumerate(MASKS)]
for _n in range(LEAST_TOKENS, SPAN):
    PATTERNS += [(_n, list(range(_half, _n, 2)), 100 + 2 * _n + _half) for _half in (0, 1)] if _n >= ONE_FROM else [
        (_n, list(range(_n)), 100 + 2 * _n)]

_TOKEN_BYTES = np.zeros(256, bool)
_TOKEN_BYTES[48:58] = _TOKEN_BYTES[97:123] = _TOKEN_BYTES[128:] = True
_WEIGHTS = mix(np.arange(1, SPAN + 1, dtype=np.uint64)) | np.uint64(1)

# First bytes, and second ones from and to, of characters of scripts without spaces, of three bytes each:
# Thai and Lao, Burmese, Khmer, kana, and Chinese characters.
_UNSPACED = [(0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE3, 0x81, 0x83), (0xE3, 0x90, 0xBF),
             *((first, 0x80, 0xBF) for first in range(0xE4, 0xEA))]


def _single(data: np.ndarray) -> np.ndarray | None:
    """Bytes before which tokens break, as characters of scripts without spaces begin or end there."""
    leads = np.flatnonzero((data[:-2] >= 0xE0) & (data[:-2] < 0xEA)) if len(data) > 2 else np.zeros(0, np.int64)
    if not len(leads):
        return None
    first, second, chosen = data[leads], data[leads + 1], np.zeros(len(leads), bool)
    for lead, low, high in _UNSPACED:
        chosen |= (first == lead) & (second >= low) & (second <= high)
    breaks = np.zeros(len(data) + 1, bool)
    breaks[leads[chosen]] = breaks[leads[chosen] + 3] = True
    return breaks[:-1]


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8_buffers(pc.utf8_lower(column))
    starts, stops, firsts = word_spans(data, offsets, _TOKEN_BYTES, _single(data))
    return word_hashes(data, starts, stops), firsts


def _seeds(tokens: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and seeds of each pattern.

    ``left``: how many tokens of the text begin at each place.
    """
    for length, positions, tag in PATTERNS:
        n = max(0, len(tokens) - length + 1)
        total = np.zeros(n, np.uint64)
        for p in positions:
            total += tokens[p:p + n] * _WEIGHTS[p]
        at = np.flatnonzero(left[:n] >= length)
        yield length, at, mix(total[at] + np.uint64(tag))


def _seed_table(rows: DataFrame, slots: np.ndarray | None, spark: SparkSession) -> DataFrame:
    """``seed``, ``key``, ``place``, ``total`` tokens of the text and the ``window`` of tokens at the place.

    With ``slots`` for documents: only seeds whose bit is set. Without, for items: those of
    fewer tokens than a span have the whole text's seeds only.
    """
    shared = spark.sparkContext.broadcast(slots)

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, firsts = _tokens(part.column("text"))
                if not len(tokens):
                    continue
                text_of = np.repeat(np.arange(part.num_rows), np.diff(firsts))
                left, total = firsts[text_of + 1] - np.arange(len(tokens)), np.diff(firsts)[text_of]
                padded = np.concatenate([tokens, np.zeros(SPAN, np.uint64)])
                for length, at, seeds in _seeds(tokens, left):
                    if bits is not None:
                        slot = (seeds >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                        chosen = (bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
                    else:
                        chosen = np.minimum(total[at], SPAN) == length
                    at, seeds = at[chosen], seeds[chosen]
                    if not len(at):
                        continue
                    window = padded[at[:, None] + np.arange(SPAN)]
                    window[np.arange(SPAN) >= left[at][:, None]] = 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seeds.view(np.int64)), part.column("key").take(pa.array(text_of[at])),
                         pa.array((at - firsts[text_of[at]]).astype(np.int32)), pa.array(total[at].astype(np.int32)),
                         pa.ListArray.from_arrays(np.arange(0, SPAN * len(at) + 1, SPAN, dtype=np.int32),
                                                  pa.array(window.ravel().view(np.int64)))],
                        ["seed", "key", "place", "total", "window"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(seeded, f"seed bigint, key {kind}, place int, total int, window array<bigint>")


def _named(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def _slots(items: DataFrame) -> np.ndarray:
    """The bit table of all seeds: at most 2**(SLOT_BITS - 6) rows reach the driver."""
    slot = F.shiftrightunsigned("seed", 64 - SLOT_BITS)
    words = (items.select(F.shiftright(slot, 6).alias("word"),
                          F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - SLOT_BITS}) & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (SLOT_BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def shared_windows(spark: SparkSession, docs: DataFrame, items: DataFrame, folder: str, key: str = "doc_id",
                   text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key``, ``item``, ``place`` and ``item_place`` of all shared windows, with ``length`` and ``differing`` tokens."""
    seeds = _seed_table(_named(items, item_key, item_text), None, spark)
    seeds.write.mode("overwrite").parquet(folder)
    stored = spark.read.schema(seeds.schema).parquet(folder)
    found = _seed_table(_named(docs, key, text), _slots(stored), spark)
    length = F.least(F.lit(SPAN), "total")
    theirs = stored.select("seed", F.col("key").alias("item"), F.col("place").alias("item_place"),
                           length.alias("length"), F.col("window").alias("theirs"))
    pairs = F.arrays_zip(F.slice("window", F.lit(1), F.col("length")), F.slice("theirs", F.lit(1), F.col("length")))
    differing = F.size(F.filter(pairs, lambda p: p["0"] != p["1"]))
    allowed = F.when(F.col("length") >= SPAN, SUBSTITUTIONS).when(F.col("length") >= ONE_FROM, 1).otherwise(0)
    return (found.drop("total").join(theirs, "seed").withColumn("differing", differing)
            .filter(F.col("differing") <= allowed)
            .select("key", "item", "place", "item_place", "length", "differing").distinct())


def find_passages(spark: SparkSession, docs: DataFrame, items: DataFrame, folder: str, key: str = "doc_id",
                  text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key``, ``item_key`` and where they share tokens: ``begin`` and ``end`` in the document, ``item_begin`` in the item.

    Windows at one offset that overlap or touch are one passage. ``folder`` takes the items' seeds.
    """
    windows = shared_windows(spark, docs, items, folder, key, text, item_key, item_text)
    offset = F.col("place") - F.col("item_place")
    line = Window.partitionBy("key", "item", "offset").orderBy("place")
    before = F.max(F.col("place") + F.col("length")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    runs = windows.withColumn("offset", offset).withColumn("opens", F.coalesce(before < F.col("place"), F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(line))
    return runs.groupBy("key", "item", "offset", "run").agg(
        F.min("place").alias("begin"), F.max(F.col("place") + F.col("length")).alias("end"),
        F.min("item_place").alias("item_begin")).select(
        F.col("key").alias(key), F.col("item").alias(item_key), "begin", "end", "item_begin")
