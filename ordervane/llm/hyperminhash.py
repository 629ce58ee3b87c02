"""Near-duplicate documents by HyperMinHash signatures, banding and exact verification.

A document's set are its distinct shingles. The hashes of a set fall into buckets;
of each bucket's smallest hash the signature keeps the count of leading zeros and a
few of the bits after the first one. Empty buckets borrow from others, each in an
order of its own. Registers are grouped into bands, and documents that share a band
are candidates. Their similarity is estimated from equal registers, corrected for
registers that are equal by chance; what may reach the threshold is verified on the
full sets. Linked documents form classes.

Equal sets are one node from the start. Candidates are verified in three rounds, each
leaving out pairs that are in one class already: every node with the smallest node of
all its bands' groups, then with each band group's smallest node, then nodes of
different classes that still share a band. For these, sets are written as what they lack of a
center and what they have beside it. The center is the node with most links so far, of the class that most of the
band's group are in: the closer the center, the fewer differences, and all groups around it share them. A node that reaches
the threshold with the center is linked with it. Two that are not both linked with the center reach the threshold
only if enough of their differences are the same (``_candidates`` has the inequality); so pairs are formed
by joining rare differences. A large group of near copies costs about one verification for each
of its members, also if many of them lie just below the threshold, and no link is passed over.

With ``BANDS`` x ``ROWS`` registers a pair at similarity 0.8 shares no band with a chance
of about 5 in a million; nothing else is approximate (64-bit hashes aside).

Inputs and results, also for odd ones: texts that are null or without words have an
empty set, link with nothing and stay. A text with fewer words than a shingle has one
shingle, all its words. Rows with null key link with nothing and stay. A node is a set and
the smallest key that has it: rows repeated with one key and set get one class, and
rows with one key but other texts are nodes of their own. Long texts count whole.
Only the named columns are read, further ones are dropped. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .settings import SHUFFLES_DELETED, SMALL_BATCHES, settings
from .text_arrays import SpanHash, lower_ascii, mix, slices, utf8_buffers, window_ok, word_hashes, word_spans

BUCKETS, MANTISSA_BITS = 256, 10
BANDS, ROWS = 40, 6
#: How far below the threshold an estimate may lie; six standard deviations at 256 registers.
MARGIN = 0.15
_EMPTY = 0xFFFF
_VALUE_BITS = 56


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingle hashes, sorted within each text, and where each text begins."""
    data, offsets = utf8_buffers(column)
    data = lower_ascii(data)
    starts, stops, firsts = word_spans(data, offsets)
    spans, counts = SpanHash(word_hashes(data, starts, stops)), np.diff(firsts)
    begins = np.flatnonzero(window_ok(firsts, words, len(starts)))
    short = np.flatnonzero((counts > 0) & (counts < words))
    text = np.concatenate([np.searchsorted(firsts, begins, side="right") - 1, short])
    hashes = np.concatenate([spans(begins, begins + words),
                             mix(spans(firsts[short], firsts[short + 1]) + counts[short].astype(np.uint64))])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(column) + 1))


def registers(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The signature of every set (sets x buckets); that of an empty set means nothing."""
    sets = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    bucket = (hashes >> np.uint64(_VALUE_BITS)).astype(np.int64)
    new = np.ones(len(hashes), bool)
    new[1:] = (sets[1:] != sets[:-1]) | (bucket[1:] != bucket[:-1])
    value = hashes[new] & np.uint64((1 << _VALUE_BITS) - 1)
    bits = np.frexp(value.astype(np.float64))[1]
    bits -= (value >> np.maximum(bits - 1, 0).astype(np.uint64)) == 0  # rounded up by the conversion
    shift = bits - 1 - MANTISSA_BITS
    tail = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64))
    code = (_VALUE_BITS - bits) << MANTISSA_BITS | (tail & np.uint64((1 << MANTISSA_BITS) - 1)).astype(np.int64)
    out = np.full((len(firsts) - 1, BUCKETS), _EMPTY, np.uint16)
    out[sets[new], bucket[new]] = code
    return _borrowed(out)


def _borrowed(found: np.ndarray) -> np.ndarray:
    """Fills empty buckets from others, tried in an order that depends on the bucket only."""
    out = found.copy()
    rows, places = np.nonzero((found == _EMPTY) & (found != _EMPTY).any(axis=1)[:, None])
    attempt = 0
    while len(rows):
        attempt += 1
        donors = (mix((np.arange(BUCKETS) + BUCKETS * attempt).astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
        values = found[rows, donors[places]]
        full = values != _EMPTY
        out[rows[full], places[full]] = values[full]
        rows, places = rows[~full], places[~full]
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """A hash per band of every signature."""
    used = signatures[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    code = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = np.broadcast_to(code, used.shape[:2])
    for i in range(ROWS):
        out = mix(out ^ used[:, :, i])
    return out


@lru_cache(maxsize=4096)
def chance_of_equal(log_a: int, log_b: int) -> float:
    """Chance that registers of different hashes agree, for sets of 2**(log/4) shingles.

    The smallest of n hashes in a bucket lies in a register's interval with the
    difference of two exponentials; the chance is the sum of the products.
    """
    zeros = np.arange(_VALUE_BITS - MANTISSA_BITS)[:, None]
    width = 2.0 ** -(zeros + 1 + MANTISSA_BITS)
    low = 2.0 ** -(zeros + 1) + np.arange(1 << MANTISSA_BITS) * width
    shares = []
    for log in (log_a, log_b):
        load = max(1.0, 2 ** (log / 4) / BUCKETS)
        shares.append(np.exp(-load * low) - np.exp(-load * (low + width)))
    return float((shares[0] * shares[1]).sum())


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarities from two stacks of signatures, corrected for chance agreement."""
    equal = (a == b).mean(axis=1)
    logs = [np.round(4 * np.log2(np.maximum(s, 1))).astype(int).tolist() for s in (size_a, size_b)]
    chance = np.array([chance_of_equal(x, y) for x, y in zip(*logs, strict=True)])
    return (equal - chance) / (1 - chance)


def _digests(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over every set's mixed hashes, which together stand for the set."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (mix(hashes), mix(hashes ^ np.uint64(77)))]
    low, high = ((s[firsts[1:]] - s[firsts[:-1]]).view(np.int64) for s in sums)
    return low, high


def _stored(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def signatures(docs: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """``key``, ``n`` shingles, ``low`` and ``high`` (together a digest of the set) and the packed ``signature``."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, firsts = shingle_sets(part.column("text"), words)
                low, high = _digests(hashes, firsts)
                packed = registers(hashes, firsts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(np.diff(firsts)), pa.array(low), pa.array(high),
                     pa.array([row.tobytes() for row in packed], pa.binary())],
                    ["key", "n", "low", "high", "signature"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(signed, f"key {kind}, n bigint, low bigint, high bigint, signature binary")


def _with_digests(rows: DataFrame, words: int) -> DataFrame:
    """Adds ``low`` and ``high`` to ``key`` and ``text``."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                low, high = _digests(*shingle_sets(part.column("text"), words))
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("text"), pa.array(low), pa.array(high)],
                                                 ["key", "text", "low", "high"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(added, f"key {kind}, text string, low bigint, high bigint")


def _band_rows(nodes: DataFrame) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                packed = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, BUCKETS)
                codes = bands(packed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(np.repeat(np.arange(len(codes)), BANDS))),
                     pa.array(codes.ravel().view(np.int64))], ["key", "band"])

    kind = nodes.schema["key"].dataType.simpleString()
    return nodes.select("key", "signature").mapInArrow(split, f"key {kind}, band bigint")


def _likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose estimate may reach the threshold."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 5000):
                part = batch.slice(begin, 5000)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
                        for c in ("s_a", "s_b"))
                near = estimate(a, b, part.column("n_a").to_numpy(), part.column("n_b").to_numpy()) >= least - MARGIN
                yield part.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(kept, pairs.select("a", "b").schema)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("key").alias(name), F.col("text").alias(f"text_{name}"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", "text_b"):
                sets = [shingle_sets(part.column(c), words) for c in ("text_a", "text_b")]
                sizes = [np.diff(firsts) for _, firsts in sets]
                hashes = np.concatenate([h for h, _ in sets])
                pair = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
                order = np.lexsort((hashes, pair))
                hashes, pair = hashes[order], pair[order]
                both = (hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1])
                shared = np.bincount(pair[1:][both], minlength=part.num_rows)
                near = 100 * shared >= percent * (sizes[0] + sizes[1] - shared)
                yield part.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(kept, pairs.select("a", "b").schema)


def _differences(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """From pairs of a ``center`` and a ``key`` of class ``of``: the center's set's size ``n``, how many of its
    shingles the key's set lacks (``less``), how many it has beside them (``more``), and a hash of each of these.
    """
    def side(name: str) -> DataFrame:
        return texts.select(F.col("key").alias(name), F.col("text").alias(f"text_{name}"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_center", "text_key"):
                sets = [shingle_sets(part.column(c), words) for c in ("text_center", "text_key")]
                sizes = [np.diff(firsts) for _, firsts in sets]
                hashes = np.concatenate([h for h, _ in sets])
                pair = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
                beside = np.repeat([False, True], [len(h) for h, _ in sets])
                order = np.lexsort((hashes, pair))
                hashes, pair, beside = hashes[order], pair[order], beside[order]
                twice = np.zeros(len(hashes) + 1, bool)
                twice[1:-1] = (hashes[1:] == hashes[:-1]) & (pair[1:] == pair[:-1])
                alone = ~(twice[1:] | twice[:-1])
                hashes, pair, beside = mix(hashes[alone] ^ beside[alone].astype(np.uint64)), pair[alone], beside[alone]
                n = part.num_rows
                places = np.append(0, np.cumsum(np.bincount(pair, minlength=n))).astype(np.int32)
                less, more = (np.bincount(pair[beside == x], minlength=n) for x in (False, True))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("center", "key", "of")], pa.array(sizes[0]), pa.array(less), pa.array(more),
                     pa.ListArray.from_arrays(places, pa.array(hashes.view(np.int64)))],
                    ["center", "key", "of", "n", "less", "more", "differences"])

    rows = pairs.join(side("center"), "center").join(side("key"), "key")
    kinds = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in ("center", "key", "of"))
    return rows.select("center", "key", "of", "text_center", "text_key").mapInArrow(
        compared, f"{kinds}, n bigint, less bigint, more bigint, differences array<bigint>")


def _candidates(different: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of keys of one center and of different classes whose sets may reach the threshold.

    A center has n shingles, and a set lacks ``less`` of them and has ``more`` others. Two sets
    that have s of these differences in common have n - less - less' + s shingles in common. So they
    reach p percent just if ``(100 + p) s >= w + w' - (100 - p) n`` with ``w = 100 less + p more``, and a set
    is linked with the center itself just if ``w <= (100 - p) n``. Pairs that both are need no link of their own.
    So s is more than ``w / (100 + p)`` for one that is linked, and for another one at least
    ``(w - (100 - p) n) / 100``, as s is no more than the number of the partner's differences. With
    differences in order from rare to common, a pair then has one in common among the first ones of
    either, and as many from there on as it needs.
    """
    own = ["center", "key", "of", "n", "less", "more"]
    rows = different.select(*own, F.explode("differences").alias("difference"))
    often = rows.groupBy("center", "difference").agg(F.count("*").alias("times")).filter("times > 1")
    # differences of one set only come first, and meet nothing
    shared = rows.join(often, ["center", "difference"]).groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("times", "difference"))).alias("shared"))
    size, weight, slack = F.col("less") + F.col("more"), 100 * F.col("less") + percent * F.col("more"), (100 - percent) * F.col("n")
    needed = F.when(weight <= slack, F.floor(weight / (100 + percent)) + 1).otherwise(F.greatest(F.ceil((weight - slack) / 100), F.lit(1)))
    placed = shared.select("center", "key", "of", weight.alias("weight"), slack.alias("slack"), size.alias("size"), needed.alias("needed"),
                           F.size("shared").alias("times"), F.posexplode("shared").alias("place", "one"))
    placed = placed.select("center", "key", "of", "weight", "slack", F.col("one.difference").alias("difference"), "needed",
                           (F.col("times") - F.col("place")).alias("left")).filter("left >= needed")

    def side(name: str) -> DataFrame:
        return placed.select("center", "difference", F.col("key").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("of", "weight", "left")],
                             *(["slack"] if name == "a" else []))

    a, b = side("a").alias("l"), side("b").alias("r")
    apart = (F.col("of_a") < F.col("of_b")) & (F.greatest("weight_a", "weight_b") > F.col("slack"))
    same = (F.col("l.center") == F.col("r.center")) & (F.col("l.difference") == F.col("r.difference"))
    enough = (100 + percent) * F.least("left_a", "left_b") >= F.col("weight_a") + F.col("weight_b") - F.col("slack")
    return a.join(b, same & apart & enough).select("a", "b").distinct()


def _around(members: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of a ``center`` and a ``key`` of class ``of``, for the ``members`` of band groups that have several classes.

    A group's center is the node with most links in the class that most of the group are in, or the group's
    smallest node if no two of them are in one class. It need not be in the group.
    """
    ends = links.select(F.col("a").alias("key")).unionByName(links.select(F.col("b").alias("key")))
    hubs = (ends.groupBy("key").agg(F.count("*").alias("degree")).join(classes, "key")
            .groupBy(F.col("class").alias("of_key")).agg(F.max(F.struct("degree", (-F.col("key")).alias("key"))).alias("most"))
            .select("of_key", (-F.col("most.key")).alias("hub")))
    groups = (members.groupBy("band", "center", "of_key").agg(F.count("*").alias("n"))
              .groupBy("band", "center").agg(F.max(F.struct("n", (-F.col("of_key")).alias("of"))).alias("most"))
              .select("band", "center", "most.n", (-F.col("most.of")).alias("of_key")))
    chosen = groups.join(hubs, "of_key", "left").select(
        "band", F.when(F.col("n") > 1, F.coalesce("hub", "center")).otherwise(F.col("center")).alias("center"))
    return members.drop("center").join(chosen, "band").filter("key <> center").select(
        "center", "key", F.col("of_key").alias("of")).distinct()


def components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """``key`` and ``class``, the smallest key reachable over links ``a``, ``b``, for all linked keys.

    Every key takes the smallest class among its neighbours' and then its class's own
    class, until nothing changes. Each round is a written table.
    """
    ends = links.select(F.col("a").alias("key"), F.col("b").alias("other"))
    edges = _stored(ends.unionByName(ends.select(F.col("other").alias("key"), F.col("key").alias("other"))).distinct(),
                    spark, f"{folder}/edges")
    classes = _stored(edges.groupBy("key").agg(F.least("key", F.min("other")).alias("class")), spark, f"{folder}/0")
    round_ = 0
    while True:
        round_ += 1
        near = (edges.join(classes.select(F.col("key").alias("other"), "class"), "other")
                .groupBy("key").agg(F.min("class").alias("near")))
        lower = classes.join(near, "key").select("key", F.col("class").alias("was"), F.least("class", "near").alias("class"))
        jump = classes.select(F.col("key").alias("class"), F.col("class").alias("further"))
        moved = _stored(lower.join(jump, "class", "left").select(
            "key", "was", F.least("class", F.coalesce("further", "class")).alias("class")), spark, f"{folder}/{round_}")
        classes = moved.select("key", "class")
        if moved.filter("was <> class").isEmpty():
            return classes


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str, words: int = 4, percent: int = 80,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (smallest key of the class) and ``kept`` of every row.

    ``folder`` takes intermediate tables.
    """
    with settings(spark, SHUFFLES_DELETED, SMALL_BATCHES):
        return _classed(spark, docs, folder, words, percent, key, text)


def _classed(spark: SparkSession, docs: DataFrame, folder: str, words: int, percent: int, key: str, text: str) -> DataFrame:
    signed = _stored(signatures(docs, words, key, text), spark, f"{folder}/signatures")
    filled = signed.filter(F.col("key").isNotNull() & (F.col("n") > 0))
    same = ["n", "low", "high"]
    # a node's number stands for it from here on
    nodes = _stored(filled.groupBy(*same).agg(F.min(F.struct("key", "signature")).alias("one"))
                    .select(F.monotonically_increasing_id().alias("key"), F.col("one.key").alias("own"), "one.signature", *same),
                    spark, f"{folder}/nodes")
    banded = _band_rows(nodes)
    groups = banded.groupBy("band").agg(F.min("key").alias("center"), F.count("*").alias("members")).filter("members > 1")
    shared = _stored(banded.join(groups.drop("members"), "band"), spark, f"{folder}/shared")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    wanted = nodes.join(shared.select("key").distinct(), "key", "left_semi").select(
        F.col("own").alias("key"), "low", "high", F.col("key").alias("node"))
    several = rows.join(wanted.select("key").distinct(), "key", "left_semi")
    texts = _with_digests(several, words).join(wanted, ["key", "low", "high"]).select(F.col("node").alias("key"), "text")
    texts = _stored(texts.dropDuplicates(["key"]), spark, f"{folder}/texts")

    def linked(pairs: DataFrame, number: int) -> DataFrame:
        likely = _stored(_likely(pairs, nodes, percent / 100), spark, f"{folder}/likely{number}")
        return _stored(_verified(likely, texts, words, percent), spark, f"{folder}/links{number}")

    def classed(found: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """Adds the class of the key in column ``name``, itself where it has no link yet."""
        known = classes.select(F.col("key").alias(name), F.col("class").alias(f"of_{name}"))
        return found.join(known, name, "left").withColumn(f"of_{name}", F.coalesce(f"of_{name}", name))

    apart = F.col("of_a") != F.col("of_b")
    links = linked(shared.filter("key <> center").groupBy(F.col("key").alias("b")).agg(F.min("center").alias("a"))
                   .select("a", "b"), 1)
    classes = components(spark, links, f"{folder}/classes1")
    star = shared.filter("key <> center").select(F.col("center").alias("a"), F.col("key").alias("b")).distinct()
    star = classed(classed(star, classes, "a"), classes, "b").filter(apart).select("a", "b")
    links = links.unionByName(linked(star, 2))
    classes = components(spark, links, f"{folder}/classes2")
    members = classed(shared.select("band", "center", "key"), classes, "key")
    mixed = members.groupBy("band").agg(F.min("of_key").alias("x"), F.max("of_key").alias("y")).filter("x <> y").select("band")
    mixed = _stored(members.join(mixed, "band"), spark, f"{folder}/mixed")
    different = _stored(_differences(_around(mixed, links, classes), texts, words), spark, f"{folder}/differences")
    direct = different.filter(100 * F.col("less") + percent * F.col("more") <= (100 - percent) * F.col("n")).select(
        F.col("center").alias("a"), F.col("key").alias("b"))
    links = links.unionByName(direct)
    links = links.unionByName(linked(_candidates(different, percent), 3))
    classes = components(spark, links, f"{folder}/classes3")

    placed_nodes = nodes.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
    smallest = placed_nodes.groupBy("class").agg(F.min("own").alias("smallest"))
    by_set = placed_nodes.join(smallest, "class").select(*same, F.col("smallest").alias("class"))
    own = F.when(F.col("key").isNotNull() & (F.col("n") > 0), F.col("class")).otherwise(F.col("key"))
    placed = signed.drop("signature").join(by_set, same, "left").withColumn("class", own)
    return placed.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("class").alias("component_id"),
                         F.coalesce(F.col("key") == F.col("class"), F.lit(True)).alias("kept"))
