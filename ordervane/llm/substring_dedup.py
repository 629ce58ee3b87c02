"""Removal of word runs that an earlier document has, by suffix automata.

A window of ``length`` words is removed from a document if it also begins in a
document with a smaller key. Windows are judged on the input, whatever is removed.

Windows are cut into blocks by their content (``repeats``). Blocks with a core that occurs once are
ruled out by its hash, as none of their windows is anywhere else. All others, one copy of each different
block, form the reference shards: the blocks of one core, at most ``SHARD_BLOCKS`` of them in a shard. Each
shard becomes a suffix automaton whose states know the first document that has their words, and the
blocks of that core are streamed through it: their matching statistics say for every window the first
document that has it. A core with more blocks has several shards; its blocks are sent to each of
them, so that no automaton grows beyond the bound, and the first of all shards counts. Then every copy of
a block loses the windows that are in a document before its own. Copies of a block have equal hashes
of the block and of its core, 61 bits each.

Words are ``[^\\x20\\x09-\\x0D]+`` and are compared by 64-bit hashes of their bytes.

Inputs and results, also for odd ones: a null or empty text has no words, and one of
fewer than ``length`` words keeps all. A row with null key keeps all and is no
reference. Rows repeated with one key are one document and do not remove each other
(they must have one text). Texts of any length are read whole. Only the named
columns are read, further ones are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.state import delete_folder
from .repeats import block_table, settle, windows_of, with_texts
from .settings import SHUFFLES_DELETED, settings
from .text_arrays import SpanHash, covered, slices, utf8_buffers, word_hashes, word_spans

LENGTH = 50
#: Words of the hashed grams and windows of a block; bound of a shard in blocks.
GRAM, BLOCK, SHARD_BLOCKS = 8, 8, 1000


class SuffixAutomaton:
    """All runs of the words added, each state with the first document that has it."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]
        self._last, self._separators = 0, 0

    def _state(self, arcs: dict[int, int], link: int, length: int, first) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _append(self, word, document) -> None:
        arcs, link, length = self.next, self.link, self.length
        p = self._last
        new = self._last = self._state({}, 0, length[p] + 1, document)
        while p >= 0 and word not in arcs[p]:
            arcs[p][word] = new
            p = link[p]
        if p < 0:
            return
        q = arcs[p][word]
        if length[q] == length[p] + 1:
            link[new] = q
            return
        clone = self._state(dict(arcs[q]), link[q], length[p] + 1, self.first[q])
        while p >= 0 and arcs[p].get(word) == q:
            arcs[p][word] = clone
            p = link[p]
        link[q] = link[new] = clone

    def add(self, words: list[int], document) -> None:
        """Adds a run; runs must come in the order of their documents."""
        for word in words:
            self._append(word, document)
        self._separators += 1
        self._append(("end", self._separators), document)

    def first_documents(self, words: list[int], length: int) -> list:
        """For each window of ``length`` words, the first document that has it, or None."""
        arcs, link, longest, first = self.next, self.link, self.length, self.first
        state, matched, out = 0, 0, []
        for at, word in enumerate(words):
            while state and word not in arcs[state]:
                state = link[state]
                matched = longest[state]
            if word in arcs[state]:
                state = arcs[state][word]
                matched += 1
            while longest[link[state]] >= length if state else False:
                state = link[state]
                matched = longest[state]
            if at >= length - 1:
                out.append(first[state] if matched >= length else None)
        return out


def _word_codes(column: pa.Array) -> tuple[SpanHash, np.ndarray]:
    data, offsets = utf8_buffers(column)
    starts, stops, firsts = word_spans(data, offsets)
    return SpanHash(word_hashes(data, starts, stops)), firsts


def _runs(docs: DataFrame, chosen: DataFrame, length: int, key: str, text: str) -> DataFrame:
    """The words of blocks: ``core``, ``block``, ``key``, ``words``."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8_buffers(part.column("text"))
                starts, stops, firsts = word_spans(data, offsets)
                hashes = word_hashes(data, starts, stops).view(np.int64)
                found = part.column("found")
                blocks = found.flatten()
                text_of = np.repeat(np.arange(part.num_rows), np.diff(found.offsets.to_numpy()))
                start, n = (blocks.field(name).to_numpy().astype(np.int64) for name in ("start", "n"))
                size = n + length - 1
                places = np.concatenate([[0], np.cumsum(size)])
                at = np.repeat(firsts[text_of] + start - places[:-1], size) + np.arange(places[-1])
                yield pa.RecordBatch.from_arrays(
                    [blocks.field("core"), blocks.field("block"), part.column("key").take(pa.array(text_of)),
                     pa.ListArray.from_arrays(places.astype(np.int32), pa.array(hashes[at]))],
                    ["core", "block", "key", "words"])

    texts = with_texts(docs, chosen, ["start", "n", "core", "block"], "inner", key, text)
    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(runs, f"core bigint, block bigint, key {kind}, words array<bigint>")


def _first_documents(runs: DataFrame, length: int) -> DataFrame:
    """``core``, ``block`` and ``firsts``: for each window of a block the first document that has it."""
    counts = runs.groupBy("core").agg(F.ceil(F.count("*") / SHARD_BLOCKS).cast("int").alias("shards"))
    many = counts.filter("shards > 1")
    own = F.pmod(F.xxhash64("block"), F.col("shards"))
    sent = (runs.join(many, "core", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
            .withColumn("own", own).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
            .select("core", "shard", (F.col("own") != F.col("shard")).alias("visitor"), "key", "block", "words"))

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, residents, automaton, out = None, [], None, []

        def match(block: int, words: list[int]) -> None:
            out.append((shard[0], block, automaton.first_documents(words, length)))

        def close() -> None:
            nonlocal automaton
            if automaton is None:
                automaton = SuffixAutomaton()
                for key, _, words in residents:
                    automaton.add(words, key)
                for _, block, words in residents:
                    match(block, words)

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.list_(key_type))], ["core", "block", "firsts"])

        key_type = None
        for batch in batches:
            key_type = batch.schema.field("key").type
            for begin in range(0, batch.num_rows, 500):
                for row in batch.slice(begin, 500).to_pylist():
                    if (row["core"], row["shard"]) != shard:
                        if residents:
                            close()
                        shard, residents, automaton = (row["core"], row["shard"]), [], None
                    if row["visitor"]:
                        close()
                        match(row["block"], row["words"])
                    else:
                        residents.append((row["key"], row["block"], row["words"]))
                if out:
                    yield made()
        if residents:
            close()
        if out:
            yield made()

    kind = runs.schema["key"].dataType.simpleString()
    # work goes by words and not by bytes, so partitions are not to be packed by their bytes
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sent.repartition(parts, "core", "shard").sortWithinPartitions("core", "shard", "visitor", "key", "block")
    found = ordered.mapInArrow(streamed, f"core bigint, block bigint, firsts array<{kind}>")
    least = F.array(*[F.min(F.get("firsts", F.lit(i))) for i in range(BLOCK)])
    return found.groupBy("core", "block").agg(least.alias("firsts"))


def _stored(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def repeated_windows(spark: SparkSession, docs: DataFrame, folder: str, length: int = LENGTH,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``start`` and ``n``: runs of windows to be removed.

    ``folder`` takes intermediate tables. Each is deleted, as its shuffle files are, when the next one is there.
    """
    found = settle(block_table(docs, _word_codes, length, min(GRAM, length), min(BLOCK, length), key, text))
    blocks = _stored(spark, found.select("key", "start", "n", "core", "block"), f"{folder}/blocks")
    one = blocks.groupBy("core", "block").agg(F.min(F.struct("key", "start", "n")).alias("at")).select("core", "block", "at.*")
    runs = _stored(spark, _runs(docs, one, length, key, text), f"{folder}/runs")
    firsts = _stored(spark, _first_documents(runs, length), f"{folder}/firsts")
    delete_folder(spark, f"{folder}/runs")
    known = blocks.join(firsts, ["core", "block"])
    whole = known.filter(F.array_max("firsts") < F.col("key")).select("key", "start", "n")
    some = known.filter((F.array_max("firsts") >= F.col("key")) & (F.array_min("firsts") < F.col("key"))).select(
        "key", "start", F.posexplode("firsts").alias("place", "first")).filter("first < key").select(
        "key", (F.col("start") + F.col("place")).alias("start"), F.lit(1).alias("n"))
    windows = _stored(spark, whole.unionByName(some), f"{folder}/windows")
    for name in ("blocks", "firsts"):
        delete_folder(spark, f"{folder}/{name}")
    return windows


def remove_repeats(spark: SparkSession, docs: DataFrame, folder: str, length: int = LENGTH,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``spans`` (begin and end of removed runs of words) and ``kept``, the rest."""
    with settings(spark, SHUFFLES_DELETED):
        windows = repeated_windows(spark, docs, folder, length, key, text)
    texts = with_texts(docs, windows, ["start", "n"], "left", key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words_of = [(t or "").encode() for t in part.column("text").to_pylist()]
                words, removed, spans, kept = [], [], [], []
                for encoded, found in zip(words_of, part.column("found"), strict=True):
                    items = encoded.split()
                    gone = covered(windows_of(found), length, len(items))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    words.append(len(items))
                    removed.append(int(gone.sum()))
                    spans.append(edges.reshape(-1, 2).tolist())
                    rest = items if not len(edges) else [w for w, g in zip(items, gone.tolist(), strict=True) if not g]
                    kept.append(b" ".join(rest).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.string())],
                    ["key", "n_words", "n_removed", "spans", "kept"])

    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(cut, f"key {kind}, n_words bigint, n_removed bigint, spans array<array<bigint>>, "
                                 "kept string").withColumnRenamed("key", key)
