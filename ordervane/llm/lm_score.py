"""Language-model scoring by a weighted backoff automaton over words.

Words and neighbouring words are counted over all training texts. Frequent
contexts of one and two words become states. A state has an arc for each stored
continuation, weighted with its discounted log-probability, and a failure arc to
the next shorter context, weighted so that all continuations together have
probability one (Katz backoff with absolute discounting). The root has an arc for
every word, known or not, with the smoothed share of the word. A text is read once
from left to right; the state is carried along and the weights are summed.

Every pair and triple seen ``least_count`` times or more is an arc, at any size of the
input. What is broadcast is bounded: arcs with at least 1/``MOST_ARCS`` of all tokens,
and at most ``MOST_ARCS`` of each length can have that share. All others stay in stored
tables. Where the broadcast part lacks an arc, its failure arcs are taken; the difference
to the arc's own weight depends on the word sequence only, so it is joined and added, as
are the root's weights of words that are not broadcast.

Most pairs and triples are seen once, and there are more bytes of their hashes than of text. So
they travel packed, a row for each bucket of hashes and some texts, and are added up, and later looked up,
a bucket at a time; the number of buckets grows with the tokens. In the same way pairs meet their words' counts
and triples their pairs, but for those that are broadcast. Counting and looking up is done in ``PARTS`` parts, one after
the other, and a part's shuffle files are deleted before the next one is begun.

Words are compared by 64-bit hashes of their lower-cased bytes.

Inputs and results, also for odd ones: a null text counts as empty, and an empty
text is one token, the end. Texts of any length are read whole; each row is scored
on its own, repeated rows too. Rows with null key are not learned from. Without
training rows every token is unknown. Only the named columns are read, further
ones are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.state import delete_folder
from .settings import SHUFFLES_DELETED, settings
from .text_arrays import lower_ascii, mix, slices, utf8_buffers, word_hashes, word_spans

#: Bounds of the broadcast parts (words, pairs, triples each) and of the root's broadcast weights.
MOST_ARCS, MOST_WEIGHTS = 1 << 18, 1 << 21
LEAST_COUNT = 2
#: Passes over the texts for counting pairs and triples, and for looking them up; and tokens for each bucket of hashes.
PARTS, LOOKUPS, BUCKET_TOKENS = 2, 4, 1 << 18
DISCOUNT = 0.5
#: The hash that stands for the end of a text, and for its start as a context.
END = np.uint64(0)
_BITS = 18
_FLUSH = 1 << 20


def trained_on(key: str = "doc_id", held_out_remainder: int = 1) -> Column:
    """Whether a row is learned from; a fifth of the keys, and null keys, are not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 != held_out_remainder, F.lit(False))


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and its end, and where each text begins."""
    data, offsets = utf8_buffers(column)
    data = lower_ascii(data)
    starts, stops, firsts = word_spans(data, offsets)
    words = word_hashes(data, starts, stops)
    words[words == END] = 1
    return np.insert(words, firsts[1:], END), firsts + np.arange(len(firsts))


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(codes)
    first = _firsts(codes[order])
    return codes[order][first], np.add.reduceat(n[order], first) if len(first) else n


def _count(docs: DataFrame, text: str, codes_of) -> DataFrame:
    """``code`` and ``n`` over all texts; tasks add up before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            codes, n = _counted(parts)
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], ["code", "n"])

        parts, held = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                codes, n = np.unique(codes_of(part.column("text")), return_counts=True)
                parts.append((codes.astype(np.uint64), n))
                held += len(codes)
                if held > _FLUSH:
                    parts = [_counted(parts)]
                    held = len(parts[0][0])
                    if held > _FLUSH // 2:
                        yield out()
                        parts, held = [], 0
        if parts:
            yield out()

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(counted, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code``, a token's hash, and ``n`` for all tokens of all texts."""
    return _count(docs, text, lambda column: token_hashes(column)[0])


def _arrays(rows: DataFrame, *names: str) -> list[np.ndarray]:
    """The columns of a bounded table as arrays, sorted by code, which comes first."""
    table = rows.select("code", *names).toArrow()
    codes = table["code"].to_numpy().view(np.uint64)
    order = np.argsort(codes)
    return [codes[order], *(table[name].to_numpy()[order] for name in names)]


def _find(sorted_codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted code stands, -1 if nowhere."""
    if not len(sorted_codes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_codes, wanted), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == wanted, at, -1)


class _Index:
    """Finds different hashes' places by their low bits; made when first asked, once in each worker that it was sent to.

    A search by halves misses the processor's cache and branches at each step, this takes one step for most hashes.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes

    @cached_property
    def _slots(self) -> tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64((1 << (4 * len(self.codes)).bit_length()) - 1)
        slots = (self.codes & mask).astype(np.int64)
        order = np.argsort(slots, kind="stable")
        starts = np.append(0, np.cumsum(np.bincount(slots, minlength=int(mask) + 1))).astype(np.int32)
        return mask, starts, self.codes[order], order

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Where each wanted code stands, -1 if nowhere."""
        found = np.full(len(wanted), -1)
        if not len(self.codes):
            return found
        mask, starts, codes, order = self._slots
        slots = (wanted & mask).astype(np.int64)
        at, ends = starts[slots], starts[slots + 1]
        left = np.flatnonzero(at < ends)
        at, ends, wanted = at[left], ends[left], wanted[left]
        while len(left):
            ok = codes[at] == wanted
            found[left[ok]] = order[at[ok]]
            at += 1
            more = np.flatnonzero(~ok & (at < ends))
            left, at, ends, wanted = left[more], at[more], ends[more], wanted[more]
        return found


def sequence_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hashes of pairs of words, or of triples by their two pairs."""
    return mix(mix(left) * np.uint64(3) + right)


def _sequences(tokens: np.ndarray, firsts: np.ndarray) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Left and right part, code and text of all pairs and of all triples, the start before each text included."""
    padded = np.insert(tokens, firsts[:-1], END)
    begins = firsts[:-1] + np.arange(len(firsts) - 1)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts) + 1)
    codes = sequence_codes(padded[:-1], padded[1:])
    ok = np.ones(len(codes), bool)
    ok[begins[1:] - 1] = False  # from one text's end to the next one's start
    both = ok[:-1] & ok[1:]
    left, right = codes[:-1][both], codes[1:][both]
    return ((padded[:-1][ok], padded[1:][ok], codes[ok], text[:-1][ok]),
            (left, right, sequence_codes(left, right), text[:-2][both]))


def _bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    return ((codes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _packed(values: np.ndarray | None, places: np.ndarray) -> pa.Array:
    """The values between neighbouring places as bytes: tasks move them as a whole, and not one by one as those of arrays."""
    if values is None:
        return pa.nulls(len(places) - 1, pa.binary())
    offsets = (places * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _token_lists(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the batch: rows, the tokens of their texts as they were stored, and where each text begins."""
    for piece in slices(batch, "tokens"):
        tokens = np.frombuffer(b"".join(piece.column("tokens").to_pylist()), np.uint64)
        sizes = pc.binary_length(piece.column("tokens")).to_numpy(zero_copy_only=False) // 8
        yield piece.column("row").to_numpy(), tokens, np.append(0, np.cumsum(sizes, dtype=np.int64))


def _lists(bucket: np.ndarray, kind: int, **columns: np.ndarray | None) -> pa.RecordBatch:
    """A row for each bucket, with its ``kind`` and its values of the columns, packed; None has no values."""
    small = bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket  # sorted by radix
    order = np.argsort(small, kind="stable") if (bucket[1:] < bucket[:-1]).any() else slice(None)
    bucket = bucket[order]
    first = _firsts(bucket)
    places = np.append(first, len(bucket))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first]), pa.array(np.full(len(first), kind, np.int8)),
         *(_packed(None if c is None else c[order], places) for c in columns.values())], ["bucket", "kind", *columns])


def _unpacked(batch: pa.RecordBatch, name: str, kind: type | None = None) -> list[np.ndarray]:
    """Every row's values; without a kind as bytes."""
    return [np.frombuffer(x, kind or np.uint8) if x else np.zeros(0, kind or np.uint8) for x in batch.column(name).to_pylist()]


def _bucket_rows(batches: Iterator[pa.RecordBatch], **columns: type | None) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Bucket, kind and values of every row, by the columns' types."""
    for batch in batches:
        buckets, kinds = batch.column("bucket").to_pylist(), batch.column("kind").to_pylist()
        lists = [_unpacked(batch, name, kind) for name, kind in columns.items()]
        for i, (bucket, kind) in enumerate(zip(buckets, kinds, strict=True)):
            yield bucket, kind, [column[i] for column in lists]


def _added(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Left and right part, code and count of all different sequences, of lists of these."""
    left, right, code, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(code)
    code = code[order]
    first = _firsts(code)
    at = order[first]
    return left[at], right[at], code[first], np.add.reduceat(n[order], first) if len(first) else n


_SEQUENCES = "bucket int, kind tinyint, left binary, right binary, n binary"


def count_sequences(docs: DataFrame, least: int, part: int = 0, parts: int = 1, buckets: int = 1, text: str = "text") -> DataFrame:
    """``left``, ``right`` and ``n`` of the pairs (kind 0) and triples (1) that all texts have ``least`` times, packed by bucket.

    Only the buckets of this part of all are counted.
    """
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(triple: int) -> pa.RecordBatch:
            left, right, code, n = _added(held[triple])
            return _lists(_bucket_of(code, buckets), triple, left=left, right=right, n=n.astype(np.uint32))

        held, size = ([], []), 0
        for batch in batches:
            for piece in slices(batch, "text"):
                for own, (left, right, code, _) in zip(held, _sequences(*token_hashes(piece.column("text"))), strict=True):
                    ok = np.flatnonzero(_bucket_of(code, buckets) % parts == part)
                    own.append((left[ok], right[ok], code[ok], np.ones(len(ok), np.int64)))
                    size += len(ok)
                if size > 2 * _FLUSH:
                    yield from map(out, (0, 1))
                    held, size = ([], []), 0
        if size:
            yield from map(out, (0, 1))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            left, right, _, n = _added(held)
            often = n >= least
            return _lists(np.full(int(often.sum()), last[0], np.int32), last[1], left=left[often], right=right[often], n=n[often])

        held, size, last = [], 0, None
        for bucket, kind, (left, right, n) in _bucket_rows(batches, left=np.uint64, right=np.uint64, n=np.uint32):
            if (bucket, kind) != last and held:
                yield out()
                held, size = [], 0
            last = bucket, kind
            held.append((left, right, sequence_codes(left, right), n.astype(np.int64)))
            size += len(left)
            if size > 4 * _FLUSH:
                held, size = [_added(held)], 0
        if held:
            yield out()

    rows = docs.select(F.col(text).cast("string").alias("text"))
    lists = rows.mapInArrow(listed, _SEQUENCES)
    return lists.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(counted, _SEQUENCES)


#: Rows that meet by bucket: of a table (kind 0), and those that ask it for the value of their ``key`` (kind 1).
_MEETING = "bucket int, kind tinyint, key binary, code binary, n binary, value binary"
_COLUMNS = {"key": np.uint64, "code": np.uint64, "n": np.int64, "value": np.float64}
#: What a meeting gives: pairs or triples (kind 0), sums of a broadcast left part (1), and the table's codes (2).
_MET = "bucket int, kind tinyint, left binary, code binary, n binary, first binary, second binary"
_MET_COLUMNS = {"left": np.uint64, "code": np.uint64, "n": np.int64, "first": np.float64, "second": np.float64}


def _sent(rows: DataFrame, columns: dict[str, type], made: Callable, kind: int, buckets: int, schema: str = _MEETING) -> DataFrame:
    """The rows that ``made`` makes of packed ones, packed anew: a dict of columns and the codes that give the buckets."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            by = np.concatenate([x[1] for x in held])
            return _lists(_bucket_of(by, buckets), kind, **{name: np.concatenate([x[0][name] for x in held]) if name in held[0][0] else None
                                                            for name in names})

        held, size = [], 0
        for batch in batches:
            for _, _, values in _bucket_rows([batch], **columns):
                held.append(made(*values))
                size += len(held[-1][1])
                if size > _FLUSH:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    names = [column.split()[0] for column in schema.split(", ")[2:]]
    return rows.mapInArrow(listed, schema)


def _meeting(table: DataFrame, asking: DataFrame, joined: Callable[..., list[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``joined`` makes of each bucket's rows: the table's and the asking ones' columns."""
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            known, asked = ([np.concatenate([x[i] for x in rows]) if rows else np.zeros(0, kind) for i, kind in enumerate(_COLUMNS.values())]
                            for rows in held)
            order = np.argsort(known[0])
            return joined(last, *([x[order] if len(x) else x for x in known], asked))

        last, held = None, ([], [])
        for bucket, kind, values in _bucket_rows(batches, **_COLUMNS):
            if bucket != last and last is not None:
                yield from out()
                held = [], []
            last = bucket
            held[kind].append(values)
        if last is not None:
            yield from out()

    return table.unionByName(asking).repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(met, schema)


def _in_bucket(bucket: int, kind: int, rows: int, **columns: np.ndarray | None) -> pa.RecordBatch:
    return _lists(np.full(rows, bucket, np.int32), kind, **columns)


def _values(hot: tuple[np.ndarray, np.ndarray], known: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wanted codes' values, of the broadcast ones or else of the bucket's own, and which are broadcast."""
    at, own = _find(hot[0], wanted), _find(known, wanted)
    found = np.full(len(wanted), np.nan)
    for place, source in ((own, values), (at, hot[1])):
        found[place >= 0] = source[place[place >= 0]]
    return found, at >= 0


def _bucket_key(hot: np.ndarray, key: np.ndarray, code: np.ndarray) -> np.ndarray:
    """What decides on a row's bucket: its key, if that is not broadcast, so no key has many rows."""
    return np.where(_find(hot, key) >= 0, code, key)


def _with_lower(spark: SparkSession, sequences: DataFrame, kind: int, hot: tuple[np.ndarray, np.ndarray], table: DataFrame,
                lower: Callable[[np.ndarray, np.ndarray], np.ndarray], by: str, buckets: int) -> DataFrame:
    """``left``, ``code``, ``n`` and, as ``first``, the share that the right part alone has: ``lower`` of the table's column ``by``."""
    shared = spark.sparkContext.broadcast(hot)

    def asking(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> tuple[dict, np.ndarray]:
        return {"key": right, "code": left, "n": n}, _bucket_key(shared.value[0], right, sequence_codes(left, right))

    def joined(bucket: int, known: list[np.ndarray], asked: list[np.ndarray]) -> list[pa.RecordBatch]:
        right, left, n, _ = asked
        value, _ = _values(shared.value, known[0], dict(zip(_COLUMNS, known, strict=True))[by], right)
        return [_in_bucket(bucket, 0, len(left), left=left, code=sequence_codes(left, right), n=n, first=lower(value), second=None)]

    rows = sequences.filter(F.col("kind") == kind).select("bucket", "kind", "left", "right", "n")
    columns = {"left": np.uint64, "right": np.uint64, "n": np.int64}
    return _meeting(table, _sent(rows, columns, asking, 1, buckets), joined, _MET)


def _with_share(spark: SparkSession, rows: DataFrame, hot: tuple[np.ndarray, np.ndarray], table: DataFrame, buckets: int) -> DataFrame:
    """Kind 0: ``left``, ``code``, ``n``, as ``first`` the share of the left part's occurrences and as ``second`` what is added.

    That is the share's logarithm without that of the lower one, and without the left part's cost if it is not broadcast.
    Kind 1: of a broadcast ``left``, the bucket's sums of both shares. Kind 2: the table's ``code``, ``n`` and
    ``value`` (``first``), and their costs (``second``).
    """
    shared = spark.sparkContext.broadcast(hot)

    def asking(left: np.ndarray, code: np.ndarray, n: np.ndarray, lower: np.ndarray, _) -> tuple[dict, np.ndarray]:
        return {"key": left, "code": code, "n": n, "value": lower}, _bucket_key(shared.value[0], left, code)

    def joined(bucket: int, known: list[np.ndarray], asked: list[np.ndarray]) -> list[pa.RecordBatch]:
        (own, _, own_n, own_value), (left, code, n, lower) = known, asked
        whole, is_hot = _values(shared.value, own, own_n, left)
        share = (n - DISCOUNT) / whole
        more = np.log10(share) - np.log10(lower)
        lefts, back = np.unique(left, return_inverse=True)
        sums, lowers = (np.bincount(back, weights=x, minlength=len(lefts)) for x in (share, lower))
        cost = _cost(sums, lowers)
        more -= np.where(is_hot, 0.0, cost[back])
        at = _find(lefts, own)
        costs = np.where(at >= 0, cost[at], 0.0) if len(lefts) else np.zeros(len(own))
        held = np.flatnonzero(_find(shared.value[0], lefts) >= 0)
        return [_in_bucket(bucket, 0, len(left), left=left, code=code, n=n, first=share, second=more),
                _in_bucket(bucket, 1, len(held), left=lefts[held], code=None, n=None, first=sums[held], second=lowers[held]),
                _in_bucket(bucket, 2, len(own), left=None, code=own, n=own_n, first=own_value if len(own_value) else None, second=costs)]

    return _meeting(table, _sent(rows.filter("kind = 0"), _MET_COLUMNS, asking, 1, buckets), joined, _MET)


def _cost(share: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The weight of a failure arc, by the sums over the context's arcs."""
    return np.log10((1 - share) / (1 - lower))


def _hot_costs(met: DataFrame, hot: np.ndarray) -> np.ndarray:
    """The costs of the broadcast left parts; 0 of those that no sequence begins with."""
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (left, share, lower) in _bucket_rows(batches, left=np.int64, first=np.float64, second=np.float64):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (left, share, lower)], ["code", "share", "lower"])

    rows = met.filter("kind = 1").select("bucket", "kind", "left", "first", "second").mapInArrow(flat, "code bigint, share double, lower double")
    codes, share, lower = _arrays(rows.groupBy("code").agg(F.sum("share").alias("share"), F.sum("lower").alias("lower")), "share", "lower")
    at = _find(codes, hot)
    return np.where(at >= 0, _cost(share, lower)[at], 0.0) if len(codes) else np.zeros(len(hot))


def _hot_sequences(sequences: DataFrame, kind: int, least: int) -> list[np.ndarray]:
    """Code, ``n``, left and right part of those that are broadcast."""
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (left, right, n) in _bucket_rows(batches, left=np.uint64, right=np.uint64, n=np.int64):
            hot = n >= least
            if hot.any():
                left, right, n = left[hot], right[hot], n[hot]
                columns = [sequence_codes(left, right).view(np.int64), n, left.view(np.int64), right.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["code", "n", "left", "right"])

    rows = sequences.filter(F.col("kind") == kind).mapInArrow(flat, "code bigint, n bigint, left bigint, right bigint")
    codes, n, left, right = _arrays(rows, "n", "left", "right")
    return [codes, n, left.view(np.uint64), right.view(np.uint64)]


def _word_lists(counts: DataFrame, buckets: int) -> DataFrame:
    """``code`` and ``n`` as a table that sequences may ask."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, n = (batch.column(c).to_numpy() for c in ("code", "n"))
            codes = codes.view(np.uint64)
            yield _lists(_bucket_of(codes, buckets), 0, key=codes, code=None, n=n, value=None)

    return counts.select("code", "n").mapInArrow(listed, _MEETING)


def _pair_lists(spark: SparkSession, pairs: DataFrame, hot: tuple[np.ndarray, np.ndarray], column: str, buckets: int) -> DataFrame:
    """The pairs as a table that triples may ask: ``n``, and as ``value`` the share, or what is added with all costs of left parts."""
    shared = spark.sparkContext.broadcast(hot)

    def made(left: np.ndarray, code: np.ndarray, n: np.ndarray, share: np.ndarray, more: np.ndarray) -> tuple[dict, np.ndarray]:
        return {"key": code, "n": n, "value": share if column == "first" else more - _of_hot(shared.value, left)}, code

    return _sent(pairs.filter("kind = 0"), _MET_COLUMNS, made, 0, buckets)


def _of_hot(hot: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> np.ndarray:
    at = _find(hot[0], codes)
    return np.where(at >= 0, hot[1][at], 0.0) if len(hot[0]) else np.zeros(len(codes))


@dataclass
class Automaton:
    """The broadcast part as sorted arrays; dictionaries are made in each worker once."""

    tokens: int
    types: int
    buckets: int
    weight_codes: np.ndarray  # hashes of the words whose root weights are broadcast
    weight_counts: np.ndarray
    weight_costs: np.ndarray  # of their failure arcs
    words: np.ndarray  # hashes of the frequent words; their places are the words' numbers
    word_costs: np.ndarray
    pairs: np.ndarray
    pair_left: np.ndarray
    pair_right: np.ndarray
    pair_shares: np.ndarray
    pair_costs: np.ndarray
    triples: np.ndarray
    triple_left: np.ndarray
    triple_right: np.ndarray
    triple_shares: np.ndarray

    def root_weights(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    @cached_property
    def parts(self) -> tuple[_Index, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Arcs by state and word, arcs' weights and targets, states' failure arcs and their costs, and words' states."""
        left, right = _find(self.words, self.pair_left), _find(self.words, self.pair_right)
        backs, backs3 = self.word_costs != 0, self.pair_costs != 0
        context, below = _find(self.pairs, self.triple_left), _find(self.pairs, self.triple_right)
        backs[left], backs3[context] = True, True
        state_of_word = np.where(backs, np.cumsum(backs), 0)
        state_of_pair = np.where(backs3, backs.sum() + np.cumsum(backs3), 0)
        after_pair = np.where(backs3, state_of_pair, state_of_word[right])
        arcs = np.concatenate([state_of_word[left] << _BITS | right, state_of_pair[context] << _BITS | right[below]])
        weights = np.log10(np.concatenate([self.pair_shares, self.triple_shares]))
        targets = np.concatenate([after_pair, after_pair[below]])
        fails = np.concatenate([np.zeros(1 + int(backs.sum()), np.int64), state_of_word[right][backs3]])
        costs = np.concatenate([np.zeros(1), self.word_costs[backs], self.pair_costs[backs3]])
        return _Index(mix(arcs)), weights, targets, fails, costs, np.append(state_of_word, 0)

    @cached_property
    def known_words(self) -> _Index:
        return _Index(self.weight_codes)

    def traverse(self, ids: np.ndarray, root: np.ndarray, firsts: np.ndarray, start: int) -> np.ndarray:
        """The log-probability of every text's tokens; ``root`` has their weights at the root.

        A state is known by the last two words. So all places take their step at once:
        first the arcs of the words' states, which give the states before the next places.
        """
        arcs, weights, targets, fails, costs, state_of_word = self.parts
        before = np.append(start, ids[:-1])
        before[firsts[:-1]] = start
        state = state_of_word[before]

        def arcs_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The places among these whose state has an arc for their word, and the arcs."""
            at = at[ids[at] >= 0]
            arc = arcs.find(mix(state[at] << _BITS | ids[at]))
            return at[arc >= 0], arc[arc >= 0]

        total = root + costs[state]
        taken, arc = arcs_of(np.flatnonzero(state))
        total[taken] = weights[arc]
        after = state_of_word[ids]
        after[taken] = targets[arc]
        state[1:] = after[:-1]
        state[firsts[:-1]] = state_of_word[start]
        longer = np.flatnonzero(state > state_of_word.max(initial=0))
        total[longer] += costs[state[longer]]
        taken, arc = arcs_of(longer)
        total[taken] = weights[arc]
        return np.add.reduceat(total, firsts[:-1])


def _stored(spark: SparkSession, rows: DataFrame, folder: str, compression: str = "snappy") -> DataFrame:
    rows.write.mode("overwrite").option("compression", compression).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _in_parts(spark: SparkSession, rows_of: Callable[[int], DataFrame], folder: str) -> DataFrame:
    for part in range(PARTS):
        rows = rows_of(part)
        rows.write.mode("append" if part else "overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def train(spark: SparkSession, docs: DataFrame, folder: str, text: str = "text", least_count: int = LEAST_COUNT) -> Automaton:
    """Learns from all rows. What is not broadcast is stored in ``folder`` for ``score``."""
    with settings(spark, SHUFFLES_DELETED):
        return _trained(spark, docs, folder, text, least_count)


def _trained(spark: SparkSession, docs: DataFrame, folder: str, text: str, least_count: int) -> Automaton:
    counts = _stored(spark, count_words(docs, text), f"{folder}/words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = total["tokens"], total["types"]

    def least(most: int) -> int:
        """The count from which on something is broadcast; it has no say in what is kept."""
        return max(least_count, -(-tokens // most))

    weights, weight_counts = _arrays(counts.filter(F.col("n") >= least(MOST_WEIGHTS)), "n")

    buckets = PARTS * max(1, -(-tokens // (PARTS * BUCKET_TOKENS)))

    sequences = _in_parts(spark, lambda part: count_sequences(docs, least_count, part, PARTS, buckets, text), f"{folder}/sequences")
    hot_pairs, pair_counts, pair_left, pair_right = _hot_sequences(sequences, 0, least(MOST_ARCS))
    hot_triples, triple_counts, triple_left, triple_right = _hot_sequences(sequences, 1, least(MOST_ARCS))
    # frequent pairs have frequent words, and triples pairs
    pair_shares = (pair_counts - DISCOUNT) / weight_counts[_find(weights, pair_left)] if len(hot_pairs) else np.zeros(0)
    triple_shares = (triple_counts - DISCOUNT) / pair_counts[_find(hot_pairs, triple_left)] if len(hot_triples) else np.zeros(0)

    def root_share(n: np.ndarray) -> np.ndarray:
        return (n + 0.5) / (tokens + 0.5 * (types + 1))

    rare = _word_lists(counts.filter(F.col("n") < least(MOST_WEIGHTS)), buckets)
    hot_words = weights, weight_counts
    lowered = _stored(spark, _with_lower(spark, sequences, 0, hot_words, rare, root_share, "n", buckets), f"{folder}/lowered")
    pairs = _stored(spark, _with_share(spark, lowered, hot_words, rare, buckets), f"{folder}/pairs")
    delete_folder(spark, f"{folder}/lowered")
    weight_costs = _hot_costs(pairs, weights)

    costed = weights, weight_costs
    shares = _pair_lists(spark, pairs, costed, "first", buckets)
    lowered = _stored(spark, _with_lower(spark, sequences, 1, (hot_pairs, pair_shares), shares, lambda share: share, "value", buckets),
                      f"{folder}/lowered_triples")
    delete_folder(spark, f"{folder}/sequences")
    added = _pair_lists(spark, pairs, costed, "second", buckets)
    triples = _stored(spark, _with_share(spark, lowered, (hot_pairs, pair_counts), added, buckets), f"{folder}/triples")
    delete_folder(spark, f"{folder}/lowered_triples")
    pair_costs = _hot_costs(triples, hot_pairs)

    # what is added where the broadcast part took its failure arcs: words' root weights are taken as those of unknown ones
    _rare_words(pairs).write.mode("overwrite").parquet(f"{folder}/rare_words")
    for kind in (2, 0):  # pairs, then triples
        _rare_sequences(spark, triples, kind, least(MOST_ARCS), (hot_pairs, pair_costs), buckets).write.mode(
            "append" if kind == 0 else "overwrite").parquet(f"{folder}/rare_sequences")

    for name in ("words", "pairs", "triples"):
        delete_folder(spark, f"{folder}/{name}")
    core = (weight_counts >= least(MOST_ARCS)) | (weights == END)
    return Automaton(tokens, types, buckets, weights, weight_counts, weight_costs, weights[core], weight_costs[core],
                     hot_pairs, pair_left, pair_right, pair_shares, pair_costs, hot_triples, triple_left, triple_right, triple_shares)


def score(spark: SparkSession, docs: DataFrame, model: Automaton, counts_folder: str, folder: str,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row.

    ``folder`` takes the texts' tokens with the automaton's scores, and what is added for words, pairs
    and triples whose weights are in what ``train`` stored.
    """
    with settings(spark, SHUFFLES_DELETED):
        return _scored(spark, docs, model, counts_folder, folder, key, text)


_WEIGHTS = "bucket int, kind tinyint, codes binary, more binary"


def _rare_words(met: DataFrame) -> DataFrame:
    """``code``, and what is added at the root (``base``) and for the failure arc (``more``)."""
    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (code, n, more) in _bucket_rows(batches, code=np.int64, n=np.int64, second=np.float64):
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(np.log10((n + 0.5) / 0.5)), pa.array(more)], ["code", "base", "more"])

    rows = met.filter("kind = 2").select("bucket", "kind", "code", "n", "second")
    return rows.mapInArrow(flat, "code bigint, base double, more double")


def _rare_sequences(spark: SparkSession, met: DataFrame, kind: int, hot: int, costs: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """What is added for the sequences that are not broadcast, by bucket: pairs of the table (kind 2), or triples (0)."""
    shared = spark.sparkContext.broadcast(costs)

    def made(left: np.ndarray, code: np.ndarray, n: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[dict, np.ndarray]:
        more = first + second if kind == 2 else second - _of_hot(shared.value, left)
        own = n < hot
        return {"codes": code[own], "more": more[own]}, code[own]

    return _sent(met.filter(F.col("kind") == kind), _MET_COLUMNS, made, 0, buckets, _WEIGHTS)


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row there is and its values' sum."""
    if len(rows) and int(rows.max()) < 4 * len(rows):
        named = np.flatnonzero(np.bincount(rows))
        return named, np.bincount(rows, weights=values)[named]
    named, back = np.unique(rows, return_inverse=True)
    return named, np.bincount(back, weights=values, minlength=len(named)).astype(np.float64)


def _looked_up(texts: DataFrame, weights: DataFrame, model: Automaton, part: int) -> DataFrame:
    """``row`` and ``more``: what is added for the pairs and triples of this part that are not broadcast."""
    shared, buckets = texts.sparkSession.sparkContext.broadcast((_Index(model.pairs), _Index(model.triples))), model.buckets

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            codes, rows = (np.concatenate(x) for x in zip(*held, strict=True))
            base = int(rows.min()) if len(rows) else 0
            rows -= base
            short = np.uint16 if len(rows) and rows.max() < 1 << 16 else np.uint32
            made = _lists(_bucket_of(codes, buckets), 1, codes=codes, rows=rows.astype(short))
            return made.append_column("base", pa.array(np.full(made.num_rows, base)))

        held, size = [], 0
        for batch in batches:
            for names, tokens, firsts in _token_lists(batch):  # neighbours, of one task
                for hot, (_, _, codes, of) in zip(shared.value, _sequences(tokens, firsts), strict=True):
                    rare = np.flatnonzero(_bucket_of(codes, buckets) % LOOKUPS == part)
                    rare = rare[hot.find(codes[rare]) < 0]
                    held.append((codes[rare], names[of[rare]]))
                    size += len(rare)
                if size > _FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known, values, parts = None, None, None, []
        for batch in batches:
            bases, out = batch.column("base").to_pylist(), []
            asked = _bucket_rows([batch], codes=np.uint64, more=np.float64, rows=None)
            for base, (bucket, kind, (codes, more, rows)) in zip(bases, asked, strict=True):
                if bucket != last:
                    last, known, parts = bucket, None, []
                if kind == 0:  # weights come before the texts' codes
                    parts.append((codes, more))
                    continue
                if known is None:
                    known, values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0))
                    known, parts = _Index(known), []
                rows = rows.view(np.uint16 if len(rows) == 2 * len(codes) else np.uint32)
                at = known.find(codes)
                ok = at >= 0
                named, sums = _sums(rows[ok], values[at[ok]])
                out.append((base, named.astype(np.uint32), sums))
            if out:
                places = np.append(0, np.cumsum([len(x[1]) for x in out]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int64()), *(_packed(np.concatenate([x[i] for x in out]), places) for i in (1, 2))],
                    ["base", "rows", "more"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            rows, more = (np.concatenate(x) for x in zip(*held, strict=True))
            named, sums = _sums(rows, more)
            return pa.RecordBatch.from_arrays([pa.array(named.astype(np.int64) + last), pa.array(sums)], ["row", "more"])

        held, last = [], None
        for batch in batches:
            for base, rows, more in zip(batch.column("base").to_pylist(), _unpacked(batch, "rows", np.uint32),
                                        _unpacked(batch, "more", np.float64), strict=True):
                if base != last and held:
                    yield out()
                    held = []
                last = base
                held.append((rows, more))
        if held:
            yield out()

    asked = texts.select("row", "tokens").mapInArrow(listed, "bucket int, kind tinyint, codes binary, rows binary, base bigint")
    nothing = F.expr("X''")
    both = weights.filter(F.col("bucket") % LOOKUPS == part).withColumns(
        {"rows": nothing, "base": F.lit(0).cast("bigint")}).unionByName(asked.withColumn("more", nothing))
    sums = both.select("bucket", "kind", "codes", "more", "rows", "base").repartition("bucket").sortWithinPartitions(
        "bucket", "kind").mapInArrow(found, "base bigint, rows binary, more binary")
    # the texts that were asked for together meet again, a row for each bucket: not one for each text and bucket
    return sums.repartition("base").sortWithinPartitions("base").mapInArrow(added, "row bigint, more double")


def _scored(spark: SparkSession, docs: DataFrame, model: Automaton, counts_folder: str, folder: str, key: str, text: str) -> DataFrame:
    shared = spark.sparkContext.broadcast(model)

    def traversed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, row = shared.value, TaskContext.get().partitionId() << 40
        start = int(_find(automaton.words, np.array([END]))[0])
        weights = automaton.root_weights(np.append(automaton.weight_counts, 0))  # the last one is that of unknown words
        numbers = _find(automaton.words, automaton.weight_codes)
        for batch in batches:
            for piece in slices(batch, "text"):
                tokens, firsts = token_hashes(piece.column("text"))
                found = automaton.known_words.find(tokens)
                ids = numbers[found] if len(numbers) else np.full(len(tokens), -1)
                ids[found < 0] = -1
                costs = automaton.weight_costs[found] if len(automaton.weight_costs) else np.zeros(len(tokens))
                root = weights[found]
                base = np.add.reduceat(root, firsts[:-1])
                known = np.add.reduceat((found >= 0).astype(np.int64), firsts[:-1])
                # each word is the context of one other, as the start stands for the end
                backs = np.add.reduceat(np.where((found >= 0) & (ids < 0), costs, 0.0), firsts[:-1])
                scores = automaton.traverse(ids, root, firsts, start)
                n = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(np.arange(row, row + n)), pa.array(np.diff(firsts)), pa.array(known),
                     pa.array(base), pa.array(scores + backs), _packed(tokens, firsts),
                     pa.ListArray.from_arrays(np.append(0, np.add.accumulate(np.add.reduceat((found < 0).astype(np.int32), firsts[:-1]))).astype(np.int32),
                                              pa.array(tokens[found < 0].view(np.int64)))],
                    ["key", "row", "n_tokens", "n_known", "base_score", "score", "tokens", "rare"])
                row += n

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = (f"key {rows.schema['key'].dataType.simpleString()}, row bigint, n_tokens bigint, n_known bigint, "
              "base_score double, score double, tokens binary, rare array<bigint>")
    texts = _stored(spark, rows.mapInArrow(traversed, schema), f"{folder}/texts", "zstd")
    words = spark.read.schema("code bigint, base double, more double").parquet(f"{counts_folder}/rare_words")
    weights = spark.read.schema(_WEIGHTS).parquet(f"{counts_folder}/rare_sequences")
    sums = [F.sum(name).alias(name) for name in ("base", "more", "known")]
    of_words = texts.select("row", F.explode("rare").alias("code")).join(words, "code").withColumn("known", F.lit(1))
    _stored(spark, of_words.groupBy("row").agg(*sums), f"{folder}/sums")
    for part in range(LOOKUPS):
        added = _looked_up(texts, weights, model, part)
        added.select("row", F.lit(0.0).alias("base"), "more", F.lit(0).cast("bigint").alias("known")).write.mode("append").parquet(f"{folder}/sums")
    rest = spark.read.schema("row bigint, base double, more double, known bigint").parquet(f"{folder}/sums").groupBy("row").agg(*sums)
    base = F.coalesce("base", F.lit(0.0))
    return texts.drop("tokens", "rare").join(rest, "row", "left").select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + base).alias("base_score"),
        (F.col("score") + base + F.coalesce("more", F.lit(0.0))).alias("score"))
