"""Removal of lines that an earlier line equals up to a few edits, by deletion neighbourhoods.

Lines are ordered by document key and place. A line is removed if some earlier line is
equal to it, or becomes equal by inserting, deleting or replacing ``edits`` characters at most; lines
are judged on the input. Lines without any character but white space are kept and are no reason to remove
others. Lines of fewer than ``min_chars`` characters are compared for being equal only, as little tells
them apart. Equal lines have equal hashes of two kinds that have nothing to do with each other.

Two lines within the bound share a deletion variant: what is left of either when the characters
at the places of the edits are taken out. Variants are hashed with their places as keys and joined. In a
group of equal keys all lines are within the bound of each other, so the earliest one stands against all
others, and a group is reduced to its minimum and never paired up. Each line found is
verified against its earlier partner by their edit distance.

A line has a variant for each choice of places, so only lines and places are tried where an edit can be.
Of ``edits + 1`` parts of the shorter one of two such lines one is in the other, at most so many places
off; lines that share no part have no partner. With one edit (the production bound) either the first or
the second half agrees, and then all but one of ``REGIONS`` parts; parts outside which nothing is shared
are not tried. No variant of a pair is lost.

Inputs and results, also for odd ones: a null text has no lines, an empty one a single
empty line, which is kept. A row with null key keeps all its lines and is compared with
none. Rows repeated with one key count as one document. Lines of any length are compared
whole. Only the named columns are read, further ones are dropped. An empty table gives
an empty result. Lines end at line feeds only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repeats import with_texts
from .settings import SHUFFLES_DELETED, SMALL_BATCHES, settings
from .text_arrays import SpanHash, mix, slices

MIN_CHARS, REGIONS, EDITS = 20, 16, 1
BLANK = " \t\n\v\f\r"


def _characters(lines: list[str]) -> tuple[SpanHash, np.ndarray, np.ndarray]:
    """Hashes of any runs of characters of lines, and the lines' begins and lengths."""
    lengths = np.array([len(line) for line in lines], np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    return SpanHash(mix(codes.astype(np.uint64) + np.uint64(1))), np.cumsum(lengths) - lengths, lengths


def _half_keys(spans: SpanHash, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Four keys per line: both halves, of its length as the shorter line's and as the longer one's."""
    out = []
    for shorter in (length, length - 1):
        half, tag = shorter // 2, shorter.astype(np.uint64) * np.uint64(2)
        out.append(spans(begin, begin + half) ^ mix(tag))
        out.append(spans(begin + length - half, begin + length) ^ mix(tag + np.uint64(1)))
    return mix(np.stack(out, axis=1))


def _part_keys(spans: SpanHash, begin: np.ndarray, length: np.ndarray, edits: int) -> list[np.ndarray]:
    """Keys of every line's parts: as the shorter line's, and as what the longer one has in their places."""
    found: list[list[np.ndarray]] = []
    for spare in range(edits + 1):
        shorter = length - spare
        off = (edits - spare) // 2  # characters that the longer line may lack besides
        for part in range(edits + 1):
            a, b = part * shorter // (edits + 1), (part + 1) * shorter // (edits + 1)
            tag = mix((shorter * (edits + 1) + part).astype(np.uint64))
            for shift in {0, *range(-off, spare + off + 1)}:
                ok = (a + shift >= 0) & (b + shift <= length)
                at = np.where(ok, begin + a + shift, begin)
                found.append(np.where(ok, mix(spans(at, at + np.where(ok, b - a, 0)) ^ tag), np.uint64(0)))
    return [np.unique(row[row > 0]) for row in np.stack(found, axis=1)]


def _lines(docs: DataFrame, key: str, text: str, min_chars: int, edits: int) -> DataFrame:
    """``key``, ``line``, its number, the hashes ``code`` and ``check``, and ``parts`` for every line that is judged.

    Lines of fewer than ``min_chars`` characters have no ``parts``.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, numbers, lines = [], [], []
                for row, content in enumerate(part.column("text").to_pylist()):
                    for number, line in enumerate(content.split("\n") if content else ()):
                        if line.strip(BLANK):
                            rows.append(row)
                            numbers.append(number)
                            lines.append(line)
                if not lines:
                    continue
                spans, begin, length = _characters(lines)
                long = np.flatnonzero(length >= min_chars)
                if edits == 1:
                    parts = _half_keys(spans, begin[long], length[long])
                    sizes, keys = np.full(len(long), 4), parts.ravel()
                elif edits:
                    lists = _part_keys(spans, begin[long], length[long], edits)
                    sizes, keys = np.array([len(x) for x in lists], np.int64), np.concatenate([np.zeros(0, np.uint64), *lists])
                else:
                    sizes, keys = np.zeros(len(long), np.int64), np.zeros(0, np.uint64)
                count = np.zeros(len(lines), np.int64)
                count[long] = sizes
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(rows)), pa.array(numbers, pa.int32()),
                     pa.array(spans(begin, begin + length).view(np.int64)),
                     pa.array(np.array([xxhash.xxh3_64_intdigest(line.encode()) for line in lines], np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(np.append(0, np.cumsum(count)).astype(np.int32), pa.array(keys.view(np.int64)))],
                    ["key", "line", "code", "check", "parts"])

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(split, f"key {kind}, line int, code bigint, check bigint, parts array<bigint>")


def _contents(docs: DataFrame, places: DataFrame, key: str, text: str) -> DataFrame:
    """``code``, ``key``, ``line`` and ``content`` of lines given by ``key``, ``line`` and ``code``."""

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, texts = part.column("found").to_pylist(), part.column("text").to_pylist()
                rows = [i for i, places_ in enumerate(found) for _ in places_]
                lines = [p["line"] for places_ in found for p in places_]
                codes = [p["code"] for places_ in found for p in places_]
                split = [t.split("\n") for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes, pa.int64()), part.column("key").take(pa.array(rows)), pa.array(lines, pa.int32()),
                     pa.array([split[r][n] for r, n in zip(rows, lines, strict=True)], pa.string())],
                    ["code", "key", "line", "content"])

    texts = with_texts(docs, places, ["line", "code"], "inner", key, text)
    kind = texts.schema["key"].dataType.simpleString()
    return texts.mapInArrow(taken, f"code bigint, key {kind}, line int, content string")


def _region(shorter: np.ndarray, length: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a part begins and ends in a line of ``length``, counted on the ``shorter`` line's length."""
    return part * shorter // REGIONS, length - (shorter - (part + 1) * shorter // REGIONS)


def _region_keys(lines: DataFrame) -> DataFrame:
    """``code``, ``spare`` (characters more than the shorter line), ``part`` and ``outside``, the hash of what is around."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "content"):
                spans, begin, length = _characters(piece.column("content").to_pylist())
                row, spare, part = (x.ravel() for x in np.meshgrid(
                    np.arange(len(length)), np.arange(2), np.arange(REGIONS), indexing="ij"))
                shorter = length[row] - spare
                a, b = _region(shorter, length[row], part)
                outside = mix(spans(begin[row], begin[row] + a) ^ mix(
                    spans(begin[row] + b, begin[row] + length[row]) + (shorter * REGIONS + part).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("code").take(pa.array(row)), pa.array(spare.astype(np.int32)),
                     pa.array(part.astype(np.int32)), pa.array(outside.view(np.int64))],
                    ["code", "spare", "part", "outside"])

    return lines.select("code", "content").mapInArrow(keyed, "code bigint, spare int, part int, outside bigint")


def _variants(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """``variant`` and ``role`` for each line and each edit that its shared regions allow.

    Role 0: a character at one place replaced (both lines without it); role 1: the
    shorter line as it is; role 2: the longer one without a character.
    """

    def varied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "content"):
                spans, begin, length = _characters(piece.column("content").to_pylist())
                found = piece.column("found")
                regions_ = found.flatten()
                row = np.repeat(np.arange(piece.num_rows), np.diff(found.offsets.to_numpy()))
                spare, part = (regions_.field(f).to_numpy().astype(np.int64) for f in ("spare", "part"))
                n = length[row]
                a, b = _region(n - spare, n, part)
                count = b - a
                of = np.repeat(np.arange(len(row)), count)
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + a[of]
                at = begin[row[of]]
                left = spans(at, at + place)
                right = spans(at + place + 1, at + n[of])
                same = spare[of] == 0
                replaced = mix(left ^ mix(right + (n[of] << 32 | place).astype(np.uint64)))
                # the longer line without a character must equal the shorter one's own hash: hash it as one run
                whole = np.flatnonzero(spare == 0)
                codes = np.concatenate([replaced[same], piece.column("code").to_numpy()[row[whole]].view(np.uint64),
                                        spans.without(at, at + place, at + n[of])[~same]])
                owner = np.concatenate([row[of][same], row[whole], row[of][~same]])
                role = np.concatenate([np.zeros(same.sum(), np.int8), np.ones(len(whole), np.int8),
                                       np.full((~same).sum(), 2, np.int8)])
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c).take(pa.array(owner)) for c in ("code", "key", "line")),
                     pa.array(codes.view(np.int64)), pa.array(role)], ["code", "key", "line", "variant", "role"])

    lists = regions.groupBy("code").agg(F.collect_list(F.struct("spare", "part")).alias("found"))
    kind = lines.schema["key"].dataType.simpleString()
    return lines.join(lists, "code").mapInArrow(varied, f"code bigint, key {kind}, line int, variant bigint, role tinyint")


def _far_variants(lines: DataFrame, edits: int) -> DataFrame:
    """``variant`` of each line and each choice of ``edits`` places, for any bound.

    The key is what is left of the line and the places, counted in what is left. A place is named as often as
    edits may be there, and the line lacks as many characters there or fewer. So two lines of
    one key differ by ``edits`` edits at most.
    """
    def taken(line: str, places: tuple[int, ...], lacking: tuple[int, ...]) -> str | None:
        """What is left if before the characters at ``places`` so many are taken out."""
        left, at = [], 0
        for place, n in zip(places, lacking, strict=True):
            size = place - sum(map(len, left))
            left.append(line[at:at + size])
            at += size + n
        return "".join(left) + line[at:] if at <= len(line) else None

    def varied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                line, seen = batch.column("content")[row].as_py(), set()
                for chosen in combinations_with_replacement(range(len(line) + 1), edits):
                    places = Counter(chosen)
                    for lacking in product(*[range(n + 1) for n in places.values()]):
                        if len(line) - sum(lacking) >= chosen[-1] and (left := taken(line, tuple(places), lacking)) is not None:
                            seen.add(xxhash.xxh3_64_intdigest(f"{chosen}{left}".encode()))
                variants = np.fromiter(seen, np.uint64, len(seen)).view(np.int64)
                owner = pa.array(np.full(len(variants), row))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(owner) for c in ("code", "key", "line")), pa.array(variants),
                                                  pa.array(np.zeros(len(variants), np.int8))], ["code", "key", "line", "variant", "role"])

    kind = lines.schema["key"].dataType.simpleString()
    return lines.select("code", "key", "line", "content").mapInArrow(
        varied, f"code bigint, key {kind}, line int, variant bigint, role tinyint")


def _earlier_partners(variants: DataFrame) -> DataFrame:
    """``code`` and ``partner``: a line and an earlier one with an equal variant."""
    order = F.struct("key", "line", "code")
    kind = F.when(F.col("role") == 0, 0).otherwise(1)
    rows = variants.withColumn("kind", kind)
    groups = rows.groupBy("kind", "variant").agg(
        F.min(F.when(F.col("role") != 2, order)).alias("first"), F.min(F.when(F.col("role") == 2, order)).alias("longer"),
        F.min("code").alias("low"), F.max("code").alias("high"),
    ).filter("low <> high").drop("low", "high")
    partner = F.when(F.col("role") == 1, F.col("longer")).otherwise(F.col("first"))
    return (rows.join(groups, ["kind", "variant"]).withColumn("partner", partner).filter(F.col("partner") < order)
            .select("code", F.col("partner.code").alias("partner")).distinct())


def _stored(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    with settings(spark, SHUFFLES_DELETED, SMALL_BATCHES):
        rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _near_pairs(spark: SparkSession, contents: DataFrame, edits: int, folder: str) -> DataFrame:
    if edits != 1:
        return _earlier_partners(_far_variants(contents, edits))
    regions = _stored(_region_keys(contents), spark, f"{folder}/regions")
    common = regions.groupBy("outside").agg(F.count("*").alias("n")).filter("n > 1").select("outside")
    return _earlier_partners(_variants(contents, regions.join(common, "outside").select("code", "spare", "part")))


def repeated_lines(spark: SparkSession, docs: DataFrame, folder: str, min_chars: int = MIN_CHARS, edits: int = EDITS,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``line`` of all lines to be removed. ``folder`` takes intermediate tables."""
    lines = _lines(docs, key, text, max(2, edits + 1, min_chars), edits)
    places = _stored(lines.select("key", "line", "code", "check"), spark, f"{folder}/places")
    distinct = _stored(lines.groupBy("code", "check").agg(F.min(F.struct("key", "line")).alias("at"), F.count("*").alias("times"),
                                                          F.first("parts").alias("parts")), spark, f"{folder}/distinct")
    firsts = distinct.filter("times > 1").select("code", "check", "at")
    later = places.join(firsts, ["code", "check"]).filter(F.struct("key", "line") > F.col("at")).select("key", "line")
    if not edits:
        return later.distinct()
    parts = distinct.select("code", F.explode("parts").alias("part"))
    shared = parts.groupBy("part").agg(F.min("code").alias("x"), F.max("code").alias("y")).filter("x <> y").select("part")
    near = parts.join(shared, "part").select("code").distinct()
    first = distinct.join(near, "code", "left_semi").select("at.key", "at.line", "code")
    contents = _stored(_contents(docs, first, key, text), spark, f"{folder}/contents")
    pairs = _near_pairs(spark, contents, edits, folder)
    own, other = (contents.select(F.col("code").alias(c), F.col("content").alias(f"{c}_content")) for c in ("code", "partner"))
    verified = (pairs.join(own, "code").join(other, "partner")
                .filter(F.levenshtein("code_content", "partner_content", edits).between(0, edits)).select("code").distinct())
    return later.unionByName(places.join(_stored(verified, spark, f"{folder}/near"), "code", "left_semi")
                             .select("key", "line")).distinct()


def remove_lines(spark: SparkSession, docs: DataFrame, folder: str, min_chars: int = MIN_CHARS, edits: int = EDITS,
                 key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``key``, ``n_lines``, ``removed`` (line numbers, from 0) and ``kept``, the other lines.

    ``keep`` names columns to carry along; they must not be called like the result's.
    """
    repeated = repeated_lines(spark, docs, folder, min_chars, edits, key, text)
    texts = with_texts(docs, repeated, ["line"], "left", key, text, keep)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, removed, kept = [], [], []
                for content, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist(), strict=True):
                    lines = [] if content is None else content.split("\n")
                    gone = {f["line"] for f in found or ()}
                    counts.append(len(lines))
                    removed.append(sorted(gone))
                    kept.append("\n".join([line for n, line in enumerate(lines) if n not in gone]) if gone else content or "")
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.int32())),
                     pa.array(kept, pa.string()), *(part.column(c) for c in keep)],
                    ["key", "n_lines", "removed", "kept", *keep])

    new = "n_lines bigint, removed array<int>, kept string"
    schema = T.StructType([texts.schema["key"], *T.StructType.fromDDL(new).fields, *(texts.schema[c] for c in keep)])
    return texts.mapInArrow(cut, schema).withColumnRenamed("key", key)
