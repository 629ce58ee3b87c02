"""Approximate nearest neighbours by inner product, with multiprobe p-stable hashing.

Vectors get one more component that makes all of them equally long, so that the largest
inner product is the smallest distance. This is done within ranges of norms, each
with its own scale, so short vectors are told apart as well as long ones; a range of few
vectors is not hashed and searched whole. Each table hashes by ``hashes`` Gaussian
projections cut into cells of ``WIDTH``. A query visits its own bucket and perturbed
ones, whose cells lie one to either side, in the order of their estimated success: the
sum of squared distances from the query's projections to the cells' borders. All vectors
of the visited buckets are candidates and are ranked by exact inner products in double
precision; the tables' candidates are merged. A query that has found fewer than it could
have is sent to all vectors.

Every vector is indexed. Buckets are dealt out in blocks of at most about
``BLOCK_ROWS`` vectors and queries are sent to each block of a bucket, so a bucket of any
size is searched whole, with one block in memory at a time. Projections are drawn from a
fixed seed and need no sample.

Inputs and results, also for odd ones: a vector that is null or zero, or holds null or
non-finite components, takes no part, nor does one whose length is not the most frequent
one; as a query it gets no rows. Vectors may be as long or short as doubles can say; inner products
that doubles can't say are infinite, or NaN, which counts as the least. Rows with null id take no part. Rows repeated with one
id are one candidate. Equal scores go to the smaller id. With fewer candidates than
wanted all candidates are returned. Only the named columns are read, further ones
are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .text_arrays import mix

TABLES, WIDTH, BLOCK_ROWS = 4, 1.5, 4096
#: Longest to shortest norm of a range, vectors from which on a range is hashed, and the bucket of those that are not.
RATIO, HASHED_ROWS, WHOLE = 1.25, 256, 0


def _hashes(vectors: int) -> int:
    """Projections of a table, so that buckets stay at some hundred vectors."""
    return min(8, max(4, round(math.log(max(vectors, 1) / 256, 4))))


def _probes(hashes: int) -> int:
    """Buckets to visit in a table; the number of near ones grows with the projections."""
    return 30 * 3 ** (hashes - 4)


@dataclass
class Index:
    longest: float
    planes: np.ndarray  # table x dimension x projection
    shifts: np.ndarray  # table x projection
    probes: int
    tag: int = 0  # of its buckets

    @classmethod
    def of(cls, dimension: int, vectors: int, longest: float, tag: int = 0, tables: int = TABLES, seed: int = 11) -> Index:
        rng, hashes = np.random.default_rng(seed), _hashes(vectors)
        return cls(longest, rng.standard_normal((tables, dimension + 1, hashes)), rng.uniform(0, 1, (tables, hashes)),
                   _probes(hashes), tag)

    def _places(self, points: np.ndarray, table: int) -> np.ndarray:
        return points @ self.planes[table] / WIDTH + self.shifts[table]

    def _codes(self, cells: np.ndarray, table: int) -> np.ndarray:
        code = np.full(cells.shape[:-1], self.tag * len(self.planes) + table + 1, np.uint64)
        for i in range(cells.shape[-1]):
            code = mix(code ^ cells[..., i].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return code.view(np.int64)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's bucket in every table."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("vd,vd->v", scaled, scaled)))
        points = np.column_stack([scaled, rest])
        return np.stack([self._codes(np.floor(self._places(points, t)), t) for t in range(len(self.planes))], axis=1)

    def visits(self, queries: np.ndarray) -> np.ndarray:
        """The buckets that each query visits, of all tables, most promising first in each."""
        points = np.column_stack([queries / norms_of(queries)[:, None], np.zeros(len(queries))])
        hashes = self.planes.shape[2]
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=hashes)))
        out = []
        for table in range(len(self.planes)):
            places = self._places(points, table)
            cells = np.floor(places)
            inside = places - cells
            borders = np.stack([inside**2, np.zeros_like(inside), (1 - inside) ** 2], axis=2)
            cost = sum(borders[:, i, steps[:, i] + 1] for i in range(hashes))
            best = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
            out.append(self._codes(cells[:, None, :] + steps[best], table))
        return np.concatenate(out, axis=1)


@dataclass
class Ranges:
    """The indexes of all ranges of norms that are hashed, by the range's number."""

    longest: float
    indexes: dict[int, Index]

    def buckets(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that vectors are in, and whose each is."""
        ranges = range_of(norms_of(vectors), self.longest)
        hashed = np.isin(ranges, list(self.indexes))
        codes, owners = [np.full((~hashed).sum(), WHOLE, np.int64)], [np.flatnonzero(~hashed)]
        for number in np.unique(ranges[hashed]).tolist():
            own = np.flatnonzero(ranges == number)
            found = self.indexes[number].buckets(vectors[own])
            codes.append(found.ravel())
            owners.append(np.repeat(own, found.shape[1]))
        return np.concatenate(codes), np.concatenate(owners)

    def visits(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets that queries visit, and whose visit each is."""
        found = [np.full((len(queries), 1), WHOLE, np.int64), *(index.visits(queries) for index in self.indexes.values())]
        return (np.concatenate([f.ravel() for f in found]),
                np.concatenate([np.repeat(np.arange(len(queries)), f.shape[1]) for f in found]))


def norms_of(vectors: np.ndarray) -> np.ndarray:
    """The norms, by way of the largest component, whose square may be no double."""
    largest = np.abs(vectors).max(axis=1)
    norms = largest * np.linalg.norm(vectors / largest[:, None], axis=1)
    return np.minimum(norms, np.finfo(np.float64).max)


def range_of(norms: np.ndarray, longest: float) -> np.ndarray:
    """The number of each norm's range, 0 for the longest."""
    return np.maximum(0, np.floor((math.log(longest) - np.log(norms)) / math.log(RATIO))).astype(np.int64)


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``key``, ``vector`` (double) and ``norm`` of the vectors that take part, whatever their length."""
    rows = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")).filter(
        F.col("key").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    filled = rows.withColumn("largest", largest).filter("largest > 0")
    share = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    norm = F.least(F.col("largest") * F.sqrt(share), F.lit(float(np.finfo(np.float64).max)))
    return filled.withColumn("norm", norm).drop("largest")


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimension)


def _hashed(rows: DataFrame, codes_of, dimension: int) -> DataFrame:
    """``bucket``, ``key`` and ``vector`` for each bucket that ``codes_of`` gives."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                part = batch.slice(begin, 100)
                codes, owners = codes_of(_matrix(part.column("vector"), dimension))
                for some in range(0, len(codes), 20000):
                    at = pa.array(owners[some:some + 20000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[some:some + 20000]), part.column("key").take(at), part.column("vector").take(at)],
                        ["bucket", "key", "vector"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.select("key", "vector").mapInArrow(hashed, f"bucket bigint, key {kind}, vector array<double>")


def _searched(rows: DataFrame, dimension: int, most: int) -> DataFrame:
    """``query``, ``key`` and ``score``: each query's best in each block of a bucket it visits."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, keys, vectors = None, [], []
        for batch in batches:
            places = np.stack([batch.column("bucket").to_numpy(), batch.column("block").to_numpy()], axis=1)
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.any(places[1:] != places[:-1], axis=1) | (asks[1:] != asks[:-1])) + 1
            for begin, end in itertools.pairwise([0, *cuts.tolist(), len(asks)]):
                if begin == end:
                    continue
                if (at := tuple(places[begin])) != block:
                    block, keys, vectors = at, [], []
                own, matrix = batch.column("key").slice(begin, end - begin), _matrix(
                    batch.column("vector").slice(begin, end - begin), dimension)
                if not asks[begin]:
                    keys.append(own)
                    vectors.append(matrix)
                elif keys:
                    if len(keys) > 1:
                        keys, vectors = [pa.concat_arrays(keys)], [np.concatenate(vectors)]
                    yield from best(own, matrix, keys[0], vectors[0])

    def best(queries: pa.Array, asked: np.ndarray, keys: pa.Array, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        # ties are cut by the smaller key: stand in the order of the keys, then sort stably
        order = np.argsort(keys.to_numpy(zero_copy_only=False), kind="stable")
        names = keys.to_numpy(zero_copy_only=False)[order]
        vectors = vectors[order]
        firsts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        order, names = order[firsts], names[firsts]
        for begin in range(0, len(asked), 256):
            some = queries.slice(begin, 256)
            # no matrix product: equal vectors must get equal sums
            with np.errstate(over="ignore", invalid="ignore"):
                scores = np.einsum("qd,vd->qv", asked[begin:begin + 256], vectors)
            if len(firsts) < len(vectors):  # rows repeated with one id are one candidate
                scores = np.maximum.reduceat(scores, firsts, axis=1)
            own = some.to_numpy(zero_copy_only=False)[:, None] == names
            place = np.where(np.isnan(scores) | own, np.inf, -scores)
            top = np.argsort(place, axis=1, kind="stable")[:, :most + 1]
            real = ~np.take_along_axis(own, top, axis=1)
            real &= np.cumsum(real, axis=1) <= most
            found, real = np.take_along_axis(scores, top, axis=1).ravel(), real.ravel()
            at = np.repeat(np.arange(len(some)), top.shape[1])[real]
            yield pa.RecordBatch.from_arrays(
                [some.take(pa.array(at)), keys.take(pa.array(order[top.ravel()[real]])), pa.array(found[real])],
                ["query", "key", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    ordered = rows.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "asks")
    return ordered.mapInArrow(searched, f"query {kind}, key {kind}, score double")


def _range_sizes(rows: DataFrame, longest: float) -> list:
    """``number``, ``n`` and ``longest`` of the ranges that are hashed: few rows, as norms differ by powers."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = batch.column("norm").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(range_of(norms, longest)), batch.column("norm")], ["number", "norm"])

    return (rows.select("norm").mapInArrow(numbered, "number bigint, norm double").groupBy("number")
            .agg(F.count("*").alias("n"), F.max("norm").alias("longest")).filter(F.col("n") >= HASHED_ROWS)
            .orderBy("number").collect())


def _answers(indexed: DataFrame, asking: DataFrame, blocks: DataFrame, dimension: int, most: int) -> DataFrame:
    """``query``, ``key`` and ``score``: the best of all blocks of the buckets that queries are sent to."""
    placed = indexed.join(blocks, "bucket").select(
        "bucket", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("asks"),
        "key", "vector")
    sent = asking.join(blocks, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"),
        "key", "vector")
    number = F.max(F.when(~F.isnan("score"), F.col("score")))
    found = _searched(placed.unionByName(sent), dimension, most).groupBy("query", "key").agg(
        F.coalesce(number, F.lit(float("nan"))).alias("score"))
    order = Window.partitionBy("query").orderBy(F.isnan("score"), F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def nearest(rows: DataFrame, queries: Column, most: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, the neighbour's ``key`` and ``score`` for the rows that ``queries`` selects."""
    spark = rows.sparkSession
    usable_rows = usable(rows, key, vector)
    sizes = usable_rows.groupBy(F.size("vector").alias("dimension")).agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    common = sizes.orderBy(F.desc("n"), "dimension").first()
    dimension, longest = (common["dimension"], common["longest"]) if common else (1, 1.0)
    indexed = usable_rows.filter(F.size("vector") == dimension)
    ranges = Ranges(longest, {r["number"]: Index.of(dimension, r["n"], r["longest"], r["number"])
                              for r in _range_sizes(indexed, longest)})
    asking = usable(rows.filter(queries), key, vector).filter(F.size("vector") == dimension)
    stored = _hashed(indexed, ranges.buckets, dimension)
    blocks = stored.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    found = _answers(stored, _hashed(asking, ranges.visits, dimension), blocks, dimension, most)
    folder = scratch_folder(spark, "neighbours")
    found.write.mode("overwrite").parquet(folder)
    first = spark.read.schema(found.schema).parquet(folder)
    # no query can have more than all other ids
    wanted = min(most, indexed.select("key").distinct().limit(most + 1).count() - 1)
    enough = first.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") >= wanted).select(F.col("query").alias("key"))
    short = asking.join(enough, "key", "left_anti").select(F.lit(WHOLE).cast("bigint").alias("bucket"), "key", "vector")
    if wanted > 0 and not short.isEmpty():
        whole = spark.range(1).select(F.lit(WHOLE).cast("bigint").alias("bucket"), F.lit(
            -(-(common["n"] if common else 0) // BLOCK_ROWS)).cast("int").alias("blocks"))
        all_rows = indexed.select(F.lit(WHOLE).cast("bigint").alias("bucket"), "key", "vector")
        rest = _answers(all_rows, short, whole, dimension, most)
        first = first.join(enough.withColumnRenamed("key", "query"), "query", "left_semi").unionByName(rest)
    return first.select(F.col("query").alias("query_id"), "rank", F.col("key").alias(key), "score")
