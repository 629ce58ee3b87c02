"""Clusters of vectors around centroids, through a file of compressed vectors (VA-file).

Every vector is compressed to one cell of a few bits per dimension. A dimension's cells are of
equal width where nearly all vectors are, and wider in the tails. For a round's centroids two
small tables say how much a dimension adds at least and at most to the squared distance,
for each cell. Summed up over a vector's cells they give an interval for its distance to
each centroid. Where one interval lies below all others, the vector's cluster is known
from its cells alone; only where intervals overlap, the full vector is fetched.

A round needs the full vectors of two kinds of rows: those with overlapping intervals, and
those whose cluster has changed, as a centroid's sum changes by these only. The first round
and the last one, which returns all distances, read every vector. The other rounds scan the
compressed vectors and join the rows to be fetched with the vectors by row number.

Only the centroids, the cells' edges and a centroid's sums come to the driver: numbers that
depend on dimensions and clusters. Tasks add up their rows before anything is shuffled.

Components become integers, ``floor(scale * x)``, and everything is exact, whatever their size:

* Vectors that are null, have another number of components, or hold null, NaN or infinite
  ones take no part and are not returned. No vector left gives an empty table.
* Components beyond 2**22 are computed with Python's integers; such a vector has no cells
  and is fetched in each round. A distance or sum of distances beyond 64 bits is null.
* The first centroids are the vectors with the smallest SHA-256 of ``seed:id``, the smaller
  vector first where one id is repeated. Rows without id are clustered, but are none of them.
  Fewer vectors than clusters give as many centroids as there are vectors; equal vectors may
  be two centroids, of which the second stays empty and keeps its place.
* Rows repeated are rows of their own. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Integers up to this size have exact squared distances as doubles, in up to 128 dimensions.
PLAIN = 1 << 22
#: Sums travel in parts of so many bits.
LIMB = 48
MOST_LONG = (1 << 63) - 1

Centroid = list[int]


# --- numbers of one batch ------------------------------------------------------

def whole_numbers(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` as doubles, and which rows are exact that way; the other rows' numbers are void."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    return scaled, (np.abs(scaled) <= PLAIN).all(axis=1)


def exact_numbers(vector: np.ndarray, scale: int) -> Centroid:
    """``floor(scale * x)`` of one vector, without any bound."""
    return [n * scale // d for n, d in (float(x).as_integer_ratio() for x in vector)]


def exact_distances(vector: Centroid, centroids: list[Centroid]) -> list[int]:
    return [sum((x - y) ** 2 for x, y in zip(vector, c, strict=True)) for c in centroids]


def nearest(values: np.ndarray, centroids: list[Centroid], scale: int) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """Cluster and distance of every vector, its numbers, and which rows of these are exact."""
    numbers, plain = whole_numbers(values, scale)
    cluster, distance = np.zeros(len(values), np.int64), [0] * len(values)
    small = [k for k, c in enumerate(centroids) if max(map(abs, c)) <= PLAIN]
    large = [k for k in range(len(centroids)) if k not in small]
    rows = np.flatnonzero(plain)
    if small and len(rows):
        points = np.array([centroids[k] for k in small], np.float64)
        # whole numbers below 2**53 throughout, so no rounding
        found = ((numbers[rows] ** 2).sum(1)[:, None] - 2 * (numbers[rows] @ points.T) + (points ** 2).sum(1)[None, :])
        best = found.argmin(axis=1)
        cluster[rows] = np.array(small)[best]
        for row, d in zip(rows.tolist(), found[np.arange(len(rows)), best].astype(np.int64).tolist(), strict=True):
            distance[row] = d
    for row in range(len(values)) if large else np.flatnonzero(~plain).tolist():
        vector = exact_numbers(values[row], scale)
        tried = large if plain[row] and small else range(len(centroids))
        options = [(d, k) for k, d in zip(tried, exact_distances(vector, [centroids[k] for k in tried]), strict=True)]
        if plain[row] and small:
            options.append((distance[row], int(cluster[row])))
        distance[row], cluster[row] = min(options)
    return cluster, distance, numbers, plain


# --- cells ---------------------------------------------------------------------

@dataclass(frozen=True)
class Cells:
    """The cells of every dimension: the first number of each, and the last number of the last."""
    firsts: list[list[int]]
    lasts: list[int]
    bits: int

    def of(self, numbers: np.ndarray) -> np.ndarray:
        found = np.empty(numbers.shape, np.uint8)
        for d, first in enumerate(self.firsts):
            found[:, d] = np.searchsorted(np.array(first[1:], np.float64), numbers[:, d], side="right")
        return found

    def pack(self, cells: np.ndarray) -> list[bytes]:
        """``bits`` bits for each dimension."""
        bits = (cells[:, :, None] >> np.arange(self.bits, dtype=np.uint8)) & 1
        return [row.tobytes() for row in np.packbits(bits.reshape(len(cells), -1), axis=1)]

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        bits = np.unpackbits(rows, axis=1)[:, :len(self.firsts) * self.bits].reshape(len(packed), -1, self.bits)
        return (bits << np.arange(self.bits, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)

    def tables(self, centroids: list[Centroid]) -> np.ndarray:
        """Least and greatest squared difference, by dimension, cell, and centroid (least ones first)."""
        found = np.zeros((len(self.firsts), 1 << self.bits, 2 * len(centroids)))
        for d, (first, last) in enumerate(zip(self.firsts, self.lasts, strict=True)):
            for cell, low in enumerate(first):
                high = first[cell + 1] - 1 if cell + 1 < len(first) else last
                for k, c in enumerate(centroids):
                    outside = max(low - c[d], c[d] - high, 0)
                    found[d, cell, k] = _double(outside * outside)
                    found[d, cell, len(centroids) + k] = _double(max(abs(low - c[d]), abs(high - c[d])) ** 2)
        return found


def _double(value: int) -> float:
    return float(value) if value < 1 << 1000 else np.inf


def decided(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The cluster of every row of cells, or -1 where intervals of distance overlap."""
    k = tables.shape[2] // 2
    bounds = np.zeros((len(cells), 2 * k))
    for d in range(cells.shape[1]):
        bounds += tables[d, cells[:, d]]
    least, greatest = bounds[:, :k] * (1 - 1e-9), bounds[:, k:] * (1 + 1e-9)  # sums of doubles are rounded
    possible = least <= greatest.min(axis=1, keepdims=True)
    return np.where(possible.sum(axis=1) == 1, possible.argmax(axis=1), -1)


# --- over tables ---------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class _Sums:
    """A task's change of every centroid's sum and number of vectors."""

    def __init__(self, clusters: int, dimensions: int):
        self.sums = [[0] * (dimensions + 1) for _ in range(clusters)]

    def add(self, cluster: np.ndarray, numbers: np.ndarray, plain: np.ndarray, values: np.ndarray, scale: int, sign: int) -> None:
        for k in np.unique(cluster[cluster >= 0]).tolist():
            held = cluster == k
            new = numbers[held & plain].sum(axis=0).astype(np.int64).tolist()
            for row in np.flatnonzero(held & ~plain).tolist():
                new = [x + y for x, y in zip(new, exact_numbers(values[row], scale), strict=True)]
            self.sums[k] = [x + sign * y for x, y in zip(self.sums[k], [*new, int(held.sum())], strict=True)]

    def rows(self) -> Iterator[tuple[int, int, list[int]]]:
        """Cluster, number of the part, and that part of ``LIMB`` bits of its sums and of its number of vectors."""
        for k, row in enumerate(self.sums):
            rest, limb = [abs(value) for value in row], 0
            while any(rest):
                yield k, limb, [(-1 if value < 0 else 1) * (r & ((1 << LIMB) - 1)) for value, r in zip(row, rest, strict=True)]
                rest, limb = [r >> LIMB for r in rest], limb + 1


_SETTLED = "rid bigint, cells binary, cluster int, limb int, parts array<bigint>, is_sum boolean"


def _settle(rows: DataFrame, centroids: list[Centroid], cells: Cells, scale: int) -> DataFrame:
    """From ``rid``, ``cells``, ``vector`` and the ``cluster`` before (-1: none): the clusters, and each task's sums by cluster."""
    tables, dimensions = cells.tables(centroids), len(cells.firsts)
    names = ["rid", "cells", "cluster", "limb", "parts", "is_sum"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(len(centroids), dimensions)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column("vector"))
            cluster = _clusters(batch.column("cells"), cells, tables)
            open_ = np.flatnonzero(cluster < 0)
            cluster[open_] = nearest(values[open_], centroids, scale)[0]
            before = batch.column("cluster").to_numpy()
            moved = np.flatnonzero(cluster != before)
            numbers, plain = whole_numbers(values[moved], scale)
            sums.add(cluster[moved], numbers, plain, values[moved], scale, 1)
            sums.add(before[moved], numbers, plain, values[moved], scale, -1)
            n = len(cluster)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("cells"), pa.array(cluster.astype(np.int32)), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.list_(pa.int64())), pa.array(np.zeros(n, bool))], names)
        for k, limb, parts in sums.rows():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([limb], pa.int32()),
                 pa.array([parts], pa.list_(pa.int64())), pa.array([True])], names)

    return rows.select("rid", "cells", "vector", "cluster").mapInArrow(settle, _SETTLED)


def _clusters(packed: pa.Array, cells: Cells, tables: np.ndarray) -> np.ndarray:
    """The clusters that the cells decide, -1 for the other rows."""
    found = np.full(len(packed), -1, np.int64)
    rows = np.flatnonzero(packed.is_valid().to_numpy(zero_copy_only=False))
    if len(rows):
        found[rows] = decided(cells.unpack(packed.take(pa.array(rows)).to_pylist()), tables)
    return found


def _scan(rows: DataFrame, centroids: list[Centroid], cells: Cells) -> DataFrame:
    """From ``rid``, ``cells`` and ``cluster``: ``now``, and whether the full vector has to be fetched."""
    tables = cells.tables(centroids)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now = _clusters(batch.column("cells"), cells, tables)
            fetch = (now < 0) | (now != batch.column("cluster").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("cells"), batch.column("cluster"), pa.array(now.astype(np.int32)), pa.array(fetch)],
                ["rid", "cells", "cluster", "now", "fetch"])

    return rows.select("rid", "cells", "cluster").mapInArrow(scan, "rid bigint, cells binary, cluster int, now int, fetch boolean")


def _compressed(rows: DataFrame, cells: Cells, scale: int) -> DataFrame:
    """``id``, ``vector`` and ``cells``, null for vectors of very large numbers."""
    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes | None] = [None] * batch.num_rows
            if batch.num_rows:
                numbers, plain = whole_numbers(_matrix(batch.column("vector")), scale)
                held = np.flatnonzero(plain)
                for row, code in zip(held.tolist(), cells.pack(cells.of(numbers[held])), strict=True):
                    packed[row] = code
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), pa.array(packed, pa.binary())],
                                             ["id", "vector", "cells"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vector").mapInArrow(compress, f"id {kind}, vector array<double>, cells binary")


def _edges(low: int, left: int, right: int, high: int, cells: int) -> list[int]:
    """The first number of every cell: equal cells from ``left`` to ``right``, and wider and wider ones in the tails."""
    tail = min(4, cells // 4)
    core = cells - 2 * tail
    width = max(1, -(-(right - left + 1) // core))
    inner = [left + width * i for i in range(core + 1)]
    out = [width * ((1 << i) - 1) for i in range(1, tail)]
    return sorted({low, *[x for x in [left - o for o in out] + inner + [inner[-1] + o for o in out] if low < x <= high]})


def find_cells(rows: DataFrame, dimensions: int, scale: int, bits: int) -> Cells:
    """Cells of every dimension from the least, the greatest, and two approximate quantiles of all vectors."""
    number = [F.floor(F.col("vector")[d] * float(scale)) for d in range(dimensions)]
    small = rows.filter(F.forall("vector", lambda x: F.abs(x * float(scale)) < float(PLAIN)))
    seen = small.agg(*[F.struct(F.min(x).alias("low"), F.max(x).alias("high"), F.percentile_approx(x, [0.001, 0.999], 10000).alias("cut"))
                       .alias(f"d{d}") for d, x in enumerate(number)]).first()
    found = [(s["low"], *s["cut"], s["high"]) if s["low"] is not None else (0, 0, 0, 0) for s in seen]
    return Cells([_edges(*edge, 1 << bits) for edge in found], [edge[-1] for edge in found], bits)


def _first_centroids(rows: DataFrame, clusters: int, scale: int, seed: int) -> list[Centroid]:
    named = rows.filter(F.col("id").isNotNull())
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = named.select(order.alias("hash"), "vector").orderBy("hash", "vector").limit(clusters).collect()
    return [exact_numbers(np.array(r["vector"]), scale) for r in chosen]


def _moved(centroids: list[Centroid], sums: list[list[int]], parts: DataFrame) -> list[Centroid]:
    """The centroids after a round; ``sums`` are brought up to date."""
    width = len(sums[0])
    total = parts.groupBy("cluster", "limb").agg(
        F.array(*[F.sum(F.col("parts")[d].cast("decimal(38,0)")) for d in range(width)]).alias("parts"))
    for r in total.collect():  # clusters times parts
        row = sums[r["cluster"]]
        row[:] = [x + (int(part) << (LIMB * r["limb"])) for x, part in zip(row, r["parts"], strict=True)]
    return [[x // row[-1] for x in row[:-1]] if row[-1] else c for c, row in zip(centroids, sums, strict=True)]


def _long_total(name: str) -> Column:
    """The sum as a long, null where a part is null or the sum does not fit."""
    total = F.sum(F.col(name).cast("decimal(38,0)"))
    return F.when((F.count(name) == F.count("*")) & (total <= MOST_LONG), total).cast("bigint")


def cluster_vectors(spark: SparkSession, vectors: DataFrame, place: str, key: str = "vec_id", vector: str = "embedding",
                    dimensions: int = 64, clusters: int = 16, rounds: int = 3, scale: int = 64, bits: int = 6,
                    seed: int = 1) -> DataFrame:
    """Every vector's ``key``, ``cluster`` and squared ``distance`` to its ``centroid``, an array of decimal numbers.

    ``rounds`` times, vectors go to the nearest centroid (the first of equals) and centroids to the
    floor of their vectors' mean; then vectors are assigned once more. A cell takes 2 to 8 ``bits``.
    Tables are written below ``place``.
    """
    raw = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = raw.filter((F.size("vector") == dimensions) & finite)
    centroids = _first_centroids(kept, clusters, scale, seed)
    if not centroids:  # vectors without an id may still be there
        return kept.select(F.col("id").alias(key), *[F.lit(None).cast(t).alias(c) for c, t in
                           (("cluster", "int"), ("distance", "bigint"), ("centroid", "array<string>"))]).filter("false")
    cells = find_cells(kept, dimensions, scale, bits)
    _compressed(kept, cells, scale).withColumn("rid", F.monotonically_increasing_id()).write.parquet(f"{place}/vectors")
    table = spark.read.parquet(f"{place}/vectors")
    sums = [[0] * (dimensions + 1) for _ in centroids]
    state = table
    for number in range(rounds):
        out = f"{place}/round{number}"
        if number:
            _scan(state, centroids, cells).write.partitionBy("fetch").parquet(f"{out}/scanned")
            scanned = spark.read.schema("rid bigint, cells binary, cluster int, now int, fetch boolean").parquet(f"{out}/scanned")
            fetched = scanned.filter("fetch").join(table.select("rid", "vector"), "rid")
        else:
            fetched = table.withColumn("cluster", F.lit(-1))
        _settle(fetched, centroids, cells, scale).write.partitionBy("is_sum").parquet(f"{out}/settled")
        settled = spark.read.schema(_SETTLED).parquet(f"{out}/settled")
        centroids = _moved(centroids, sums, settled.filter("is_sum"))
        state = settled.filter("NOT is_sum").select("rid", "cells", "cluster")
        if number:
            known = scanned.filter("NOT fetch").select("rid", "cells", F.col("now").alias("cluster"))
            state = state.unionByName(known)
    return _assigned(table, centroids, cells, scale).withColumnRenamed("id", key)


def _assigned(table: DataFrame, centroids: list[Centroid], cells: Cells, scale: int) -> DataFrame:
    """``id``, ``cluster``, ``distance`` and ``centroid`` of all vectors."""
    tables = cells.tables(centroids)
    texts = [[str(x) for x in c] for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column("vector"))
            cluster = _clusters(batch.column("cells"), cells, tables)
            distance: list[int] = [0] * len(cluster)
            for k in np.unique(cluster).tolist():
                rows = np.flatnonzero(cluster == k)
                near, found, _, _ = nearest(values[rows], centroids if k < 0 else [centroids[k]], scale)
                if k < 0:
                    cluster[rows] = near
                for row, d in zip(rows.tolist(), found, strict=True):
                    distance[row] = d
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)),
                 pa.array([d if d <= MOST_LONG else None for d in distance], pa.int64()),
                 pa.array(texts, pa.list_(pa.string())).take(pa.array(cluster))],
                ["id", "cluster", "distance", "centroid"])

    kind = table.schema["id"].dataType.simpleString()
    return table.select("id", "cells", "vector").mapInArrow(
        assign, f"id {kind}, cluster int, distance bigint, centroid array<string>")


def with_inertia(spark: SparkSession, found: DataFrame, place: str) -> DataFrame:
    """Adds the sum of distances over each row's cluster and over all rows; ``found`` is written below ``place``.

    There is one sum per cluster, so these come to the driver and go back by broadcast.
    """
    found.write.parquet(f"{place}/assigned")
    rows = spark.read.schema(found.schema).parquet(f"{place}/assigned")
    sums = [(r["cluster"], r["inertia"]) for r in rows.groupBy("cluster").agg(_long_total("distance").alias("inertia")).collect()]
    known = all(s is not None for _, s in sums)
    total = sum(s for _, s in sums) if known else None
    every = total if known and total <= MOST_LONG else None
    table = spark.createDataFrame([(c, s, every) for c, s in sums], "cluster int, cluster_inertia bigint, inertia bigint")
    return rows.join(F.broadcast(table), "cluster")
