"""Texts of one Arrow batch as byte arrays: words, hashes and selected positions.

Helpers of the operators that look at every byte or word. They work on one batch
inside a task and know nothing of Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\v\f\r"
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[list(SPACES)] = False

#: Span hashes are polynomials modulo this prime at a point that texts know nothing of. (Modulo
#: a power of two there are different sequences with one hash whatever the point is.)
PRIME = (1 << 61) - 1
_POINT = int.from_bytes(hashlib.blake2b(b"point of the span hashes", digest_size=8).digest(), "big") % PRIME
_LOW = np.uint64((1 << 32) - 1)
_KEPT_POWERS = 1 << 20
_WORD_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_STEP = 1 << 13  # products of so many at a time stay in the processor's cache


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (splitmix64's finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes one after the other and the offsets of the texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, *texts: str, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most_bytes`` of text; a row with more is a piece of its own.

    Arrays over a piece's bytes take some ten times as many bytes for each.
    """
    sizes = sum(pc.binary_length(batch.column(t)).fill_null(0).to_numpy(zero_copy_only=False) for t in texts)
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(size)
    if begin < len(sizes):
        yield batch.slice(begin)
    pa.default_memory_pool().release_unused()  # idle workers would hold on to it


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data - np.uint8(65)) < 26).view(np.uint8) * np.uint8(32)


def word_spans(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = _IN_WORD,
               breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and where each text's words begin in that list.

    ``breaks`` are bytes at which a word ends and another one may begin.
    """
    # spaces are 9 to 13 and 32; comparisons are faster than a table
    inside = (data != 32) & ((data - np.uint8(9)) > 4) if word_bytes is _IN_WORD else word_bytes[data]
    filled = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] if breaks is None else ~inside[:-1] | breaks[1:]
    ends[:-1] &= ~inside[1:] if breaks is None else ~inside[1:] | breaks[1:]
    begins[first], ends[last] = inside[first], inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def _once(values: np.ndarray) -> np.ndarray:
    """Values of 64 bits modulo the prime."""
    values = (values & np.uint64(PRIME)) + (values >> np.uint64(61))
    return np.minimum(values, values - np.uint64(PRIME))  # the smaller one has not wrapped around


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, of factors below it, put together from halves."""
    if a.size <= _STEP:
        return _product(a, b)
    found = np.empty(a.size, np.uint64)
    for i in range(0, a.size, _STEP):
        found[i:i + _STEP] = _product(a[i:i + _STEP], b if b.ndim == 0 else b[i:i + _STEP])
    return found


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a1, a0, b1, b0 = a >> np.uint64(32), a & _LOW, b >> np.uint64(32), b & _LOW
    middle = a1 * b0
    middle += a0 * b1
    a1 *= b1
    a0 *= b0
    # 2**61 is 1, so 2**64 is 8, and what lies above bit 61 is added at the bottom
    total = a1 << np.uint64(3)
    total += middle >> np.uint64(29)
    middle &= np.uint64((1 << 29) - 1)
    middle <<= np.uint64(32)
    total += middle
    total += a0 >> np.uint64(61)
    a0 &= np.uint64(PRIME)
    total += a0
    return _once(total)


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    values = a - b
    return np.minimum(values, values + np.uint64(PRIME))


def _running(point: int, n: int) -> np.ndarray:
    """The powers 0 to n of ``point``."""
    powers, top = np.ones(1, np.uint64), point
    while len(powers) <= n:
        powers = np.concatenate([powers, times(powers, np.array(top, np.uint64))])
        top = top * top % PRIME
    return powers[:n + 1]


_kept: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the point and of its inverse; those that common pieces need are kept."""
    if n >= _KEPT_POWERS:
        return _running(_POINT, n), _running(pow(_POINT, -1, PRIME), n)
    if not _kept or len(_kept[0][0]) <= n:
        size = min(_KEPT_POWERS, 2 * n + 1)
        _kept[:] = [(_running(_POINT, size), _running(pow(_POINT, -1, PRIME), size))]
    return _kept[0][0][:n + 1], _kept[0][1][:n + 1]


class SpanHash:
    """64-bit hashes of any spans of a sequence of codes, equal for equal spans."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        up, self._down = _powers(n)
        self._sums = np.zeros(n + 1, np.uint64)
        total = np.uint64(0)
        for i in range(0, n, _STEP):
            terms = _product(_once(codes[i:i + _STEP]), up[i:min(i + _STEP, n)])
            high, low = np.cumsum(terms >> np.uint64(32)), np.cumsum(terms & _LOW)
            low += high >> np.uint64(29)
            high &= np.uint64((1 << 29) - 1)
            sums = _once(_once((high << np.uint64(32)) + low) + total)
            self._sums[i + 1:i + 1 + len(sums)] = sums
            total = sums[-1]

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> SpanHash:
        return cls(_BYTE_CODES[data])

    def _span(self, starts: np.ndarray, stops: np.ndarray, down: np.ndarray) -> np.ndarray:
        return times(_minus(self._sums[stops], self._sums[starts]), down)

    def __call__(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix(self._span(starts, stops, self._down[starts]))

    def without(self, starts: np.ndarray, places: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The hash of every span with the code at ``places`` taken out."""
        left = self._span(starts, places, self._down[starts])
        return mix(_once(left + self._span(places + 1, stops, self._down[starts + 1])))

    def windows(self, length: int) -> np.ndarray:
        """The hash of every span of ``length`` codes."""
        n = max(0, len(self._sums) - length)
        return mix(times(_minus(self._sums[length:length + n], self._sums[:n]), self._down[:n]))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of every word: of up to eight bytes by these and their number, of longer ones as a span."""
    sizes = stops - starts
    padded = np.append(data, np.zeros(8, np.uint8))
    # the eight bytes from each place on, of which those behind the word are left out
    packed = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))[starts]
    packed &= _WORD_MASKS[np.minimum(sizes, 8)]
    hashes = mix(mix(packed) + sizes.astype(np.uint64))
    long = np.flatnonzero(sizes > 8)
    if len(long):
        # their bytes four at a time, the last ones filled up with zeros
        blocks = (sizes[long] + 3) // 4
        ends = np.cumsum(blocks)
        begins = ends - blocks
        nth = np.arange(ends[-1]) - np.repeat(begins, blocks)
        four = np.ndarray(len(data) + 5, "<u4", padded, strides=(1,))[np.repeat(starts[long], blocks) + 4 * nth].astype(np.uint64)
        four &= _WORD_MASKS[np.minimum(np.repeat(sizes[long], blocks) - 4 * nth, 4)]
        hashes[long] = mix(SpanHash(four + np.uint64(1))(begins, ends) + sizes[long].astype(np.uint64))
    return hashes


def _sliding(values: np.ndarray, width: int, reduce: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by block-wise running values."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, fill, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = reduce.accumulate(grid, axis=1).ravel()
    behind = reduce.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return reduce(behind[:n - width + 1], ahead[width - 1:n])


def window_ok(offsets: np.ndarray, length: int, total: int) -> np.ndarray:
    """Whether the window of ``length`` items beginning at each item lies in one text."""
    change = np.zeros(total + 1, np.int32)
    firsts, lasts = offsets[:-1], offsets[1:] - length + 1
    whole = lasts > firsts
    np.add.at(change, firsts[whole], 1)
    np.add.at(change, lasts[whole], -1)
    return np.cumsum(change[:-1]) > 0


def anchor_of_windows(grams: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Every window of ``window`` items that lies in one text, and its anchor (winnowing).

    ``grams`` holds the hash of the ``gram`` items at each position. The anchor is
    the place of the window's smallest hash, the first one of equals; it depends on
    the window's own items only.
    """
    width, total = window - gram + 1, int(offsets[-1])
    if total < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = grams[:total - gram + 1]
    smallest = _sliding(grams, width, np.minimum, 2**64 - 1)
    whole = window_ok(offsets, window, total)[:len(smallest)]
    spread = np.zeros(len(smallest) + 2 * (width - 1), np.uint64)
    spread[width - 1:width - 1 + len(smallest)] = np.where(whole, smallest, np.uint64(0))
    largest = _sliding(spread, width, np.maximum, 0)
    chosen = np.flatnonzero((largest == grams[:len(largest)]) & (largest > 0))
    starts = np.flatnonzero(whole)
    wanted, at = smallest[starts], np.searchsorted(chosen, starts)
    open_ = np.arange(len(starts))
    while len(open_):
        open_ = open_[grams[chosen[at[open_]]] != wanted[open_]]
        at[open_] += 1
    return starts, chosen[at]


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` items lie in a window of ``length`` beginning at one of ``starts``."""
    change = np.zeros(total + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, total), -1)
    return np.cumsum(change[:-1]) > 0
