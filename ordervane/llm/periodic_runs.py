"""Periodic runs of words, found in a grammar that compresses the texts (Re-Pair).

A run is a stretch of consecutive words with smallest period q (words q apart are equal),
at least ``max(least, 2 * q)`` words long, which no neighbouring word continues. The steps,
for the texts of a piece of about 0.5 MB (a longer text is a piece of its own):

1. *Grammar.* Word ids are compressed by Re-Pair: frequent pairs of neighbouring symbols become
   new symbols, until no pair occurs twice. All occurrences of a pair whose neighbouring pairs
   are rarer are replaced in one step of array operations. Then the symbols left of each
   text are joined two by two to a single one. The grammar is shared by the texts of a
   piece, so what they have in common is compressed once; no symbol spans two texts.
2. *Runs at boundaries.* A symbol stands for two parts. Any run in a text crosses the
   boundary of the smallest symbol around it. So for each different symbol, and once only, the
   runs inside it that cross its boundary are computed: at a distance q from the boundary lies a
   word equal to the one at the boundary, and six or more neighbouring pairs of words q
   apart are equal, so that four words beginning or ending at these two are equal. Such
   candidates are extended to both sides by comparing hashes of spans.
3. *Translation.* Every occurrence of a symbol in a text, known from when it was made, gets its
   symbol's runs. Stretches of one period that overlap by a period or more are one run; of
   equal stretches the smallest period counts. All runs are compared word by word in the end.

Work on a text stays in its task; nothing is shuffled. Defined cases:

* A null text, an empty one, or one of white space only has no words and no runs; its row is returned.
* Rows without id, with equal ids or equal texts are rows of their own. An empty table gives an empty one.
* Further columns are dropped, unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_arrays import SpanHash, mix, slices, utf8_buffers, word_hashes, word_spans

LEAST = 12
#: Words that must be equal at a candidate's two places; a run of 12 words has six equal pairs in a row.
GRAM = 4
#: Candidates looked at in one step.
STEP = 1 << 20


# --- grammar -------------------------------------------------------------------

@dataclass(frozen=True)
class Grammar:
    """Every occurrence of every symbol that stands for two parts: its start, and where it ends and is divided."""
    symbol: np.ndarray
    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray

    def distinct(self) -> np.ndarray:
        """The place of one occurrence of each symbol."""
        return np.unique(self.symbol, return_index=True)[1]


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Which pairs to replace, from the rank of the pair at each place (-1: none).

    Pairs are taken whose neighbours rank lower. Of a stretch of one pair (in ``aaaa``)
    every second one is taken.
    """
    n = len(rank)
    new = np.ones(n, bool)
    new[1:] = rank[1:] != rank[:-1]
    first = np.flatnonzero(new)
    values = rank[first]
    padded = np.concatenate([[-1], values, [-1]])
    highest = (values >= 0) & (padded[:-2] < values) & (padded[2:] < values)
    stretch = np.cumsum(new) - 1
    return np.flatnonzero(highest[stretch] & ((np.arange(n) - first[stretch]) % 2 == 0))


def compress(words: np.ndarray, offsets: np.ndarray) -> Grammar:
    """The grammar of texts whose word ids (from 0) lie one after the other."""
    n = len(words)
    symbols, starts = words.astype(np.int64), np.arange(n)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    following = int(symbols.max()) + 1 if n else 0
    found: list[tuple[np.ndarray, ...]] = []
    open_ = np.ones(n, bool)  # places whose pair may occur twice

    def join(at: np.ndarray, named: np.ndarray) -> None:
        nonlocal symbols, starts, text, open_
        ends = np.append(starts, n)
        found.append((named, starts[at], starts[at + 1], ends[at + 2]))
        symbols[at] = named
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        open_[at] = True
        open_[np.maximum(at - 1, 0)] = True
        symbols, starts, text, open_ = symbols[stay], starts[stay], text[stay], open_[stay]

    while True:
        at = np.flatnonzero(open_[:-1] & (text[:-1] == text[1:])) if len(symbols) > 1 else np.zeros(0, np.int64)
        pairs, which, times = np.unique(symbols[at] * following + symbols[at + 1], return_inverse=True, return_counts=True)
        open_[:] = False
        if not (times > 1).any():
            break
        again = times[which] > 1
        open_[at[again]] = True
        order = np.lexsort((mix(pairs.astype(np.uint64)), times))
        place = np.empty(len(pairs), np.int64)
        place[order] = np.arange(len(pairs))
        rank = np.full(len(symbols), -1)
        rank[at[again]] = place[which[again]]
        chosen = _chosen(rank)
        names, named = np.unique(rank[chosen], return_inverse=True)
        join(chosen, following + named)
        following += len(names)
    while True:  # no pair occurs twice: neighbours in twos, until there is one symbol to a text
        firsts = np.searchsorted(text, text)
        odd = (np.arange(len(text)) - firsts) % 2
        at = np.flatnonzero((odd[:-1] == 0) & (text[:-1] == text[1:]))
        if not len(at):
            break
        join(at, following + np.arange(len(at)))
        following += len(at)
    if not found:
        return Grammar(*[np.zeros(0, np.int64)] * 4)
    return Grammar(*[np.concatenate(parts) for parts in zip(*found, strict=True)])


# --- runs ----------------------------------------------------------------------

def _longest(spans: SpanHash, left: np.ndarray, right: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many items are equal from ``left`` and ``right`` on, forwards (step 1) or backwards, ``most`` at most."""
    low, high = np.zeros(len(left), np.int64), np.maximum(most, 0)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_] + 1) // 2
        a, b = left[open_], right[open_]
        same = (spans(a, a + middle) == spans(b, b + middle)) if step > 0 else (spans(a + 1 - middle, a + 1) == spans(b + 1 - middle, b + 1))
        low[open_[same]] = middle[same]
        high[open_[~same]] = middle[~same] - 1
    return low


def _grams(words: np.ndarray) -> np.ndarray:
    """A number for the ``GRAM`` words from each place on, equal for equal ones; unique where the array ends."""
    ids, length = np.unique(words, return_inverse=True)[1], 1
    while length < GRAM:
        n = len(words) - 2 * length + 1
        both = np.full(len(words), -1, np.int64)
        both[:max(n, 0)] = ids[:n] * (len(words) + 1) + ids[length:length + n] if n > 0 else 0
        both[max(n, 0):] = -1 - np.arange(len(words) - max(n, 0))
        ids, length = np.unique(both, return_inverse=True)[1], 2 * length
    return ids


def _candidates(grams: np.ndarray, order: np.ndarray, at: np.ndarray, low: np.ndarray,
                high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``low <= place < high`` with the same words as the place ``at``, in steps: which of ``at``, and the place.

    ``order`` has all places by their words.
    """
    code = grams[order] * (len(grams) + 1) + order
    first = np.searchsorted(code, grams[at] * (len(grams) + 1) + low)
    count = np.maximum(np.searchsorted(code, grams[at] * (len(grams) + 1) + high) - first, 0)
    held = np.flatnonzero(count)
    bounds = np.cumsum(count[held])
    begin = 0
    while begin < len(held):
        done = bounds[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(bounds, done + STEP)))
        part = held[begin:stop]
        n = count[part]
        which = np.repeat(part, n)
        yield which, order[first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)]
        begin = stop


def boundary_runs(words: np.ndarray, spans: SpanHash, start: np.ndarray, middle: np.ndarray, end: np.ndarray,
                  least: int) -> tuple[np.ndarray, ...]:
    """Stretches inside ``start`` to ``end`` with a period that cross ``middle``: which symbol, start, end, period."""
    grams = _grams(words)
    order = np.argsort(grams, kind="stable")
    found = []
    half = (end - start) // 2

    def extend(which: np.ndarray, place: np.ndarray, period: np.ndarray) -> None:
        """From ``place`` on, which equals the word a period later."""
        ok = (period > 0) & (period <= half[which]) & (place >= start[which]) & (place + period < end[which])
        which, place, period = which[ok], place[ok], period[ok]
        before = _longest(spans, place, place + period, place - start[which] + 1, -1)
        after = _longest(spans, place + 1, place + 1 + period, end[which] - period - place - 1, 1)
        equal = before + after
        ok = (before > 0) & (equal >= np.maximum(least - period, period))
        which, place, period, before, equal = (x[ok] for x in (which, place, period, before, equal))
        first = place - before + 1
        found.append((which, first, first + equal + period, period))

    last = middle - 1
    for shift in (0, GRAM - 1):  # four words that begin, and four that end, at the boundary
        at = last - shift
        ok = np.flatnonzero(at >= start)
        for which, place in _candidates(grams, order, at[ok], last[ok] + 1 - shift, end[ok] - shift):
            extend(ok[which], last[ok[which]], place + shift - last[ok[which]])
        at = middle - shift
        ok = np.flatnonzero(at >= start)
        for which, place in _candidates(grams, order, at[ok], start[ok], at[ok]):
            extend(ok[which], place + shift, middle[ok[which]] - place - shift)
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    rows = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)], axis=1), axis=0)
    return tuple(rows.T)


def _merged(first: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs from stretches: those of one period that overlap by it are joined; of equal ones the smallest period stays."""
    if not len(first):
        return first, end, period
    order = np.lexsort((first, period))
    first, end, period = first[order], end[order], period[order]
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + period * far)  # periods ascend, so each begins anew
    new = np.ones(len(first), bool)
    new[1:] = first[1:] + period[1:] + period[1:] * far > reach[:-1]
    at = np.flatnonzero(new)
    first, period = first[at], period[at]
    end = np.append(reach[at[1:] - 1], reach[-1]) - period * far
    order = np.lexsort((period, end, first))
    first, end, period = first[order], end[order], period[order]
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1]) | (end[1:] != end[:-1])
    return first[new], end[new], period[new]


def _check(words: np.ndarray, first: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
    for a, b, q in zip(first.tolist(), end.tolist(), period.tolist(), strict=True):
        if not np.array_equal(words[a:b - q], words[a + q:b]):
            raise ValueError("different words have equal hashes")


def find_runs(words: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """First word, end and period of all runs of texts whose word ids lie one after the other, by first word."""
    grammar = compress(words, offsets)
    at = grammar.distinct()
    at = at[grammar.end[at] - grammar.start[at] >= least]
    spans = SpanHash(mix(words.astype(np.uint64) + np.uint64(1)))
    which, first, end, period = boundary_runs(words, spans, grammar.start[at], grammar.middle[at], grammar.end[at], least)
    # every occurrence of those symbols
    symbol = grammar.symbol[at][which]
    order = np.argsort(grammar.symbol, kind="stable")
    symbols = grammar.symbol[order]
    low, high = np.searchsorted(symbols, symbol), np.searchsorted(symbols, symbol, side="right")
    n = high - low
    row = np.repeat(np.arange(len(which)), n)
    place = grammar.start[order[low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]]
    shift = place - grammar.start[at][which][row]
    first, end, period = _merged(first[row] + shift, end[row] + shift, period[row])
    _check(words, first, end, period)
    return first, end, period


# --- over tables ---------------------------------------------------------------

def _tails(n: np.ndarray, offsets: np.ndarray, seeds: list[int | None]) -> np.ndarray:
    """For every word the number of the word that stands in its place."""
    source = np.arange(int(offsets[-1]))
    for i, seed in enumerate(seeds):
        if seed is not None and n[i]:
            a = seed % int(n[i])
            p = 1 + (int(n[i]) - a) // (3 + seed % 8)
            places = np.arange(a, n[i])
            source[offsets[i] + places] = offsets[i] + a + (places - a) % p
    return source


def _piece(column: pa.Array, seeds: list[int | None], least: int) -> tuple[list, list[str], list[int]]:
    data, offsets = utf8_buffers(column)
    starts, stops, firsts = word_spans(data, offsets)
    n = np.diff(firsts)
    ids = np.unique(word_hashes(data, starts, stops), return_inverse=True)[1].astype(np.int64)
    source = _tails(n, firsts, seeds)
    ids, starts, stops = ids[source], starts[source], stops[source]
    first, end, period = find_runs(ids, firsts, least)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, first + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    held = np.searchsorted(first, firsts)
    raw = data.tobytes()
    runs, texts = [], []
    for i in range(len(n)):
        a, b = firsts[i], firsts[i + 1]
        at = slice(held[i], held[i + 1])
        runs.append(list(zip((first[at] - a).tolist(), (end[at] - first[at]).tolist(), period[at].tolist(), strict=True)))
        stay = kept[a:b]
        texts.append(b" ".join([raw[x:y] for x, y in zip(starts[a:b][stay].tolist(), stops[a:b][stay].tolist(), strict=True)]).decode())
    return runs, texts, n.tolist()


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_periodic_runs(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), least: int = LEAST,
                       tail_seed: Column | None = None) -> DataFrame:
    """What to ``keep`` of every row, ``n_words``, its ``runs`` by start and period, and the ``collapsed`` text.

    The collapsed text has the words that are not in any run after its first period,
    with single spaces. A row with a ``tail_seed`` gets a periodic end before (for tests of texts
    that have no runs): of n words, those from ``a = seed % n`` on repeat the first
    ``1 + (n - a) // (3 + seed % 8)`` of them.
    """
    seed = (tail_seed if tail_seed is not None else F.lit(None)).cast("bigint")
    # numbered names can't clash with what is kept
    rows = docs.select(*[F.col(c).alias(f"kept{i}") for i, c in enumerate(keep)],
                       F.col(text).cast("string").alias("text"), seed.alias("seed"))
    held = [f"kept{i}" for i in range(len(keep))]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                runs, texts, n = _piece(part.column("text"), part.column("seed").to_pylist(), least)
                named = [[{"start": s, "length": m, "period": q} for s, m, q in row] for row in runs]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in held], pa.array(n, pa.int64()), pa.array(named, run_type), pa.array(texts, pa.string())],
                    [*held, "n_words", "runs", "collapsed"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in held]
    out = rows.mapInArrow(found, ", ".join([*kinds, "n_words bigint", f"runs {_RUNS}", "collapsed string"]))
    return out.select(*[F.col(h).alias(c) for h, c in zip(held, keep, strict=True)], "n_words", "runs", "collapsed")


def longest_run(runs: str = "runs") -> Column:
    """The run of greatest length; of equal ones the first, then that of the smallest period."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
