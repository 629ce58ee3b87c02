"""Language identification by a small bidirectional gated recurrent network over bytes.

One network reads the bytes forwards, one backwards; from both states every byte
position gets a distribution over the languages, and a document's distribution is
the mean over all its bytes. Training is backpropagation through time in numpy on
a bounded sample of labelled rows; labelling runs over every byte of every text,
cut into pieces of ``PIECE`` bytes whose states begin anew.

Inputs and results, also for odd ones: a text that is null, empty or without a
letter gets ``und`` and score 0.0. Rows without label (or null key) are not
learned from. Without any labelled row everything is ``und``. Long texts are read
whole, repeated rows give repeated results, ties go to the language first in
alphabetical order. Only the named columns are read; ``keep`` names further ones
to carry along, which must not be called like the result's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_arrays import slices, utf8_buffers

UNKNOWN = "und"
PIECE = 256
#: Bound of the training sample: rows per language, passages per row, characters per passage.
ROWS_PER_LANGUAGE, PASSAGES, PASSAGE_CHARS = 300, 6, 120
#: Languages that are learned, those with the most rows; a label that few rows have is junk more often than not.
LANGUAGES = 256
#: Bytes of a training passage that are learned from.
TRAIN_BYTES = 96


@dataclass
class Direction:
    """Weights of one reading direction; gates stand in the order update, reset, candidate."""

    inputs: np.ndarray  # 3h x 256, a column per byte
    states: np.ndarray  # 3h x h
    bias: np.ndarray  # 3h x 1, added to what comes from the state
    out: np.ndarray  # languages x h

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.bias, self.out]


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    prior: np.ndarray


def _squash(x: np.ndarray) -> np.ndarray:
    """Softsign in place: like tanh between -1 and 1, but without an exponential."""
    scale = np.abs(x)
    scale += np.float32(1)
    x /= scale
    return x


def _slope(y: np.ndarray) -> np.ndarray:
    """The derivative of softsign where its value is ``y``."""
    return (1 - np.abs(y)) ** 2


def _step(d: Direction, codes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next states (a column per passage) after one byte each; also what the gradient needs."""
    n = len(h)
    gates, from_state = d.inputs.take(codes, axis=1, mode="clip"), d.states @ h
    from_state += d.bias
    gates[:2 * n] += from_state[:2 * n]
    zr = _squash(gates[:2 * n])
    zr += np.float32(1)
    zr *= np.float32(0.5)
    z, r, q, candidate = zr[:n], zr[n:], from_state[2 * n:], gates[2 * n:]
    candidate += r * q
    _squash(candidate)
    new = h - candidate
    new *= z
    new += candidate
    return new, z, r, q, candidate


# --- training -----------------------------------------------------------------

def _forward(d: Direction, codes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
    """All states (step x hidden x passage) and what each step's gradient needs."""
    h = np.zeros((d.states.shape[1], codes.shape[1]), np.float32)
    states, kept = [], []
    for row in codes:
        new, *rest = _step(d, row, h)
        kept.append((h, *rest))
        states.append(new)
        h = new
    return np.stack(states), kept


def _backward(d: Direction, codes: np.ndarray, kept, above: np.ndarray) -> list[np.ndarray]:
    """Gradients of inputs, states and bias, given that of every state from the output layer."""
    d_states, d_bias = np.zeros_like(d.states), np.zeros_like(d.bias)
    d_gates = np.zeros((len(codes), len(d.inputs), codes.shape[1]), np.float32)
    later = np.zeros_like(above[0])
    for t in range(len(codes) - 1, -1, -1):
        h, z, r, q, candidate = kept[t]
        d_new = above[t] + later
        d_candidate = d_new * (1 - z) * _slope(candidate)
        d_z = d_new * (h - candidate) * _slope(2 * z - 1) / 2
        d_r = d_candidate * q * _slope(2 * r - 1) / 2
        at_state = np.concatenate([d_z, d_r, d_candidate * r])
        d_gates[t] = np.concatenate([d_z, d_r, d_candidate])
        d_states += at_state @ h.T
        d_bias += at_state.sum(axis=1, keepdims=True)
        later = d_new * z + d.states.T @ at_state
    flat = codes.ravel()
    order = np.argsort(flat, kind="stable")
    present, firsts = np.unique(flat[order], return_index=True)
    d_inputs = np.zeros_like(d.inputs)
    by_byte = d_gates.transpose(0, 2, 1).reshape(len(flat), -1)[order]
    d_inputs[:, present] = np.add.reduceat(by_byte, firsts, axis=0).T
    return [d_inputs, d_states, d_bias]


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the last axis but one, in place."""
    x -= x.max(axis=-2, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-2, keepdims=True)
    return x


def _new_direction(rng: np.random.Generator, hidden: int, languages: int) -> Direction:
    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    return Direction(draw(3 * hidden, 256), draw(3 * hidden, hidden), np.zeros((3 * hidden, 1), np.float32),
                     draw(languages, hidden))


def fit(passages: Sequence[bytes], labels: Sequence[str], hidden: int = 8, epochs: int = 8,
        batch: int = 128, rate: float = 0.015, seed: int = 7) -> Network:
    """Learns from passages of ``TRAIN_BYTES`` bytes (shorter ones are repeated to that length)."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = Network(languages, _new_direction(rng, hidden, len(languages)),
                  _new_direction(rng, hidden, len(languages)), np.zeros((len(languages), 1), np.float32))
    if len(languages) < 2:
        return net
    codes = np.stack([np.resize(np.frombuffer(p, np.uint8), TRAIN_BYTES) for p in passages])
    place = {name: i for i, name in enumerate(languages)}
    wanted = np.array([place[name] for name in labels])
    weights = [*net.ahead.arrays(), *net.back.arrays(), net.prior]
    means, squares, steps = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    total = epochs * -(-len(codes) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for begin in range(0, len(order), batch):
            rows = order[begin:begin + batch]
            x, y = codes[rows].T, wanted[rows]
            ahead, kept = _forward(net.ahead, x)
            turned, kept_back = _forward(net.back, x[::-1])
            back = turned[::-1]
            error = _softmax(net.ahead.out @ ahead + net.back.out @ back + net.prior)
            error[:, y, np.arange(len(rows))] -= 1
            error /= np.float32(len(x) * len(rows))
            grads = [
                *_backward(net.ahead, x, kept, net.ahead.out.T @ error),
                np.einsum("tlb,thb->lh", error, ahead, optimize=True),
                *_backward(net.back, x[::-1], kept_back, (net.back.out.T @ error)[::-1]),
                np.einsum("tlb,thb->lh", error, back, optimize=True),
                error.sum(axis=(0, 2))[:, None],
            ]
            steps += 1
            pace = rate * (1 - steps / (total + 1))
            for w, g, m, s in zip(weights, grads, means, squares, strict=True):
                g = np.clip(g, -1, 1)
                m += (1 - 0.9) * (g - m)
                s += (1 - 0.999) * (g * g - s)
                w -= (pace * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


# --- labelling ----------------------------------------------------------------

def label_bytes(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The language distribution at every byte of every piece of the texts.

    Gives place x language x piece, the pieces' lengths (longest first) and the
    text each belongs to; places beyond a piece's length mean nothing.
    """
    counts = -(-np.diff(offsets) // PIECE)
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[text] + nth * PIECE
    lengths = np.minimum(offsets[text + 1] - begins, PIECE)
    order = np.argsort(-lengths, kind="stable")
    text, begins, lengths = text[order], begins[order], lengths[order]
    longest = int(lengths[0])
    active = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")
    scores = np.zeros((longest, len(net.languages), len(lengths)), np.float32)
    for direction, places in ((net.ahead, range(longest)), (net.back, range(longest - 1, -1, -1))):
        h = np.zeros((direction.states.shape[1], len(lengths)), np.float32)
        for t in places:
            n = active[t]
            h[:, :n] = _step(direction, data[begins[:n] + t], h[:, :n])[0]
            scores[t, :, :n] += direction.out @ h[:, :n]
    scores += net.prior
    return _softmax(scores), lengths, text


def predict_texts(net: Network, column: pa.Array) -> tuple[list[str], list[float]]:
    data, offsets = utf8_buffers(column)
    lettered = np.array([bool(t) and any(map(str.isalpha, t)) for t in column.to_pylist()], dtype=bool)
    if not net.languages or not len(data):
        return [UNKNOWN] * len(column), [0.0] * len(column)
    chances, lengths, text = label_bytes(net, data, offsets)
    chances *= (np.arange(len(chances))[:, None] < lengths)[:, None, :]
    pooled = chances.sum(axis=0, dtype=np.float64)
    means = np.stack([np.bincount(text, weights=row, minlength=len(column)) for row in pooled])
    means /= np.maximum(np.diff(offsets), 1)
    best = means.argmax(axis=0)
    names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
    scores = np.where(lettered, np.clip(means[best, np.arange(len(best))], 0, 1), 0.0)
    return names, scores.tolist()


def training_passages(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[bytes], list[str]]:
    """A bounded sample: passages of about ``ROWS_PER_LANGUAGE`` texts of each of the ``LANGUAGES`` most frequent languages.

    Texts are picked by their hash, passages by place; the number collected does
    not grow with the table.
    """
    rows = labelled.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l")).filter(
        F.col("l").isNotNull() & (F.length("t") > 0))
    counts = {r["l"]: r["count"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(LANGUAGES).collect()}
    if not counts:
        return [], []
    chance = F.when(F.lit(False), 1.0)
    for name, count in counts.items():
        chance = chance.when(F.col("l") == name, min(1.0, ROWS_PER_LANGUAGE / count))
    drawn = F.pmod(F.xxhash64("t"), F.lit(1 << 30)) / float(1 << 30)
    spread = F.greatest(F.length("t") - PASSAGE_CHARS, F.lit(0)) / float(PASSAGES)
    passages = F.array(*[F.substring("t", (spread * (i + 0.5) + 1).cast("int"), F.lit(PASSAGE_CHARS))
                         for i in range(PASSAGES)])
    picked = (rows.filter(drawn < chance).select("l", F.array_distinct(passages).alias("p")).distinct()
              .limit(8 * ROWS_PER_LANGUAGE * len(counts)).collect())
    pairs = sorted((r["l"], p.encode()) for r in picked for p in r["p"] if any(map(str.isalpha, p)))
    return [p for _, p in pairs], [name for name, _ in pairs]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", **settings) -> Network:
    passages, labels = training_passages(labelled, text, lang)
    return fit(passages, labels, **settings)


def held_out(key: str = "doc_id", remainder: int = 0) -> Column:
    """Whether a row belongs to the fifth that is not learned from; a null key does."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == remainder, F.lit(True))


def label_languages(docs: DataFrame, net: Network, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row; nothing is shuffled."""
    read = text if text in keep else "_text"  # a text that is carried along is sent once
    rows = docs.select(*keep, *([] if text in keep else [F.col(text).cast("string").alias("_text")]))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, read):
                names, scores = predict_texts(net, part.column(read))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*keep, "lang_pred", "score"])

    schema = rows.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(labelled, schema)
