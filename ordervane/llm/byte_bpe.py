"""Byte-level BPE encoding and decoding with a sentencepiece model built from ranks.

The rank file is turned into a sentencepiece BPE model without any training: each
token's bytes become printable characters, its score is the negative rank, and
nothing is normalised. A piece's number in that model is its rank. Every match of
the splitting pattern is encoded on its own; decoding looks up each number's bytes.

Inputs and results, also for odd ones: a null or empty text has no tokens (empty
``ids``) and decodes to nothing. A text of any length is encoded whole. Repeated
rows give repeated results. Only the named columns are read, further ones are
dropped, so no name can clash. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_arrays import slices

#: Pre-tokens kept with their numbers in a worker; beyond that the memory is begun anew.
CACHE_ENTRIES = 300_000

# Fixed values of sentencepiece's model format: field numbers and piece kinds.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def _varint(value: int) -> bytes:
    out = bytearray()
    value &= (1 << 64) - 1
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + np.float32(score).tobytes()
    return _block(_PIECE, _block(1, text.encode()) + score_field + _number(3, kind))


@lru_cache
def byte_characters() -> str:
    """A printable character for every byte: its own where it has one, else one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(spare)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece numbers are the ranks; the unknown piece comes last."""
    table = byte_characters()
    pieces = [_piece("".join(table[b] for b in token), -rank, _NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, _UNKNOWN))
    trainer = _number(3, _BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))  # no begin, end or padding piece
    normalizer = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(_TRAINER, trainer) + _block(_NORMALIZER, normalizer)


@lru_cache
def _basic_splitter(pattern: str) -> re.Pattern:
    r"""The pattern for texts of characters below U+10000, for the quicker standard matcher.

    \p{L}, \p{N} and \s are spelled as ranges, which that matcher turns into tables.
    """
    basic = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x10000))))
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = (m.group() for m in regex.finditer(f"{name}+", basic))
        ranges = "".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in runs)
        pattern = re.sub(rf"(\[[^\]]*?){re.escape(name)}", lambda m, r=ranges: m[1] + r, pattern)
        pattern = pattern.replace(r"\S", "[^" + ranges + "]") if name == r"\s" else pattern
        pattern = pattern.replace(name, f"[{ranges}]")
    return re.compile(pattern)


def splitter(pattern: str):
    """Gives the list of a text's pre-tokens."""
    basic, full = _basic_splitter(pattern).findall, regex.compile(pattern).findall

    def split(text: str) -> list[str]:
        if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text):
            return basic(text)
        return full(text)

    return split


class ByteBPE:
    """Encoder and decoder of one rank file, made once in each worker."""

    def __init__(self, ranks_path: str, pattern: str):
        tokens = _kept_ranks(ranks_path)
        self._split = splitter(pattern)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(tokens))
        self._characters = str.maketrans(dict(enumerate(byte_characters())))
        self._known: dict[str, bytes] = {}
        self._bytes = tokens

    def _encode_new(self, pieces: set[str]) -> None:
        if len(self._known) + len(pieces) > CACHE_ENTRIES:
            self._known = {}
        ordered = list(pieces)
        shown = [p.encode().decode("latin-1").translate(self._characters) for p in ordered]
        for piece, numbers in zip(ordered, self._model.encode(shown, num_threads=1), strict=True):
            self._known[piece] = np.array(numbers, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The tokens' numbers of each text, little-endian 32 bits each."""
        split = [self._split(text) if text else [] for text in texts]
        needed = set(chain.from_iterable(split))
        if new := needed.difference(self._known):
            self._encode_new(new)
            if lost := needed.difference(self._known):
                self._encode_new(lost)
        if len(self._known) < len(needed):  # one batch alone overflows the memory
            return [b"".join(self._encode_one(pieces)) for pieces in split]
        return [b"".join(map(self._known.__getitem__, pieces)) for pieces in split]

    def _encode_one(self, pieces: list[str]) -> list[bytes]:
        self._encode_new(set(pieces))
        return [self._known[p] for p in pieces]

    def decode(self, ids: bytes | None) -> bytes:
        return decode_ids(self._bytes, ids)


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> ByteBPE:
    return ByteBPE(ranks_path, pattern)


@lru_cache(maxsize=4)
def _kept_ranks(ranks_path: str) -> list[bytes]:
    """All that decoding needs; a worker that only decodes makes no model."""
    return read_ranks(ranks_path)


def decode_ids(tokens: list[bytes], ids: bytes | None) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist()))


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``: the text's token numbers as little-endian 32-bit integers.

    The rank file must lie at the same path on every executor, as installed
    packages do. Nothing is shuffled.
    """
    ranks_path, pattern = ranks_path or default_vocabulary(), pattern or public_tokenizers.PATTERN

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = bpe.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(ids, pa.binary())], ["key", "ids"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None,
           key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded``, the bytes that the token numbers stand for. Of the two only the ranks matter here.

    Straight after ``encode`` a task has two Python workers; a table written in between spares the second one.
    """
    ranks_path = ranks_path or default_vocabulary()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _kept_ranks(ranks_path)
        for batch in batches:
            for part in slices(batch, "ids"):
                out = [decode_ids(tokens, value) for value in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("ids"), pa.array(out, pa.binary())], ["key", "ids", "decoded"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(decoded, f"key {kind}, ids binary, decoded binary")
    return out.withColumnRenamed("key", key)


def n_tokens(ids) -> Column:
    """Number of tokens in a packed column of token numbers."""
    return F.floor(F.octet_length(ids) / 4)
