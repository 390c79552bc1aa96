"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary.

A rank file (base64 token, rank) is turned into a sentencepiece model without any
training: each token becomes a piece whose bytes are mapped to printable characters
and whose score is the negative rank, so that the lowest rank merges first; the
normaliser is the identity.  Texts are split into pre-tokens by a pattern, each
pre-token is encoded by the model, and ids are decoded by the inverse of the byte map.

Nulls count as empty texts; an empty text has no ids.  Repeated rows are encoded each,
an empty table gives an empty table.  Very long texts are split by the pattern and
encoded as a whole; sentencepiece merges with a queue, in n log n of a pre-token.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import released

#: Bytes of pre-tokens and their ids that each worker keeps, about; when full, the store starts anew.
CACHE_BYTES = 32 << 20
#: Only pre-tokens up to this many characters are kept.
CACHE_CHARS = 64


def byte_map() -> list[str]:
    """One printable character for each byte: itself where it is printable Latin-1, else from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], more = chr(more), more + 1
    return out


def piece_of(token: bytes, chars: list[str]) -> str:
    """The piece of a token: its bytes as characters."""
    return "".join([chars[b] for b in token])


def byte_of() -> np.ndarray:
    """The inverse of ``byte_map``: the byte of each code point."""
    out = np.zeros(max(map(ord, byte_map())) + 1, np.uint8)
    out[[ord(c) for c in byte_map()]] = np.arange(256)
    return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    out = {}
    for line in data.splitlines():
        if line.strip():
            token, rank = line.split()
            out[base64.b64decode(token)] = int(rank)
    return out


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol-buffer field: bytes are length-delimited, ints are varints, floats 32 bits."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece BPE model of a vocabulary; piece ids are ranks, the unknown piece comes last.

    Ranks run from 0 without gaps, and all 256 single bytes have one.
    """
    chars = byte_map()
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("each byte needs a rank")
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = piece_of(token, chars).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1))
    out += _field(1, _field(1, b"<unk>") + _field(2, float(-len(tokens))) + _field(3, 2))
    # trainer: model type BPE, id of the unknown piece, no other special ids
    none = (1 << 64) - 1
    out += _field(2, _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(k, none) for k in (41, 42, 43)))
    # normaliser: identity, no dummy prefix, white space kept as it is
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Codec:
    """Encodes and decodes with one vocabulary; made once in each worker."""

    _made: dict[tuple, Codec] = {}

    def __init__(self, data: bytes, pattern: str) -> None:
        import regex

        self.whole = read_ranks(data)
        chars = byte_map()
        #: The pieces of the model by id, and the byte of each of their characters.
        self.pieces = [piece_of(t, chars) for t in sorted(self.whole, key=self.whole.__getitem__)]
        self.byte_of = byte_of()
        self.to_chars = dict(enumerate(byte_map())) | {0xFF: "\n"}
        self.split = regex.compile(pattern)
        self.store: dict[str, bytes] = {}
        self.held = 0

    @cached_property
    def model(self):
        """Made when first encoded with; decoding needs none."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.whole))

    @classmethod
    def of(cls, data: bytes, pattern: str) -> Codec:
        key = (hashlib.sha256(data).digest(), pattern)
        if key not in cls._made:
            cls._made[key] = cls(data, pattern)
        return cls._made[key]

    def _new(self, tokens: list[str]) -> Iterator[tuple[str, bytes]]:
        raw = [t.encode() for t in tokens]
        rank = self.whole.get
        rest = [(t, b) for t, b in zip(tokens, raw) if b not in self.whole]
        yield from ((t, rank(b).to_bytes(4, "little")) for t, b in zip(tokens, raw) if b in self.whole)
        if rest:
            # no UTF-8 text holds the byte 0xFF, and no mapped byte is a line feed
            mapped = b"\xff".join([b for _, b in rest]).decode("latin-1").translate(self.to_chars).split("\n")
            for (t, _), ids in zip(rest, self.model.encode(mapped, num_threads=1)):
                yield t, array("I", ids).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; new pre-tokens of all texts are encoded in one call."""
        split = [self.split.findall(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.store, self.held = {}, 0
        store = self.store
        missing = set().union(*split) - store.keys()
        found = dict(self._new(list(missing)))
        short = {t: b for t, b in found.items() if len(t) <= CACHE_CHARS}
        store.update(short)
        # the text, its ids and their place
        self.held += sum(map(len, short)) + sum(map(len, short.values())) + 180 * len(short)
        for tokens in split:
            try:
                yield b"".join(map(store.__getitem__, tokens))
            except KeyError:
                yield b"".join([store.get(t) or found[t] for t in tokens])

    def decode(self, ids: bytes) -> bytes:
        """The pieces of the ids, joined, with each character as the byte it stands for."""
        mapped = "".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return self.byte_of[np.frombuffer(mapped.encode("utf-16-le"), "<u2")].tobytes()


def _vocabulary(df: DataFrame, path: str):
    """The vocabulary file, of a fixed size, sent to the workers; a path is read by the driver."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _slices(batch: pa.RecordBatch, of: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in column ``of``, one row at least."""
    start, held = 0, 0
    for k, n in enumerate(pa.compute.binary_length(batch.column(of)).to_pylist()):
        if k > start and held + (n or 0) > most:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", count: str = "n_tokens") -> DataFrame:
    """Add ``ids`` (binary, little-endian unsigned 32-bit integers) and ``count``; columns of these names are replaced."""
    data = _vocabulary(df, vocabulary)
    df = df.drop(ids, count)
    at = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(count, T.LongType()), T.StructField(ids, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        codec = Codec.of(data.value, pattern)
        for batch in batches:
            for part in _slices(batch, at):
                out = list(codec.encode([t or "" for t in part.column(at).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([len(b) // 4 for b in out], pa.int64()), pa.array(out, pa.binary())], names=[*part.schema.names, count, ids])
        released()

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded`` (binary): the bytes that ``ids`` stand for; null ids give no bytes."""
    data = _vocabulary(df, vocabulary)
    df = df.drop(decoded)
    at = df.columns.index(ids)
    schema = T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        codec = Codec.of(data.value, pattern)
        for batch in batches:
            for part in _slices(batch, at):
                out = [codec.decode(b or b"") for b in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, decoded])
        released()

    return df.mapInArrow(run, schema)
