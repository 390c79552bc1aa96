"""Quality classifier with supervised subword embeddings.

Each word, each character n-gram of a word, and each pair of neighbouring words has a
hashed bucket with a learned vector; a repeated word or line has a bucket of its own, by
how it repeats.  A text is the average of its vectors, a softmax layer gives the label's
probability, and all is trained by stochastic gradient descent in numpy on a bounded
sample of labelled texts, whole texts each.

With a linear output, a text's logit is the average of one number for each bucket, so
that scoring looks up a number for each n-gram, word and pair.  Buckets are made by
arithmetic on whole arrays of characters, so no words are kept.

A word is a run without white space, taken whole.  Long texts, and long words, are gone
through in stretches of ``STRETCH`` characters, so that they need little more than their size.

Defined cases: a null or empty text has no features, its score is that of the bias.
Repeated rows score alike, an empty table gives an empty table.  Without labels of both
kinds, every score is the share of label 1 (0.5 without any).  Other columns are kept;
a column named like the score is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_rows, released
from .near import mix, word_hashes

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (3, 4)
#: Texts that the model is trained on at most, chosen by a hash of their id.
MAX_TEXTS = 4_000
EPOCHS = 6
RATE = 0.2
#: Buckets set apart for how words and lines repeat, and for words in capitals or without letters and digits.
SAME_WORD, SAME_LINE, UPPER, SYMBOLS = range(4)
_APART = 16
#: Characters that are worked on at once.
STRETCH = 1 << 17
#: How often a repeated word counts: as much as the buckets of a word do together.
REPEAT_WEIGHT = 12

_U = np.uint64
#: Stands for white space, before and after each word.
_EDGE = np.uint32(0x110000)
_ALNUM, _CAPITAL, _SMALL = 1, 2, 4


def _kind(c: str) -> int:
    return _ALNUM * c.isalnum() | _CAPITAL * c.isupper() | _SMALL * (c.islower() or c.istitle() and not c.isupper())


@lru_cache
def _kinds() -> np.ndarray:
    return np.array([_kind(chr(c)) for c in range(0x10000)], np.uint8)


def kinds_of(codes: np.ndarray) -> np.ndarray:
    """What each character is."""
    out = _kinds()[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        found, at = np.unique(codes[high], return_inverse=True)
        out[high] = np.array([_kind(chr(c)) for c in found], np.uint8)[at]
    return out


def bucket(h: np.ndarray) -> np.ndarray:
    """The bucket of each hash."""
    return _APART + ((mix(h) >> _U(32)) * _U(BUCKETS - _APART) >> _U(32)).astype(np.int64)


def text_buckets(text: str) -> tuple[Iterator[np.ndarray], np.ndarray]:
    """The buckets of a text's n-grams, words and pairs, part by part with repeats, and the counts of the first ``_APART`` buckets."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), "<u4")
    blank = (codes == 32) | (codes >= 9) & (codes <= 13)
    apart = np.zeros(_APART)
    words, _ = word_hashes([text])
    if not len(words):
        return iter(()), apart
    start = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    size = np.flatnonzero(~blank[:-1] & blank[1:]) + 1 - start
    has = np.zeros(len(start), np.uint8)
    for lo in range(int(start[0]), len(codes), STRETCH):
        kinds = kinds_of(codes[lo : lo + STRETCH])
        first, past = np.searchsorted(start, lo, "right") - 1, np.searchsorted(start, lo + len(kinds))
        has[first:past] |= np.bitwise_or.reduceat(kinds, np.maximum(start[first:past], lo) - lo)
    apart[UPPER] = np.count_nonzero((has & _CAPITAL > 0) & (has & _SMALL == 0) & (size > 1))
    apart[SYMBOLS] = np.count_nonzero(has & _ALNUM == 0)
    apart[SAME_WORD] = REPEAT_WEIGHT * np.count_nonzero(words[1:] == words[:-1])
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += len(line.encode("utf-8", "replace").split())
        seen.add(line)
    apart[SAME_LINE] = REPEAT_WEIGHT * again
    return _parts(codes, blank, words), apart


def _parts(codes: np.ndarray, blank: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    for lo in range(0, len(codes), STRETCH):
        part = slice(lo, lo + STRETCH + GRAMS[-1] - 1)
        gap = blank[part]
        c = np.where(gap, _EDGE, codes[part]).astype(_U)
        for n in GRAMS:
            k = min(STRETCH, len(c) - n + 1)
            if k <= 0:
                continue
            # a gram may begin or end with the edge of a word, and lies within one word
            h, within = c[:k], np.ones(k, bool)
            for j in range(1, n):
                h = h * _U(0x9E3779B97F4A7C15) + c[j : j + k]
                if j < n - 1:
                    within &= ~gap[j : j + k]
            yield bucket(h[within] + _U(n))
    for lo in range(0, len(words), STRETCH):
        w = words[lo : lo + STRETCH + 1]
        yield bucket(w[:STRETCH] ^ _U(0xA0761D6478BD642F))
        yield bucket(w[:-1] * _U(0x9E3779B97F4A7C15) + w[1:] * _U(0xC2B2AE3D27D4EB4F))


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets, in order, and how often each occurs."""
    parts, apart = text_buckets(text)
    if len(text) <= STRETCH:
        found, n = np.unique(np.concatenate([*parts, np.empty(0, np.int64)]), return_counts=True)
    else:
        every = np.zeros(BUCKETS, np.int64)
        for b in parts:
            every += np.bincount(b, minlength=BUCKETS)
        found = np.flatnonzero(every)
        n = every[found]
    own = np.flatnonzero(apart)
    return np.concatenate([own, found]), np.concatenate([apart[own], n])


@dataclass(frozen=True)
class Model:
    """One number for each bucket and a bias: the logit of a text is the bias plus the average of its buckets' numbers."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        parts, apart = text_buckets(text)
        total, n = float(apart @ self.weights[:_APART]), float(apart.sum())
        for b in parts:
            total += float(self.weights[b].sum(dtype=float))
            n += len(b)
        return float(1 / (1 + np.exp(-np.clip(self.bias + total / max(n, 1.0), -30, 30))))


def packed_counts(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """A text's buckets (in order) and counts, compressed: what training needs of it."""
    return zlib.compress(np.diff(buckets, prepend=0).astype("<u4").tobytes() + counts.astype("<f4").tobytes(), 1)


def unpacked_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    half = len(raw) // 2
    return np.cumsum(np.frombuffer(raw[:half], "<u4").astype(np.int64)), np.frombuffer(raw[half:], "<f4").astype(float)


def train(texts: list[str], labels: list[int], seed: int = 3) -> Model:
    """Train on whole texts."""
    return train_counts([packed_counts(*counted(t)) for t in texts], labels, seed)


def train_counts(data: list[bytes], labels: list[int], seed: int = 3) -> Model:
    """Softmax over two labels on averaged vectors, by stochastic gradient descent with a falling rate.

    ``data`` are the ``packed_counts`` of each text.  A label counts by the inverse of its share, capped at 3 to 1.
    """
    y = np.array(labels, float)
    share = float(y.mean()) if len(y) else 0.5
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS
    out = np.zeros((2, DIMENSIONS))
    bias = np.array([0.0, 0.0])
    weight = (min(3.0, max(1.0, share / (1 - share))), min(3.0, max(1.0, (1 - share) / share)))
    steps, done = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(data)):
            rate = RATE * (1 - done / steps)
            done += 1
            b, n = unpacked_counts(data[k])
            part = n / n.sum() if len(b) else n
            hidden = part @ vectors[b]
            z = out @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(y[k])] -= 1
            p *= weight[int(y[k])]
            back = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= 0.1 * rate * p
            # normalised: the text's average moves by the rate, however many buckets it has
            vectors[b] -= (rate / max(part @ part, 1e-9)) * part[:, None] * back
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id: str = "doc_id"):
    """Rows whose CRC-32 of the id as text leaves no remainder by 5; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id).cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def fitted(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", bound: int = MAX_TEXTS) -> Model:
    """Train on at most ``bound`` labelled texts that aren't held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id)).groupBy(id).agg(F.min(label).alias("_label"))
    rows = bounded_rows(df.select(id, F.col(text).cast("string").alias("_text")), known, id, bound).select(id, "_label", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [packed_counts(*counted(t or "")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=[id, "label", "counts"])
        released()

    # executors count; the driver gets counts, at most BUCKETS for a text, however long it is
    fields = [df.schema[id], T.StructField("label", T.LongType()), T.StructField("counts", T.BinaryType())]
    found = rows.select(id, F.col("_label").cast("long").alias("_label"), "_text").mapInArrow(run, T.StructType(fields)).collect()
    found = sorted((r[0], bytes(r[2]), r[1]) for r in found)
    model = train_counts([x[1] for x in found], [x[2] for x in found])
    del found
    released()
    return model


def scored(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with ``score``, the probability of label 1."""
    df = df.drop(score)
    at = df.columns.index(text)
    # the model has a fixed size
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            made = [model.score(t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=[*batch.schema.names, score])
        released()

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(score, T.DoubleType())]))
