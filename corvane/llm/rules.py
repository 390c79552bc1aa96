"""Quality rules: learned decision lists over statistics of whole texts.

Statistics of every text are computed in one pass.  From labelled rows a list of rules
is learned by sequential covering: a rule is a conjunction of thresholds, grown on one
part of the rows by information gain and pruned on the other; the rows it covers are
taken away, and the next rule is learned from the rest, until a rule no longer holds on
the pruning part.  The rules reject; what none covers is kept.  They come out as one
ordered Spark CASE expression.

Words are runs without white space.  A text fails the base rules with fewer than 20
words, or with more than 30 % of its words in 8-word windows that occur twice or more.

Defined cases: a null text has no words and fails.  Without labelled rows of both
labels the list is empty.  Repeated rows have a result each, an empty table gives an
empty table, other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows

WINDOW = 8
#: Labelled rows that a list is learned from at most, chosen by a hash of their id.
MAX_LABELLED = 20_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What thresholds are put on.
FEATURES = ("n_words", "mean_word", "symbols_per_word", "dup_line_part", "repeat_part", "upper_part", "digit_part", "distinct_part")
_SYMBOL = re.compile(r"[#*$%&|<>]")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """How many words lie in windows of ``size`` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # equal windows get equal numbers, doubling the length each time, so no hash is needed
    names, have = ids, 1
    while have < size:
        step = min(have, size - have)
        have += step
        rest = len(words) - have + 1
        names = np.unique(names[:rest] * (len(words) + 1) + names[step : step + rest], return_inverse=True)[1]
    twice = np.bincount(names)[names] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.subtract.at(edge, at + size, 1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def text_statistics(text: str) -> tuple:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            lines += 1
            dup += line in seen
            seen.add(line)
    word_chars = len(text) - sum(map(raw.count, (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")))
    symbols = len(_SYMBOL.findall(text))
    repeat = repeated_words(words)
    upper = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    digits = len(re.findall("[0-9]", text))
    chars, some = max(word_chars, 1), max(n, 1)
    return n, word_chars, symbols, dup, repeat, word_chars / some, symbols / some, dup / max(lines, 1), repeat / some, upper / chars, digits / chars, len(set(words)) / some


def statistics(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, the five counts, the further features) for each row."""
    names = [*COUNTS, *FEATURES[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_statistics(t or "") for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * len(names)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * (len(FEATURES) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=[id, *names])

    rows = df.select(F.col(id).cast("long").alias(id), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"{id} long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in FEATURES[1:]))


@dataclass(frozen=True)
class Rule:
    """A conjunction: each condition is (feature, ">=" or "<=", threshold)."""

    conditions: tuple[tuple[str, str, float], ...]

    def covers(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, op, t in self.conditions:
            v = x[:, FEATURES.index(f)]
            out &= v >= t if op == ">=" else v <= t
        return out

    def __str__(self) -> str:
        return " and ".join(f"{f} {op} {t:.6g}" for f, op, t in self.conditions)


def _best(x: np.ndarray, bad: np.ndarray, on: np.ndarray) -> tuple[float, tuple] | None:
    """The threshold with the most gain: bad rows kept times the gain in log precision."""
    p0, n0 = int((bad & on).sum()), int((~bad & on).sum())
    if not p0 or not n0:
        return None
    base, best = np.log2(p0 / (p0 + n0)), None
    rows = np.flatnonzero(on)
    for k, f in enumerate(FEATURES):
        order = rows[np.argsort(x[rows, k], kind="stable")]
        v, b = x[order, k], bad[order]
        ends = np.flatnonzero(v[1:] > v[:-1])  # a cut stands between two different values
        if not len(ends):
            continue
        p, n = np.cumsum(b)[ends], np.cumsum(~b)[ends]
        mid = (v[ends] + v[ends + 1]) / 2
        for op, pp, nn in (("<=", p, n), (">=", p0 - p, n0 - n)):
            gain = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1e-9) / np.maximum(pp + nn, 1e-9)) - base), -np.inf)
            at = int(np.argmax(gain))
            if best is None or gain[at] > best[0] + 1e-12:
                best = float(gain[at]), (f, op, float(mid[at]))
    return best


def learn(x: np.ndarray, bad: np.ndarray, most_rules: int = 12, most_conditions: int = 4, precision: float = 0.9, seed: int = 5) -> list[Rule]:
    """A decision list of rules that reject: learned on two thirds, pruned on a third of the rows.

    A rule stays if, on the rows for pruning that it still finds, it covers bad rows with the least precision.
    """
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    part = np.random.default_rng(seed).random(len(x))
    while len(rules) < most_rules:
        grow, prune = left & (part < 2 / 3), left & (part >= 2 / 3)
        on, conditions = grow.copy(), []
        while len(conditions) < most_conditions and (found := _best(x, bad, on)) and found[0] > 0:
            conditions.append(found[1])
            on &= Rule((found[1],)).covers(x)
        if not conditions:
            break

        def worth(r: Rule) -> tuple[float, int]:
            c = r.covers(x) & prune
            p, n = int((bad & c).sum()), int((~bad & c).sum())
            return (p - n) / max(p + n, 1), p

        options = [Rule(tuple(conditions[:k])) for k in range(1, len(conditions) + 1)]
        rule = max(options, key=lambda r: (*worth(r), -len(r.conditions)))
        c = rule.covers(x) & prune
        p, n = int((bad & c).sum()), int((~bad & c).sum())
        if p < 2 or p < precision * (p + n):
            break
        rules.append(rule)
        left &= ~rule.covers(x)
    return rules


def expression(rules: list[Rule]) -> Column:
    """The number of the first rule that covers the row, from 1; 0 if none does."""
    if not rules:
        return F.lit(0)
    out = None
    for k, r in enumerate(rules, 1):
        test = F.lit(True)
        for f, op, t in r.conditions:
            test = test & (F.col(f) >= t if op == ">=" else F.col(f) <= t)
        out = F.when(test, k) if out is None else out.when(test, k)
    return out.otherwise(0)


def fitted(stats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", bound: int = MAX_LABELLED) -> list[Rule]:
    """Learn from the statistics of at most ``bound`` labelled rows; label 1 is good, 0 bad."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(id).agg(F.min(label).alias("_label"))
    rows = bounded_rows(stats, known, id, bound).select(id, "_label", *FEATURES).toPandas().sort_values([id, *FEATURES], kind="stable")
    if rows["_label"].nunique() < 2:
        return []
    return learn(rows[list(FEATURES)].to_numpy(float), rows["_label"].to_numpy() == 0)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``base_failed``, ``rule`` (that rejects, 0 if none) and ``kept``."""
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", expression(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
