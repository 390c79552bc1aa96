"""Similarities of strings and sets.

Set similarities are built-in array functions.  String similarities without a built-in
function are Arrow functions on arrays (``bits``); each distinct pair of a batch is worked on once.
"""

from __future__ import annotations

import difflib
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bits


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    return ratio(shared(a, b), F.size(F.array_union(a, b)))


def overlap_coefficient(a: Column, b: Column) -> Column:
    return ratio(shared(a, b), F.least(F.size(a), F.size(b)))


def char_ngrams(x: Column, n: int = 3) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(n)))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def address_overlaps(a: Column, b: Column) -> Column:
    """At least two shared tokens that make up at least 35 % of the shorter set."""
    return (shared(a, b) >= 2) & (overlap_coefficient(a, b) >= 0.35)


def rule_score(name: Column, address: Column, numbers: Column) -> Column:
    return F.lit(0.68) * name + F.lit(0.24) * address + F.when(numbers, F.lit(0.08)).otherwise(F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.levenshtein(a, b).cast("double") / most)


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each place of ``a``."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|); two empty texts are equal."""
    n = len(a) + len(b)
    return 1.0 if n == 0 else 2.0 * _lcs(a, b) / n


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best of the shared tokens against each side, and of the two sides with the shared tokens before the rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    rest = [" ".join(sorted(s)) for s in (x - y, y - x)]
    if both and not all(rest):
        return 1.0
    sides = [f"{both} {r}".strip() for r in rest]
    found = [indel(*sides)]
    if both:
        found += [indel(both, s) for s in sides]
    return max(found)


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro similarity, raised by a common prefix of up to four characters where it is over 0.7."""
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken, mine = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(mine, (c for c, t in zip(b, taken) if t))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * weight * (1 - jaro) if jaro > 0.7 else jaro


def sequence_ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b).ratio()


def _many(f, one):
    """``f`` on arrays of distinct pairs, ``one`` on pairs with a long text."""
    return partial(bits.on_pairs, f, one)


_indels, _jaro_winklers, _sequence_ratios = _many(bits.indel, indel), _many(bits.jaro_winkler, jaro_winkler), _many(bits.sequence_ratio, sequence_ratio)


def _token_sorts(a: pd.Series, b: pd.Series):
    """As ``token_sort``; each text's tokens are sorted once."""
    ordered = {t: " ".join(sorted(t.split())) for t in {*a, *b}}
    return _indels([ordered[t] for t in a], [ordered[t] for t in b])


def _token_sets(a: pd.Series, b: pd.Series):
    """As ``token_set``; two sides begin with the shared tokens, so that only their rests are compared."""
    sets = {t: frozenset(t.split()) for t in {*a, *b}}
    shared, rests = [], ([], [])
    for x, y in zip(a, b):
        x, y = sets[x], sets[y]
        shared.append(len(" ".join(sorted(x & y))) if x and y else -1)
        rests[0].append(" ".join(sorted(x - y)))
        rests[1].append(" ".join(sorted(y - x)))
    shared = np.array(shared, np.int64)
    n = [np.array([len(r) for r in side], np.int64) for side in rests]
    total = np.maximum(n[0] + n[1], 1)
    # both rests are there: their common subsequence comes back from the ratio
    common = np.rint(_indels(*rests) * total / 2).astype(np.int64)
    begin = np.where(shared > 0, shared + 1, 0)
    sizes = [begin + k for k in n]
    best = 2.0 * (begin + common) / np.maximum(sizes[0] + sizes[1], 1)
    for size in sizes:
        best = np.where(shared > 0, np.maximum(best, 2.0 * shared / np.maximum(shared + size, 1)), best)
    best = np.where((shared > 0) & ((n[0] == 0) | (n[1] == 0)), 1.0, best)
    return np.where(shared < 0, 0.0, best)


def _arrow(f, a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        # each distinct pair of a batch once
        (i, x), (j, y) = pd.factorize(a.fillna("")), pd.factorize(b.fillna(""))
        code, back = np.unique(i * max(len(y), 1) + j, return_inverse=True)
        return pd.Series(f(x[code // max(len(y), 1)], y[code % max(len(y), 1)])[back], dtype="float64")

    return run(a, b)


indel_ratio = partial(_arrow, _indels)
token_sort_ratio = partial(_arrow, _token_sorts)
token_set_ratio = partial(_arrow, _token_sets)
jaro_winkler_similarity = partial(_arrow, _jaro_winklers)
sequence_matcher_ratio = partial(_arrow, _sequence_ratios)


def blocking_score(name_a: Column, name_b: Column, address_a: Column, address_b: Column) -> Column:
    """0.7 of the names' and 0.3 of the addresses' token-sort ratio."""
    return F.lit(0.7) * token_sort_ratio(name_a, name_b) + F.lit(0.3) * token_sort_ratio(address_a, address_b)
