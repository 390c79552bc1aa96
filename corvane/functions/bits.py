"""String similarities of many pairs at once, on arrays, equal to those of ``similarity`` to the last bit.

A text's letters are bits of a word of 64; longer texts are worked on one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

ONE = np.uint64(1)
#: Pairs worked on together.
MOST = 2048


def letters_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, where each text begins, and its length."""
    found = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.asarray(pc.utf8_length(texts)).astype(np.int64)
    return found, np.cumsum(sizes) - sizes, sizes


class Distances:
    """Levenshtein distances of some texts to others, many pairs at once: a bit for each letter of the former, in words of 64."""

    def __init__(self, texts: pa.Array):
        found, starts, self.sizes = letters_of(texts)
        self.known, letter = np.unique(found, return_inverse=True)
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = np.arange(len(found)) - starts[row]
        self.width = len(self.known) + 1
        self.table = np.zeros((max(1, -(-int(self.sizes.max(initial=0)) // 64)), len(self.sizes) * self.width), np.uint64)
        np.bitwise_or.at(self.table, (place // 64, row * self.width + letter), np.uint64(1) << (place % 64).astype(np.uint64))

    def numbered(self, letters: np.ndarray) -> np.ndarray:
        """The letters' numbers here; those that no text has share the last one."""
        if not len(self.known):
            return np.zeros(len(letters), np.int64)
        at = np.minimum(np.searchsorted(self.known, letters), len(self.known) - 1)
        return np.where(self.known[at] == letters, at, len(self.known))

    def to(self, rows: np.ndarray, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int = 1 << 14) -> np.ndarray:
        """Distances of texts ``rows`` to stretches of numbered letters."""
        found = np.empty(len(rows), np.int64)
        # texts of like length pass together
        order = np.lexsort((-sizes, self.sizes[rows] > 64))
        for at in range(0, len(order), most):
            some = order[at : at + most]
            some = some[np.argsort(-sizes[some], kind="stable")]
            found[some] = self._to(rows[some], letters, starts[some], sizes[some])
        return found

    def _to(self, rows: np.ndarray, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mine, base, one = self.sizes[rows], rows * self.width, np.uint64(1)
        words = max(1, -(-int(mine.max(initial=0)) // 64))
        up, down = np.full((words, len(rows)), ~np.uint64(0)), np.zeros((words, len(rows)), np.uint64)
        steps = np.arange(int(sizes.max(initial=0)))
        for step, n in zip(steps.tolist(), (len(rows) - np.searchsorted(sizes[::-1], steps, side="right")).tolist()):
            cell = base[:n] + letters[starts[:n] + step]
            more, less = one, None
            for w in range(words):
                p, m, equal = up[w, :n], down[w, :n], self.table[w][cell]
                either = equal | m
                if less is not None:
                    equal |= less
                across = (((equal & p) + p) ^ p) | equal
                plus, minus = m | ~(across | p), p & across
                out = (plus >> np.uint64(63), minus >> np.uint64(63)) if w + 1 < words else None
                plus, minus = (plus << one) | more, minus << one
                if less is not None:
                    minus |= less
                up[w, :n], down[w, :n] = minus | ~(either | plus), plus & either
                if out:
                    more, less = out
        found = sizes.copy()
        for w in range(words):
            left = np.clip(mine - 64 * w, 0, 64).astype(np.uint64)
            mask = np.where(left == 64, ~np.uint64(0), (one << (left % np.uint64(64))) - one)
            found += np.bitwise_count(up[w] & mask).astype(np.int64) - np.bitwise_count(down[w] & mask).astype(np.int64)
        return found


class Pairs:
    """Distinct texts ``a`` and ``b``, of at most 64 letters each, and pairs of them by their places ``i`` and ``j``."""

    def __init__(self, a: list[str], b: list[str], i: np.ndarray, j: np.ndarray):
        self.places = Distances(pa.array(b, pa.string()))
        letters, self.starts, self.a_sizes = letters_of(pa.array(a, pa.string()))
        # one more, so that places beyond the last text can be looked up
        self.own, self.letters, self.b_sizes = np.append(letters, -1), np.append(self.places.numbered(letters), len(self.places.known)), self.places.sizes
        self.b_starts = np.cumsum(self.b_sizes) - self.b_sizes
        self.b_letters = np.append(letters_of(pa.array(b, pa.string()))[0], -1)
        self.i, self.j = i, j

    def some(self) -> list[np.ndarray]:
        """The pairs, longest texts first, in stretches."""
        order = np.argsort(-self.a_sizes[self.i], kind="stable")
        return [order[at : at + MOST] for at in range(0, len(order), MOST)]

    def masks(self, i: np.ndarray, j: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where in b the letter at place ``at`` of a is, a bit for each place."""
        letter = self.letters[np.minimum(self.starts[i] + at, len(self.letters) - 1)]
        return self.places.table[0][j * self.places.width + letter]

    def lcs(self) -> np.ndarray:
        """Lengths of the longest common subsequences."""
        found = np.empty(len(self.i), np.int64)
        for some in self.some():
            i, j = self.i[some], self.j[some]
            row = np.full(len(some), ~np.uint64(0))
            sizes = self.a_sizes[i]
            for k in range(int(sizes[0])):
                n = int(np.searchsorted(-sizes, -k, side="left"))
                hit = row[:n] & self.masks(i[:n], j[:n], k)
                row[:n] = (row[:n] + hit) | (row[:n] - hit)
            found[some] = np.bitwise_count(~row & _low(self.b_sizes[j]))
        return found

    def jaro_winkler(self, weight: float = 0.1) -> np.ndarray:
        out = np.zeros(len(self.i))
        for some in self.some():
            i, j = self.i[some], self.j[some]
            a, b = self.a_sizes[i], self.b_sizes[j]
            reach = np.maximum(a, b) // 2 - 1
            taken, mine = np.zeros(len(some), np.uint64), np.zeros(len(some), np.uint64)
            for k in range(int(a[0])):
                n = int(np.searchsorted(-a, -k, side="left"))
                window = _low(np.minimum(b[:n], np.maximum(k + reach[:n] + 1, 0))) & ~_low(np.clip(k - reach[:n], 0, 64))
                free = self.masks(i[:n], j[:n], k) & window & ~taken[:n]
                first = free & (~free + ONE)
                taken[:n] |= first
                mine[:n] |= np.where(first != 0, ONE << np.uint64(k), np.uint64(0))
            m = np.bitwise_count(mine).astype(np.int64)
            moved, x, y = np.zeros(len(some), np.int64), mine.copy(), taken.copy()
            for k in range(int(m.max(initial=0))):
                here = np.flatnonzero(m > k)
                p, q = x[here], y[here]
                p, q = p & (~p + ONE), q & (~q + ONE)
                x[here] ^= p
                y[here] ^= q
                at, to = np.bitwise_count(p - ONE).astype(np.int64), np.bitwise_count(q - ONE).astype(np.int64)
                moved[here] += self.own[self.starts[i[here]] + at] != self.b_letters[self.b_starts[j[here]] + to]
            moved //= 2
            with np.errstate(divide="ignore", invalid="ignore"):
                jaro = (m / a + m / b + (m - moved) / m) / 3
            prefix, same = np.zeros(len(some), np.int64), np.ones(len(some), bool)
            for k in range(4):
                same &= (k < a) & (k < b)
                same &= self.own[np.minimum(self.starts[i] + k, len(self.own) - 1)] == self.b_letters[np.minimum(self.b_starts[j] + k, len(self.b_letters) - 1)]
                prefix += same
            found = np.where(jaro > 0.7, jaro + prefix * weight * (1 - jaro), jaro)
            out[some] = np.where(m == 0, 0.0, found)
        return out

    def matched(self) -> np.ndarray:
        """Letters in difflib's matching blocks: the longest common stretch, first in a, then in b, and so on at both sides of it."""
        found = np.zeros(len(self.i), np.int64)
        pair = np.arange(len(self.i))
        parts = np.stack([pair, np.zeros_like(pair), self.a_sizes[self.i], np.zeros_like(pair), self.b_sizes[self.j]])
        while parts.shape[1]:
            parts = parts[:, (parts[1] < parts[2]) & (parts[3] < parts[4])]
            order = np.argsort(parts[2] - parts[1], kind="stable")
            parts, more = parts[:, order], []
            for at in range(0, parts.shape[1], MOST):
                more += self._longest(parts[:, at : at + MOST], found)
            parts = np.concatenate(more, axis=1) if more else parts[:, :0]
        return found

    def _longest(self, parts: np.ndarray, found: np.ndarray) -> list[np.ndarray]:
        pair, a, a_end, b, b_end = parts
        width = int((a_end - a).max())
        at = np.arange(width)[:, None]
        now = self.masks(self.i[pair], self.j[pair], a + at) & (_low(b_end) & ~_low(b))
        now[at >= a_end - a] = 0
        each, more, left = now, [], np.flatnonzero(now.any(0))
        now = each = now[:, left]
        k = 1
        while len(left):
            # bit j at place i: the k letters up to i are those up to j
            after = np.zeros_like(now)
            after[1:] = each[1:] & (now[:-1] << ONE)
            alive = after.any(0)
            done = ~alive
            if done.any():
                last, who = now[:, done], left[done]
                i = (last != 0).argmax(0)
                bits = last[i, np.arange(len(who))]
                j = np.bitwise_count((bits & (~bits + ONE)) - ONE).astype(np.int64)
                i = i + a[who]
                np.add.at(found, pair[who], k)
                more.append(np.stack([pair[who], a[who], i - k + 1, b[who], j - k + 1]))
                more.append(np.stack([pair[who], i + 1, a_end[who], j + 1, b_end[who]]))
            now, each, left, k = after[:, alive], each[:, alive], left[alive], k + 1
        return more


def _low(n: np.ndarray) -> np.ndarray:
    """Words with the ``n`` lowest bits, up to 64."""
    n = n.astype(np.uint64)
    return np.where(n >= 64, ~np.uint64(0), (ONE << (n % np.uint64(64))) - ONE)


def on_pairs(work: Callable[[Pairs], np.ndarray], one: Callable[[str, str], float], a, b) -> np.ndarray:
    """``work`` on distinct pairs of short texts, ``one`` on those with a longer one."""
    (i, a), (j, b) = pd.factorize(np.asarray(a, object)), pd.factorize(np.asarray(b, object))
    code, back = np.unique(i * max(len(b), 1) + j, return_inverse=True)
    i, j = code // max(len(b), 1), code % max(len(b), 1)
    a, b = a.tolist(), b.tolist()
    out = np.zeros(len(code))
    short = np.array([len(x) <= 64 for x in a], bool)[i] & np.array([len(x) <= 64 for x in b], bool)[j]
    for k in np.flatnonzero(~short).tolist():
        out[k] = one(a[i[k]], b[j[k]])
    if short.any():
        cut = lambda texts: [x if len(x) <= 64 else "" for x in texts]
        out[short] = work(Pairs(cut(a), cut(b), i[short], j[short]))
    return out[back]


def _ratio(found: Callable[[Pairs], np.ndarray]) -> Callable[[Pairs], np.ndarray]:
    def work(pairs: Pairs) -> np.ndarray:
        n = pairs.a_sizes[pairs.i] + pairs.b_sizes[pairs.j]
        return np.where(n == 0, 1.0, 2.0 * found(pairs) / np.maximum(n, 1))

    return work


indel, sequence_ratio, jaro_winkler = _ratio(Pairs.lcs), _ratio(Pairs.matched), Pairs.jaro_winkler
