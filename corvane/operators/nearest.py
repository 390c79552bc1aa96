"""The nearest targets of each S1 record by what they share, exactly, without a row for each pair.

S1 records of a country go in chunks, and each chunk meets all targets of its country once, in the order that breaks
ties.  A task holds one chunk and the best targets so far; targets pass by in blocks.  Products of pairs are sums in
arrays and never leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bits import Distances
from ..functions.bits import letters_of as _letters

#: Targets of a block, the least share of a block that makes a term's postings a full row, and the most products held at once.
BLOCK, FULL, PRODUCTS = 4096, 1 / 16, 1 << 23
#: The bounds of a chunk's size: targets are sent to each chunk of their country.
LEAST, MOST = 250, 8000

FOUND = "source1_entity_id string, candidate_entity_id string, score double"


def met(s1: DataFrame, targets: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], chunks: int = 16, found: str = FOUND, terms: DataFrame | None = None) -> DataFrame:
    """``work`` on rows (country_norm, chunk, side, target_source, entity_id, ...): of each chunk the S1 records (side 0), then targets (side 1) by source and id.

    Both frames have (country_norm, entity_id) and the same further columns, targets also ``target_source``.  ``terms``, with the same
    columns, are what a country's chunks must know before (side -1).
    """
    n = s1.groupBy("country_norm").agg(F.ceil(F.count("*") / F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.count("*") / chunks))).cast("int").alias("_n"))
    mine = s1.drop("target_source").join(n, "country_norm").withColumn("chunk", F.pmod(F.xxhash64("entity_id"), F.col("_n")).cast("int"))
    everywhere = lambda rows: rows.join(n, "country_norm").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    more = [c for c in targets.columns if c not in ("country_norm", "target_source", "entity_id")]
    side = lambda rows, k, source: rows.select("country_norm", "chunk", F.lit(k).alias("side"), source.alias("target_source"), "entity_id", *more)
    rows = side(mine, 0, F.lit("")).unionByName(side(everywhere(targets), 1, F.col("target_source")))
    if terms is not None:
        rows = rows.unionByName(side(everywhere(terms), -1, F.lit("")))
    parts = int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "country_norm", "chunk").sortWithinPartitions("country_norm", "chunk", "side", "target_source", "entity_id")
    return rows.mapInArrow(work, found)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((country, chunk), side), and a stretch of rows that have them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        country, chunk, side = (batch.column(c) for c in ("country_norm", "chunk", "side"))
        differ = np.zeros(batch.num_rows, bool)
        for c in (country, chunk, side):
            differ[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(differ).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            for at in range(a, b, BLOCK):
                yield ((country[at].as_py(), chunk[at].as_py()), side[at].as_py()), batch.slice(at, min(BLOCK, b - at))


class Best:
    """The ``k`` highest values above 0 of each S1 record, to ``digits`` if given; of equal ones the targets that came first."""

    def __init__(self, n: int, k: int, digits: int | None = None):
        self.digits, self.k, self.value, self.place = digits, k, [np.zeros(0)] * n, [np.zeros(0, np.int64)] * n
        #: Nothing at or under it can enter.
        self.floor = np.full(n, -1.0)

    def add(self, i: int, values: np.ndarray, start: int) -> None:
        new = np.flatnonzero(values > max(self.floor[i] - (0 if self.digits is None else 10.0**-self.digits), 0))
        found = values[new]
        if self.digits is not None:
            found = np.round(found, self.digits)
            new, found = new[found > self.floor[i]], found[found > self.floor[i]]
        if not len(new):
            return
        value = np.concatenate([self.value[i], found])
        order = np.argsort(-value, kind="stable")[: self.k]
        self.value[i], self.place[i] = value[order], np.concatenate([self.place[i], start + new])[order]
        if len(order) == self.k:
            self.floor[i] = self.value[i][-1]


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of an array of lists, and the row of each."""
    flat = column.flatten()
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return flat, np.repeat(np.arange(len(sizes)), sizes)


def _runs(terms: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(term, from, to) of sorted terms."""
    if len(terms):
        edges = [0, *(np.flatnonzero(np.diff(terms)) + 1).tolist(), len(terms)]
        yield from zip(terms[edges[:-1]].tolist(), edges, edges[1:])


def _emitted(ids: list[str], known: pa.ChunkedArray, found: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of FOUND from (S1 record, places of targets, scores)."""
    s, place, score = [], [], []

    def batch() -> pa.RecordBatch:
        n = np.repeat(s, [len(p) for p in place])
        candidates = known.take(pa.array(np.concatenate(place))).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.array(ids).take(pa.array(n)), candidates if isinstance(candidates, pa.Array) else candidates.chunk(0), pa.array(np.concatenate(score))], ["source1_entity_id", "candidate_entity_id", "score"])

    for i, p, x in found:
        if len(p):
            s.append(i), place.append(p), score.append(x)
        if len(s) == 200:
            yield batch()
            s, place, score = [], [], []
    if s:
        yield batch()


def most_common(top_k: int, shortlist: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of the ``shortlist`` targets with most tokens in common, the ``top_k`` by the share of common tokens, of equal ones the last; rows have ``tokens``, distinct."""

    class Chunk:
        def __init__(self):
            self.ids, self.tokens, self.known, self.sizes, self.n, self.best = [], [], [], [], 0, None

        def mine(self, rows: pa.RecordBatch) -> None:
            self.ids += rows.column("entity_id").to_pylist()
            self.tokens.append(rows.column("tokens"))

        def meet(self, rows: pa.RecordBatch) -> None:
            if self.best is None:
                flat, row = _lists(pa.chunked_array(self.tokens).combine_chunks() if len(self.tokens) > 1 else self.tokens[0])
                self.words = pc.unique(flat)
                term = pc.index_in(flat, self.words).to_numpy(zero_copy_only=False)
                self.own = np.split(term, np.searchsorted(row, np.arange(1, len(self.ids))))
                self.best = Best(len(self.ids), shortlist)
            flat, row = _lists(rows.column("tokens"))
            size = rows.num_rows
            term = pc.fill_null(pc.index_in(flat, self.words), -1).to_numpy(zero_copy_only=False)
            row, term = row[term >= 0], term[term >= 0]
            order = np.argsort(term, kind="stable")
            row, full, few = row[order], {}, {}
            for t, a, b in _runs(term[order]):
                if b - a > FULL * size:
                    full[t] = np.bincount(row[a:b], minlength=size).astype(np.int32)
                else:
                    few[t] = row[a:b]
            for i, own in enumerate(self.own):
                both = np.zeros(size, np.int32)
                for t in own.tolist():
                    if t in full:
                        both += full[t]
                    elif t in few:
                        both[few[t]] += 1
                self.best.add(i, both, self.n)
            self.known.append(rows.column("entity_id"))
            self.sizes.append(np.asarray(pc.list_value_length(rows.column("tokens"))))
            self.n += size

        def done(self) -> Iterator[pa.RecordBatch]:
            if self.best is None:
                return
            sizes = np.concatenate(self.sizes)

            def found():
                for i, own in enumerate(self.own):
                    both, place = self.best.value[i], self.best.place[i]
                    share = both / (len(own) + sizes[place] - both)
                    order = np.lexsort((-place, -share))[:top_k]
                    yield i, place[order], share[order]

            yield from _emitted(self.ids, pa.chunked_array(self.known), found())

    return _each(Chunk)


def largest_products(top_k: int, digits: int = 9) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``top_k`` targets with the largest products of vectors, to ``digits``.

    Rows have ``terms`` (numbers, each once), ``counts`` and ``norm``, S1 records also ``weights`` of the terms; a place of
    a vector is count times weight by norm.
    """
    return _each(_products(top_k, digits))


def _products(top_k: int, digits: int) -> type:
    class Chunk:
        def __init__(self):
            self.ids, self.rows, self.known, self.n, self.best = [], [], [], 0, None

        def mine(self, rows: pa.RecordBatch) -> None:
            self.ids += rows.column("entity_id").to_pylist()
            self.rows.append(rows)

        def begin(self) -> None:
            rows = pa.Table.from_batches(self.rows).combine_chunks()
            one = lambda c: rows.column(c).combine_chunks()
            flat, row = _lists(one("terms"))
            self.terms, term = np.unique(np.asarray(flat), return_inverse=True)
            weight = np.asarray(one("weights").flatten())
            self.weight = np.zeros(len(self.terms))
            self.weight[term] = weight
            x = np.asarray(one("counts").flatten()) * weight / np.asarray(one("norm"))[row]
            order = np.argsort(term, kind="stable")
            self.starts = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
            self.row, self.x, self.best, self.rows = row[order], x[order], Best(len(self.ids), top_k, digits), None

        def meet(self, rows: pa.RecordBatch) -> None:
            if self.best is None:
                self.begin()
            step = max(64, PRODUCTS // len(self.ids))
            for at in range(0, rows.num_rows, step):
                self.block(rows.slice(at, step))

        def block(self, rows: pa.RecordBatch) -> None:
            m, size = len(self.ids), rows.num_rows
            flat, row = _lists(rows.column("terms"))
            flat, count = np.asarray(flat), np.asarray(rows.column("counts").flatten())
            term = np.searchsorted(self.terms, flat)
            term[term == len(self.terms)] = 0
            same = self.terms[term] == flat if len(self.terms) else np.zeros(len(flat), bool)
            row, term, count = row[same], term[same], count[same]
            y = count * self.weight[term] / np.asarray(rows.column("norm"))[row]
            order = np.argsort(term, kind="stable")
            row, y = row[order], y[order]
            products, full = np.zeros((m, size)), []
            for t, a, b in _runs(term[order]):
                c, d = self.starts[t], self.starts[t + 1]
                if (b - a) * (d - c) * 60 > m * size:
                    full.append((a, b, c, d))
                else:
                    products[self.row[c:d, None], row[a:b]] += self.x[c:d, None] * y[a:b]
            for at in range(0, len(full), 256):
                left, right = np.zeros((m, len(full[at : at + 256]))), np.zeros((len(full[at : at + 256]), size))
                for k, (a, b, c, d) in enumerate(full[at : at + 256]):
                    left[self.row[c:d], k], right[k, row[a:b]] = self.x[c:d], y[a:b]
                products += left @ right
            for i in range(m):
                self.best.add(i, products[i], self.n)
            self.known.append(rows.column("entity_id"))
            self.n += size

        def done(self) -> Iterator[pa.RecordBatch]:
            if self.best is not None:
                yield from _emitted(self.ids, pa.chunked_array(self.known), zip(range(len(self.ids)), self.best.place, self.best.value))

    return Chunk


class Grams:
    """Codes of the n-grams inside words, exact, by an alphabet.  In a text each word stands between spaces of its own."""

    def __init__(self, letters: np.ndarray, ngrams: tuple[int, int]):
        self.known, (self.least, self.most) = np.unique(letters), ngrams
        # 0 stands for no letter, the last number for letters that aren't known
        self.base = len(self.known) + 2
        self.small = self.base**self.most < 1 << 63

    def coded(self, letters: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Codes of the stretches of ``n`` letters from the places ``at``."""
        number = np.searchsorted(self.known, letters)
        number[number == len(self.known)] = 0
        number = np.append(np.where(self.known[number] == letters, number + 1, len(self.known) + 1) if len(self.known) else np.ones(len(letters), np.int64), 0)
        each = (np.where(k < n, number[np.minimum(at + k, len(letters))], 0) for k in range(self.most))
        if not self.small:
            return np.ascontiguousarray(np.stack([*each], axis=1).astype(np.uint32)).view(f"U{self.most}").ravel()
        code = np.zeros(len(at), np.int64)
        for x in each:
            code = code * self.base + x
        return code

    def windows(self, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, row) of every n-gram; a word shorter than the least n counts once as a whole."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        begins = np.zeros(len(letters), bool)
        begins[1:] = (letters[1:] == 32) & (letters[:-1] == 32)
        begins[starts[sizes > 0]] = True
        word = np.cumsum(begins) - 1
        left = np.append(np.flatnonzero(begins)[1:], len(letters))[word] - np.arange(len(letters))
        at = [np.flatnonzero(begins & (left < self.least))]
        n = [left[at[0]]]
        for k in range(self.least, self.most + 1):
            at.append(np.flatnonzero(left >= k))
            n.append(np.full(len(at[-1]), k))
        at = np.concatenate(at)
        return at, np.concatenate(n), row[at]


GRAMS = "country_norm string, gram string, df long, cf long"


def counted_grams(ngrams: tuple[int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """GRAMS: in how many of a batch's texts of a country each n-gram is, and how often; rows are (country_norm, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(start, BLOCK)
                names = pc.unique(rows.column("country_norm"))
                country = pc.index_in(rows.column("country_norm"), names).to_numpy(zero_copy_only=False).astype(np.int64)
                letters, starts, sizes = _letters(rows.column("text"))
                grams = Grams(letters, ngrams)
                at, n, row = grams.windows(letters, starts, sizes)
                codes, first, gram = np.unique(grams.coded(letters, at, n), return_index=True, return_inverse=True)
                if not len(codes):
                    continue
                text = letters.astype(np.uint32).tobytes().decode("utf-32-le")
                spelled = pa.array([text[a : a + k] for a, k in zip(at[first].tolist(), n[first].tolist())], pa.string())
                once = np.unique(row * len(codes) + gram)
                place, cf = np.unique(country[row] * len(codes) + gram, return_counts=True)
                df = np.unique(country[once // len(codes)] * len(codes) + once % len(codes), return_counts=True)[1]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(place // len(codes))), spelled.take(pa.array(place % len(codes))), pa.array(df), pa.array(cf)], ["country_norm", "gram", "df", "cf"])

    return work


def largest_cosines(top_k: int, ngrams: tuple[int, int], digits: int = 9) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``largest_products`` of the vectors of ``text``: terms are rows with the n-gram as their id and its ``weight``."""

    class Chunk(_products(top_k, digits)):
        def __init__(self):
            super().__init__()
            self.learnt, self.grams = [], None

        def learn(self, rows: pa.RecordBatch) -> None:
            self.learnt.append(rows.select(["entity_id", "weight"]))

        def vectors(self, rows: pa.RecordBatch) -> pa.RecordBatch:
            if self.grams is None:
                spelled, weight = (pa.chunked_array([b.column(k) for b in self.learnt], kind).combine_chunks() for k, kind in enumerate((pa.string(), pa.float64())))
                letters, starts, sizes = _letters(spelled)
                self.grams = Grams(letters, ngrams)
                codes = self.grams.coded(letters, starts, sizes)
                order = np.argsort(codes)
                self.codes, self.weights, self.learnt = codes[order], np.asarray(weight)[order], []
            letters, starts, sizes = _letters(rows.column("text"))
            at, n, row = self.grams.windows(letters, starts, sizes)
            code, terms = self.grams.coded(letters, at, n), len(self.codes)
            term = np.searchsorted(self.codes, code)
            term[term == terms] = 0
            have = self.codes[term] == code if terms else np.zeros(len(code), bool)
            both, count = np.unique(row[have] * max(terms, 1) + term[have], return_counts=True)
            row, term = both // max(terms, 1), both % max(terms, 1)
            weight = self.weights[term]
            norm = np.sqrt(np.bincount(row, (count * weight) ** 2, rows.num_rows))
            offsets = pa.array(np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (term.astype(np.int32), count.astype(np.int32), weight)]
            return pa.RecordBatch.from_arrays([rows.column("entity_id"), lists[0], lists[1], pa.array(norm), lists[2]], ["entity_id", "terms", "counts", "norm", "weights"])

        def mine(self, rows: pa.RecordBatch) -> None:
            super().mine(self.vectors(rows))

        def meet(self, rows: pa.RecordBatch) -> None:
            super().meet(self.vectors(rows))

    return _each(Chunk)


def _each(chunk: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, None
        for (key, side), rows in _blocks(batches):
            if key != at:
                if now is not None:
                    yield from now.done()
                at, now = key, chunk()
            if side < 0:
                now.learn(rows)
            elif not side:
                now.mine(rows)
            elif now.ids:
                now.meet(rows)
        if now is not None:
            yield from now.done()

    return work


#: Cells of a table of letters, and pairs that share a key, counted with each key, that are held at once.
CELLS, MEETINGS = 1 << 22, 1 << 22
COUNTED = "source1_entity_id string, n long, best double"


def counted_by_key(weights: tuple[float, float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """COUNTED: how many targets share a key, and the best of their scores, a sum of the names' and the addresses' Levenshtein similarities by weight.

    Rows have ``keys`` (numbers, each once), ``name`` and ``address``.  All pairs are counted; a pair whose score can't exceed its
    record's best, by lengths or by the names alone, is not compared further.
    """

    class Group:
        """Some of a chunk's S1 records."""

        def __init__(self, rows: pa.Table):
            one = lambda c: rows.column(c).combine_chunks()
            self.ids = one("entity_id")
            flat, row = _lists(one("keys"))
            order = np.argsort(np.asarray(flat), kind="stable")
            self.keys, self.row = np.asarray(flat)[order], row[order]
            self.texts = [Distances(one(c)) for c in ("name", "address")]
            self.n, self.best = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), -1.0)

        def meet(self, keys: np.ndarray, row: np.ndarray, size: int, texts: list) -> None:
            """``keys`` of a block, sorted, and their rows."""
            first, n = np.searchsorted(keys, self.keys), np.searchsorted(keys, self.keys, side="right")
            n -= first
            # some S1 records at a time
            count = np.bincount(self.row, n, len(self.ids)).astype(np.int64)
            numbered = [(d.numbered(letters), starts, sizes) for d, (letters, starts, sizes) in zip(self.texts, texts)]
            share = np.maximum(np.cumsum(count) // MEETINGS, np.arange(len(count)) * size // (4 * MEETINGS))
            edges = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(count)]
            for a, b in zip(edges, edges[1:]):
                here = np.flatnonzero((self.row >= a) & (self.row < b) & (n > 0))
                if not len(here):
                    continue
                each = n[here]
                at = np.repeat(first[here] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                both = np.zeros((b - a, size), bool)
                both[np.repeat(self.row[here] - a, each), row[at]] = True
                self.n[a:b] += both.sum(1)
                i, j = np.nonzero(both)
                self.compare(i + a, j, numbered)

        def compare(self, i: np.ndarray, j: np.ndarray, numbered: list) -> None:
            name, address = self.texts
            for at in range(0, len(i), 1 << 17):
                a, b = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
                likely = [_similarity(np.abs(d.sizes[a] - sizes[b]), d.sizes[a], sizes[b]) for d, (_, _, sizes) in zip(self.texts, numbered)]
                hope = weights[0] * likely[0] + weights[1] * likely[1] > self.best[a] - 1e-12
                a, b, most = a[hope], b[hope], likely[1][hope]
                (letters, starts, sizes), theirs = numbered
                names = _similarity(name.to(a, letters, starts[b], sizes[b]), name.sizes[a], sizes[b])
                hope = np.flatnonzero(weights[0] * names + weights[1] * most > self.best[a] - 1e-12)
                # the likeliest of each record first, so that it spares the others
                likely = (weights[0] * names + weights[1] * most)[hope]
                order = np.lexsort((-likely, a[hope]))
                top = np.ones(len(order), bool)
                top[1:] = a[hope][order][1:] != a[hope][order][:-1]
                for some in (hope[order[top]], hope[order[~top]]):
                    some = some[weights[0] * names[some] + weights[1] * most[some] > self.best[a[some]] - 1e-12]
                    letters, starts, sizes = theirs
                    found = weights[0] * names[some] + weights[1] * _similarity(address.to(a[some], letters, starts[b[some]], sizes[b[some]]), address.sizes[a[some]], sizes[b[some]])
                    np.maximum.at(self.best, a[some], found)

    class Chunk:
        def __init__(self):
            self.ids, self.rows, self.groups = 0, [], None

        def mine(self, rows: pa.RecordBatch) -> None:
            self.ids += rows.num_rows
            self.rows.append(rows)

        def begin(self) -> None:
            rows = pa.Table.from_batches(self.rows)
            # texts of like length share a table of letters, as large as the longest needs
            cells = [np.asarray(pc.utf8_length(rows.column(c).combine_chunks())).astype(np.int64) for c in ("name", "address")]
            order = np.argsort(np.maximum(*cells), kind="stable")
            self.groups, at, self.rows = [], 0, None
            rows, longest = rows.take(pa.array(order)), np.maximum(*cells)[order]
            while at < len(order):
                n = np.arange(1, len(order) - at + 1)
                # no more letters than there are code points in use
                fits = n * np.minimum(np.cumsum(longest[at:]), 1 << 12) * (longest[at:] // 64 + 1) <= 64 * CELLS
                n = max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
                self.groups.append(Group(rows.slice(at, n).combine_chunks()))
                at += n

        def meet(self, rows: pa.RecordBatch) -> None:
            if self.groups is None:
                self.begin()
            flat, row = _lists(rows.column("keys"))
            order = np.argsort(np.asarray(flat), kind="stable")
            texts = [_letters(rows.column(c)) for c in ("name", "address")]
            for g in self.groups:
                g.meet(np.asarray(flat)[order], row[order], rows.num_rows, texts)

        def done(self) -> Iterator[pa.RecordBatch]:
            for g in self.groups or []:
                met = np.flatnonzero(g.n)
                yield pa.RecordBatch.from_arrays([g.ids.take(pa.array(met)), pa.array(g.n[met]), pa.array(g.best[met])], ["source1_entity_id", "n", "best"])

    return _each(Chunk)


def _similarity(distance: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.maximum(a, b)
    return np.where(most == 0, 1.0, 1.0 - distance / np.maximum(most, 1))
