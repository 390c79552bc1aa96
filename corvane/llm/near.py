"""Near-duplicates by DartMinHash signatures and a banded join.

A document is the set of its five-word shingles (words are runs without white space; a
text of one to four words is one shingle), or with ``weighting="count"`` the multiset.
Darts are thrown by hash into the unit regions of each element's weight, in the order
of their arrival rank; a signature keeps for each coordinate the dart that arrives
first.  Only darts below a rank that falls with the total weight are made, so that a
signature costs about ``k (ln k + 2)`` darts for any length of text.  Two signatures
agree in a coordinate with the (weighted) Jaccard similarity as probability.

``ROWS`` coordinates make a band, and documents that share a band are candidates:
at similarity 0.8 a pair is missed with probability (1 - 0.8**6)**24, under 0.001.
Candidates are verified by their whole shingle sets, and verified links joined into
classes.  First each document is compared with the smallest id that it shares a bucket
with.  A bucket that then still holds several classes takes its smallest member as
pivot and compares it with all members of other classes, and so on with sixteen times as
many further pivots in each round, until one class is left or the pivots are used up.
No pair within a class need be made, so a bucket of n copies costs some n comparisons,
not their square.

In a large group of texts just below the threshold most pairs are not near, and a bound
rules them out before they are made.  A shingle is rare if three undecided documents
have it at most.  Pairs that share a rare shingle are few, and compared first.  Two other
sets of n and m shingles, r and s of them not rare, share min(r, s) at most, and are no
link if that is under ``least`` / (1 + ``least``) of n + m.  No link is lost by this.
A pair that shares several buckets is made in one of them.

Copies of a word sequence collapse into their smallest id before that.

Defined cases: ids are integers; null texts are empty; texts without a word are copies of each other.
Rows that share an id are one document.  Rows with a null id have a class of their
own (null) and are kept.  An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import field, released, unpacked, whole_row, written, written_with

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
#: Characters of texts that are worked on at once (one text at least), and bytes of them.
PART_CHARS = 500_000
STRETCH = 1 << 18
#: Edges that one task joins up, instead of rounds of shuffles.
FEW_EDGES = 100_000
#: Each round takes so many times the pivots of the round before.
STEP = 16

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64 bits (multiply and shift)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, one after the other, and how many words each text has.

    A word's hash is the sum of a hash of each byte and its place.  Bytes are worked on by stretches, so that a
    text of any length, or one long word, needs little more than its own size.
    """
    raw = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    b = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    del raw
    blank = _BLANK[b]
    start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])[: len(b)])
    out = np.zeros(len(start), _U)
    for lo in range(int(start[0]) if len(start) else len(b), len(b), STRETCH):
        hi = min(lo + STRETCH, len(b))
        first, past = np.searchsorted(start, lo, "right") - 1, np.searchsorted(start, hi)
        cut = np.maximum(start[first:past], lo) - lo
        place = np.arange(lo, hi) - np.repeat(start[first:past], np.diff(np.append(cut, hi - lo)))
        value = mix(place.astype(_U) * _U(256) + b[lo:hi] + _U(0xC2B2AE3D27D4EB4F))
        value[blank[lo:hi]] = 0
        out[first:past] += np.add.reduceat(value, cut)
    return out, np.bincount(np.searchsorted(ends, start, "right"), minlength=len(texts))


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The hashes of the words and of the shingles of each text, one for each place; all texts are worked on together."""
    h, counts = word_hashes(texts)
    whole = _folded(h, size)
    words, out, at = [], [], 0
    for n in counts.tolist():
        words.append(h[at : at + n])
        # a text of fewer words is one shingle, one without a word has none
        out.append(whole[at : at + n - size + 1] if n >= size else _folded(words[-1], n))
        at += n
    return words, out


def _folded(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each ``n`` neighbours."""
    if not 0 < n <= len(h):
        return np.empty(0, _U)
    out = np.full(len(h) - n + 1, n, _U)
    for k in range(n):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[k : len(h) - n + k + 1])
    return out


def signatures(elements: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """The DartMinHash signatures (documents x k, 64 bits) of weighted sets without repeats; empty sets give zeros.

    An element of weight w (1 where none are given) has the region from 0 to w, cut into layers of height 1
    (the top one lower).
    """
    weights = [np.ones(len(e)) for e in elements] if weights is None else weights
    sizes = np.array([len(e) for e in elements], np.int64)
    e = np.concatenate(elements) if len(elements) else np.empty(0, _U)
    w = np.concatenate(weights).astype(float) if len(weights) else np.empty(0)
    doc = np.repeat(np.arange(len(elements)), sizes)
    total = np.bincount(doc, w, len(elements)) if len(e) else np.zeros(len(elements))
    layers = np.ceil(w).astype(np.int64)
    if (layers != 1).any():
        layer = np.arange(layers.sum()) - np.repeat(np.cumsum(layers) - layers, layers)
        w, e, doc = (np.repeat(x, layers) for x in (w, e, doc))
        w, e = w - layer, e + layer.astype(_U) * _U(0xD1342543DE82EF95)
    top, e = np.minimum(1.0, w), mix(e)
    signature, first = np.zeros(len(elements) * k, _U), np.full(len(elements) * k, np.inf)
    below = (k * (math.log(k) + 2)) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        on = todo[doc]
        _throw(e[on], doc[on], top[on], below, k, signature, first)
        todo &= np.isinf(first.reshape(-1, k)).any(axis=1)
        below = below * 2
    return signature.reshape(-1, k)


def _throw(e, doc, top, below, k, signature, first) -> None:
    """Throw the darts of each element (one in each layer of its region) that arrive below a rank, several at a time where few elements are left."""
    rank, j = np.zeros(len(e)), 0
    limit = below[doc]
    while len(e):
        n = max(1, min(256, 8192 // len(e)))
        dart = mix(e[:, None] + np.arange(j + 1, j + n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
        j += n
        gap = -np.log(((dart >> _U(11)).astype(float) + 0.5) * 2.0**-53)
        # added one by one, whatever their number, so that ranks are the same to the last bit
        gap[:, 0] += rank
        ranks = np.cumsum(gap, axis=1)
        on = ranks < limit[:, None]
        last = on[:, -1]
        at, dart, came = np.repeat(np.arange(len(e)), on.sum(axis=1)), dart[on], ranks[on]
        place = mix(dart ^ _U(0xA0761D6478BD642F))
        high = top[at]
        if (high < 1).any():
            hit = (mix(dart + _U(0xE7037ED1A0B428DB)) >> _U(11)).astype(float) * 2.0**-53 < high
            at, dart, came, place = at[hit], dart[hit], came[hit], place[hit]
        cell = doc[at] * k + (place % _U(k)).astype(np.int64)
        np.minimum.at(first, cell, came)
        won = first[cell] == came
        signature[cell[won]] = dart[won]
        e, doc, top, limit, rank = e[last], doc[last], top[last], limit[last], ranks[last, -1]


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band (documents x bands)."""
    s = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), s.shape[:2]).copy()
    for r in range(rows):
        out = mix(out * _U(0x9E3779B97F4A7C15) + s[:, :, r])
    return out.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of sorted arrays without repeats."""
    if len(a) == 0 or len(b) == 0:
        return 0.0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return both / (len(a) + len(b) - both)


def _parts(ids: list, texts: list, most: int = PART_CHARS) -> Iterator[tuple[list, list]]:
    start = held = 0
    for k, t in enumerate(texts):
        if k > start and held + len(t or "") > most:
            yield ids[start:k], texts[start:k]
            start, held = k, 0
        held += len(t or "")
    if len(texts) > start:
        yield ids[start:], texts[start:]


def signed(df: DataFrame, id: str = "doc_id", text: str = "text", weighting: str = "set", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, key, bands): ``key`` identifies the word sequence; ``bands`` is null for texts without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, places = shingles(texts)
                keys = [hashlib.sha256(w.tobytes()).digest()[:16] for w in words]
                found = [np.unique(x, return_counts=True) for x in places]
                some = np.array([len(w) > 0 for w in words], bool)
                # the elements of a set weigh 1, those of a multiset their count
                weights = [c if weighting == "count" else np.ones(len(c)) for _, c in found]
                made = band_keys(signatures([e for e, _ in found], weights, bands * rows), bands, rows)
                ends = np.concatenate([[0], np.cumsum(some) * bands]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~some, False)), pa.array(made[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), lists], names=["id", "key", "bands"])
        released()

    rows_in = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows_in.mapInArrow(run, "id long, key binary, bands array<long>")


def shingle_sets(df: DataFrame) -> DataFrame:
    """(id, set, n) from (id, text): 32 bits of each shingle's hash, sorted, without repeats, and how many shingles differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = [np.unique(x) for x in shingles(texts)[1]]
                sets = [np.unique((h >> _U(32)).astype(np.uint32)).tobytes() for h in whole]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary()), pa.array([len(h) for h in whole], pa.int64())], names=["id", "set", "n"])
        released()

    return df.mapInArrow(run, "id long, set binary, n long")


def rare_shingles(df: DataFrame) -> DataFrame:
    """(ids, met) from (id, text): for each one, two or three ids how many shingles are in the texts of just these rows.

    Of each shingle only its count, smallest and largest id and the exclusive or of its
    ids are kept, so that a frequent one is never gathered: the third id follows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sets = [np.unique(x) for x in shingles(texts)[1]]
                h, owner = np.concatenate(sets), np.repeat(np.array(ids, np.int64), [len(x) for x in sets])
                order = np.lexsort((owner, h))
                h, owner = h[order], owner[order]
                starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][: len(h)])
                if len(starts):
                    ends = np.r_[starts[1:], len(h)]
                    columns = [h[starts].view(np.int64), ends - starts, owner[starts], owner[ends - 1], np.bitwise_xor.reduceat(owner, starts)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "rows", "lo", "hi", "odd"])
        released()

    met = df.mapInArrow(run, "h long, rows long, lo long, hi long, odd long").groupBy("h")
    met = met.agg(F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bit_xor("odd").alias("odd")).where("rows <= 3")
    third = F.when(F.col("rows") == 3, F.col("odd").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi"))).otherwise(F.col("lo"))
    return met.groupBy(F.array_distinct(F.array("lo", third, "hi")).alias("ids")).agg(F.count("*").alias("met"))


def verified(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Those of the pairs (a, b) whose sets have the least similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            # a set that is shorter by more than the similarity allows needs no comparison
            on = [k for k in range(len(a)) if min(len(x[k]), len(y[k])) >= (least - 1e-9) * max(len(x[k]), len(y[k])) and similarity(np.frombuffer(x[k], np.uint32), np.frombuffer(y[k], np.uint32)) >= least - 1e-12]
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in on], pa.int64()), pa.array([b[k] for k in on], pa.int64())], names=["a", "b"])
        released()

    # sorted merges at every size, so that what moves grows in proportion
    side = lambda id, c: sets.select(F.col("id").alias(id), F.col("set").alias(c)).hint("merge")
    found = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return found.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def joined_up(edges: DataFrame) -> DataFrame:
    """(id, least) for each id in the edges (a, b), by a union of sets in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        ids = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], names=["id", "least"])

    return edges.coalesce(1).mapInArrow(run, "id long, least long")


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(id, least) for each id in the edges (a, b): the smallest id it is linked with, by alternating large and small stars.

    What one task can do (``few`` edges at most, a fixed number) is left to one task; the result is the same.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        flipped = e.select(F.col("b").alias("a"), F.col("a").alias("b"))
        around = e.unionByName(flipped) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        rows = around.join(least, "a")
        if large:
            moved = rows.where("b > a").select("b", "m")
        else:
            moved = rows.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        return moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    now, sign = written_with(edges.where("a <> b").distinct(), **_sign("a", "b"))
    if sign["rows"] <= few:
        return joined_up(now)
    before = None
    while sign != before:
        before = sign
        now, sign = written_with(star(star(now, True), False), **_sign("a", "b"))
    return now.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), "least")


def roots(parents: DataFrame) -> DataFrame:
    """(id, least) of a forest (id, parent) with smaller parents, by pointer jumping: a row for each id that is no root."""
    now, sign = written_with(parents.select("id", F.col("parent").alias("least")), **_sign("id", "least"))
    before = None
    while sign != before:
        before = sign
        above = now.select(F.col("id").alias("p"), F.col("least").alias("q"))
        jumped = now.join(above, F.col("least") == F.col("p"), "left").select("id", F.coalesce("q", "least").alias("least"))
        now, sign = written_with(jumped, **_sign("id", "least"))
    return now


def _sign(a: str, b: str) -> dict[str, Column]:
    """Rows and the sum of their hashes, by which a table is known again."""
    return {"rows": F.count("*"), "sign": F.sum(F.xxhash64(a, b).cast("decimal(38,0)"))}


def _class_of(rows: DataFrame, classes: DataFrame, of: str, name: str) -> DataFrame:
    """Add ``name``: the class of the id in column ``of``, which is the id itself where no link is known."""
    known = classes.select(F.col("id").alias("_id"), F.col("least").alias("_least"))
    return rows.join(known, F.col(of) == F.col("_id"), "left").withColumn(name, F.coalesce("_least", of)).drop("_id", "_least")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes after further links (a, b): whole classes are linked, so only their ids are worked on."""
    ends = _class_of(_class_of(links, classes, "a", "x"), classes, "b", "y").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    merged = written(components(ends))
    moved = _class_of(classes.withColumnRenamed("least", "old"), merged, "old", "least").select("id", "least")
    # a root has no row of its own until its class goes into another
    return written(moved.unionByName(merged.where("id <> least")))


def near_groups(df: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: ``id``, ``class_id`` (the smallest id of its class), ``kept`` (whether it is that one)."""
    rows = written(signed(df, id, text))
    # written, so that joins on the key are between plain exchanges, of which a frequent key's part can be split
    first = written(rows.groupBy("key").agg(F.min("id").alias("rep")))
    reps = rows.where("bands is not null and id is not null").join(first.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & (F.col("id") == F.col("rep")))
    members = written(reps.select("rep", F.explode("bands").alias("bucket")))
    buckets = written(members.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot < last").select("bucket", "pivot"))
    members = written(members.join(buckets, "bucket").select("bucket", "rep", "pivot").distinct())
    wanted = members.select(F.col("rep").alias("id")).distinct()
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sets = written(shingle_sets(texts.join(wanted.hint("merge"), "id")))
    # one comparison for each document first: with the smallest id that it shares a bucket with
    pairs = members.where("rep <> pivot").groupBy(F.col("rep").alias("a")).agg(F.min("pivot").alias("b"))
    classes = roots(verified(pairs, sets, least).groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent")))
    (left, _), most = _unsettled(members.select("bucket", "rep"), classes), 1
    undecided = written(left.groupBy(F.col("rep").alias("id")).agg(F.collect_set("bucket").alias("among")))
    rare = written(rare_shingles(texts.join(undecided.select("id").hint("merge"), "id")))
    sizes = written(_sizes(sets.select("id", "n").join(undecided.select("id"), "id"), rare))
    more, found = written_with(verified(_rare_pairs(rare, sizes, classes, least), sets, least), rows=F.count("*"))
    if found["rows"]:
        classes = _joined(classes, more)
    left = left.select("bucket", "rep").join(sizes.join(undecided, "id").withColumnRenamed("id", "rep"), "rep")
    while True:
        left, open_ = _unsettled(left, classes, least)
        if not open_["rows"]:
            break
        ranked = left.withColumn("at", F.row_number().over(Window.partitionBy("bucket").orderBy("rep")))
        pivots = written(ranked.where(F.col("at") <= most).drop("at"))
        other = left.select(F.col("bucket").alias("k"), F.col("rep").alias("a"), F.col("class").alias("c"), F.col("n").alias("m"), F.col("r").alias("s"), F.col("among").alias("with"))
        # of all buckets that a pair shares one makes it
        near = _reaches(F.least("r", "s"), F.col("n") + F.col("m"), least) & (F.array_min(F.array_intersect("among", "with")) == F.col("bucket"))
        found = pivots.join(other, (F.col("bucket") == F.col("k")) & (F.col("rep") < F.col("a")) & (F.col("class") != F.col("c")) & near)
        more, linked = written_with(verified(found.select("a", F.col("rep").alias("b")), sets, least), rows=F.count("*"))
        left = left.join(pivots.select("bucket", "rep"), ["bucket", "rep"], "left_anti").select("bucket", "rep", "n", "r", "among")
        if linked["rows"]:
            classes = _joined(classes, more)
        most *= STEP
    named = _class_of(rows.select("id", "key").join(first, "key"), classes, "rep", "class").select(F.col("id").alias(id), F.when(F.col("id").isNotNull(), F.col("class")).alias("class_id"))
    return named.withColumn("kept", F.col(id).isNull() | (F.col(id) == F.col("class_id")))


def _reaches(shared: Column, both: Column, least: float) -> Column:
    """Whether two sets that share so many elements, and have ``both`` together, can have the least similarity."""
    return shared * (1 + least) >= both * least - 1e-6


def _sizes(sets: DataFrame, rare: DataFrame) -> DataFrame:
    """(id, n, r): shingles, and those of them that are not rare; of an id with several texts ``n`` is the least and ``r`` the most."""
    own = rare.select(F.explode("ids").alias("id"), "met").groupBy("id").agg(F.sum("met").alias("own"))
    sizes = sets.groupBy("id").agg(F.min("n").alias("n"), F.max("n").alias("top"), F.count("*").alias("texts"))
    return sizes.join(own, "id", "left").select("id", "n", F.when(F.col("texts") > 1, F.col("top")).otherwise(F.col("n") - F.coalesce("own", F.lit(0))).alias("r"))


def _rare_pairs(rare: DataFrame, sizes: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of different classes that share rare shingles, and enough of them or of others to be a link."""
    two = lambda i, j: F.struct(F.col("ids")[j].alias("a"), F.col("ids")[i].alias("b"))
    pairs = F.when(F.size("ids") == 2, F.array(two(0, 1))).otherwise(F.array(two(0, 1), two(1, 2), two(0, 2)))
    met = rare.where(F.size("ids") > 1).select(F.explode(pairs).alias("p"), "met").groupBy("p.a", "p.b").agg(F.sum("met").alias("met"))
    met = _class_of(_class_of(met, classes, "a", "x"), classes, "b", "y").where("x <> y")
    met = met.join(sizes.withColumnRenamed("id", "a"), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("r").alias("s")), "b")
    return met.where(_reaches(F.col("met") + F.least("r", "s"), F.col("n") + F.col("m"), least)).select("a", "b")


def _unsettled(members: DataFrame, classes: DataFrame, least: float | None = None) -> tuple[DataFrame, dict]:
    """The members of buckets that hold several classes, with their class, and how many there are.

    With ``least``, members have ``n`` and ``r``, and those that reach no size of text
    from the bucket's smallest on go too.
    """
    rows = _class_of(members, classes, "rep", "class")
    if least is not None:
        rows = rows.where(F.col("r") >= F.col("n") * least - 1e-6)
    low = [F.min("n").alias("low")] if least is not None else []
    open_ = rows.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y"), *low).where("x < y").drop("x", "y")
    # written for the same reason as the first ids of keys
    rows = rows.join(written(open_), "bucket")
    if least is not None:
        rows = rows.where(_reaches(F.col("r"), F.col("n") + F.col("low"), least)).drop("low")
    return written_with(rows, rows=F.count("*"))


def drop_near_copies(df: DataFrame, id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that stay: one document of each class, with its columns; rows with a null id stay."""
    kept = near_groups(df, id, text, least).where("kept").select(F.col(id).alias("stays")).where("stays is not null").distinct()
    rows = df.select(whole_row(df))
    found = rows.where(field(id).isNotNull()).join(kept, field(id) == F.col("stays"), "left_semi")
    return unpacked(found.unionByName(rows.where(field(id).isNull())))
