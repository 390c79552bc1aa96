"""Exact dedup with Patricia-trie owners.

Texts are equal when they agree after deleting white space.  The normalised texts are
dealt out by byte length and a hash of the content; a task inserts each full byte
string into a compressed radix trie, whose terminal nodes keep the owner and the number
of rows.  Before the shuffle each task does the same with its own rows, so that a text
with very many copies leaves a task once.  When the strings held by a trie pass a
bound, its largest subtree goes to a file of the task, and is merged with what comes
later by building the subtree again; the file goes when the task ends.

The owner is the row with the most code points in the original text, then the smallest
id.  Defined cases: ids are integers or strings (ordered by code point); a null text is
empty; all empty texts are equal.  A null id loses to every other id.  Each repeated row counts and gets its row in the result.  An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, field, released, text_of, unpacked, whole_row

#: Bytes of strings that a trie holds before subtrees are spilled.
HELD = 96 << 20


class _Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: tuple | None = None) -> None:
        self.label = label
        self.children: dict[int, _Node] = {}
        self.owner = owner


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: each step compares slices at once."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def better(a: tuple, b: tuple) -> tuple:
    """Merge two owners (code points, id or None, rows)."""
    x, y = (-a[0], a[1] is None, a[1]), (-b[0], b[1] is None, b[1])
    first = a if x <= y else b
    return first[0], first[1], a[2] + b[2]


class OwnerTrie:
    """A compressed radix trie from byte strings to owners, with spill of subtrees."""

    def __init__(self, held: int = HELD) -> None:
        self.root, self.bytes, self.held, self.files = _Node(b""), 0, held, {}

    def insert(self, key: bytes, owner: tuple) -> None:
        node, rest = self.root, key
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = _Node(rest, owner)
                self.bytes += len(rest) + 200
                break
            n = len(child.label)
            if rest[:n] != child.label:
                n = _common(rest, child.label)
                upper = _Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
            node, rest = child, rest[n:]
        else:
            node.owner = owner if node.owner is None else better(node.owner, owner)
        while self.bytes > self.held:
            self._spill()

    @staticmethod
    def _walk(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, tuple]]:
        todo = [(node, prefix)]
        while todo:
            node, prefix = todo.pop()
            whole = prefix + node.label
            if node.owner is not None:
                yield whole, node.owner
            todo += [(c, whole) for c in node.children.values()]

    def _size(self, node: _Node) -> int:
        todo, total = [node], 0
        while todo:
            node = todo.pop()
            total += len(node.label) + 200
            todo += node.children.values()
        return total

    def _spill(self) -> None:
        """Write the largest subtree below the root to the file of its first byte."""
        sizes = {b: self._size(c) for b, c in self.root.children.items()}
        if not sizes:
            self.bytes = 0
            return
        b = max(sizes, key=sizes.__getitem__)
        if b not in self.files:
            self.files[b] = tempfile.TemporaryFile()
        f = self.files[b]
        f.seek(0, os.SEEK_END)
        for item in self._walk(self.root.children.pop(b), b""):
            pickle.dump(item, f)
        self.bytes = sum(sizes.values()) - sizes[b]

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """All strings with their owners; what was spilled is merged again, in parts that fit."""
        for b, f in self.files.items():
            if b in self.root.children:
                f.seek(0, os.SEEK_END)
                for item in self._walk(self.root.children.pop(b), b""):
                    pickle.dump(item, f)
            yield from self._merged(f, 0, math.inf)
        self.files = {}
        yield from self._walk(self.root, b"")
        self.root = _Node(b"")

    def _merged(self, f, depth: int, above: float) -> Iterator[tuple[bytes, tuple]]:
        """The strings of a file: in a trie of their own if they fit, else dealt by hash to further files."""
        f.seek(0, os.SEEK_END)
        size = f.tell()
        # a part that no longer shrinks (a long key, or one key's rows) is merged as it is
        parts = min(64, 1 + 2 * size // self.held) if depth < 6 and size < above else 1
        if parts == 1:
            sub = OwnerTrie(1 << 62)
            for key, owner in _loaded(f):
                sub.insert(key, owner)
            yield from self._walk(sub.root, b"")
        else:
            files = [tempfile.TemporaryFile() for _ in range(parts)]
            for item in _loaded(f):
                pickle.dump(item, files[hash((depth, item[0])) % parts])
            f.close()
            for g in files:
                yield from self._merged(g, depth + 1, size)
        f.close()


def _loaded(f) -> Iterator[tuple[bytes, tuple]]:
    f.seek(0)
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


def _through_tries(rows: DataFrame) -> DataFrame:
    """Merge the rows (key, n_chars, id, n_rows) in each partition by key."""
    # sent as integers or text, whatever the kind of the ids
    kind = "string" if rows.schema["id"].dataType == T.StringType() else "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = OwnerTrie()
        for batch in batches:
            for key, n_chars, id, n in zip(*(c.to_pylist() for c in batch.columns)):
                trie.insert(key, (n_chars, id, n))
        held, out = 0, []
        for key, owner in trie.items():
            out.append((key, *owner))
            held += len(key)
            if held > 4 << 20 or len(out) >= 5000:
                yield _batch(out, kind)
                held, out = 0, []
        if out:
            yield _batch(out, kind)
        del trie, out
        released()

    return rows.withColumn("id", F.col("id").cast(kind)).mapInArrow(run, f"key binary, n_chars long, id {kind}, n_rows long")


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    kinds, names = [pa.binary(), pa.int64(), pa.string() if kind == "string" else pa.int64(), pa.int64()], ["key", "n_chars", "id", "n_rows"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def owners(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key_sha256, keep_id, group_size): one row per distinct normalised text."""
    t = text_of(text)
    key = F.encode(normalised(t), "UTF-8")
    rows = df.select(key.alias("key"), F.length(t).cast("long").alias("n_chars"), F.col(id).alias("id"), F.lit(1).cast("long").alias("n_rows"))
    merged = _through_tries(_through_tries(rows).repartition(F.octet_length("key"), F.xxhash64("key")))
    return merged.select(F.sha2("key", 256).alias("key_sha256"), F.col("id").alias("keep_id"), F.col("n_rows").alias("group_size"))


def exact_groups(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, ``text_sha256``, ``keep_id``, ``group_size``, ``kept``.

    Of rows repeated with the id that stays, each is marked as kept.
    """
    rows = df.select(F.col(id), F.sha2(F.encode(normalised(text_of(text)), "UTF-8"), 256).alias("text_sha256"))
    found = rows.join(owners(df, id, text), F.col("text_sha256") == F.col("key_sha256"))
    return found.select(id, "keep_id", "group_size", F.col(id).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one of each group, with their columns."""
    t = text_of(text)
    rows = df.select(whole_row(df), F.sha2(F.encode(normalised(t), "UTF-8"), 256).alias("sha"), F.length(t).alias("n"))
    found = rows.join(owners(df, id, text), (F.col("sha") == F.col("key_sha256")) & field(id).eqNullSafe(F.col("keep_id")))
    # rows that repeat the id that stays lie together after the join
    best = F.row_number().over(Window.partitionBy("sha", "keep_id").orderBy(F.col("n").desc(), field(text)))
    return unpacked(found.withColumn("at", best).where("at = 1"))
