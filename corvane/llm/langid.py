"""Language identification by Bayesian fusion of evidence.

Four pieces of evidence are joined for a page: the likelihood of its text under hashed
character trigrams of each language; the language its markup declares; the suffix of
its address (and a path segment that names a language); and the prior of its host.

Text models are fitted on a bounded sample of labelled texts.  How far declarations and
suffixes can be trusted is estimated from all pages, by a grouped aggregation of the text
posteriors for each declared value.  Host priors are smoothed in steps: the host's
counts are shrunk towards its domain's, those towards its suffix's, those towards the
counts of all pages; counts are sums of posteriors over all pages, and a page's own
posterior is taken out of its prior.

Defined cases: a null page or address is empty; a text without letters gives no
evidence; a page without any evidence gets the prior of all pages.  Ties go to the
language that is first in order.  Repeated rows have a result each.  Without labelled
texts, language and probability are null.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, released, written

BUCKETS = 1 << 15
#: Labelled texts that the models are fitted on at most, chosen by a hash of their id.
MAX_TEXTS = 4_000
#: The weight of a text is that of its trigrams, up to so many: neighbouring trigrams depend on each other, and one
#: page's text must not drown what its host says.  All trigrams count in the average that is weighed.
MOST_TRIGRAMS = 150
#: Trigrams that are weighed at once.
STRETCH = 1 << 18
#: Weight of the level above in counts of pages, from host to domain, suffix, and all.
STRENGTH = 5.0
#: A table of declared values with at most as many rows is broadcast; a larger one is joined by a shuffle.
SMALL = 10_000
#: Elements whose text isn't part of the page's.
HIDDEN = ("script", "style", "nav", "footer", "aside", "noscript", "template")
_MARK = re.compile(rf"<(?:(!--)|({'|'.join(HIDDEN)})\b)?", re.I)
_END = {"!--": re.compile("-->")} | {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
_ENTITY = re.compile(r"&#?\w+;")
_OPEN = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*(?:[\"']\s*)?([A-Za-z]{2,3})", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)
_SEGMENT = re.compile(r"^[a-z][a-z0-9+.-]*://[^/?#]+/([a-z]{2})(?:[/?#.]|$)", re.I)


def visible(html: str) -> str:
    """The text of a page without hidden parts, comments and tags, in one pass.

    A part that is opened and never closed is a tag like others.  Where an end was looked for in
    vain it isn't looked for again, so time stays in proportion to the page.
    """
    out, at, none = [], 0, set()
    while found := _MARK.search(html, at):
        name, end = (found[1] or found[2] or "").lower(), None
        if name and name not in none:
            end = _END[name].search(html, found.end())
            if not end:
                none.add(name)
        past = end.end() if end else html.find(">", found.end()) + 1
        if not past:
            break  # no tag ends from here on
        out.append(html[at : found.start()])
        at = past
    out.append(html[at:])
    return _ENTITY.sub(" ", " ".join(out))


def declared(html: str) -> str:
    """The language that the first html tag with one declares, anywhere in the page; each tag is read once, so time stays in proportion."""
    at = 0
    while found := _OPEN.search(html, at):
        end = html.find(">", found.end())
        end = len(html) if end < 0 else end
        if lang := _LANG.search(html, found.end(), end):
            return lang[1].lower()
        at = end
    return ""


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the text in small letters, runs of other characters as one space."""
    raw = re.sub(r"[\W\d_]+", " ", f" {text} ").lower().encode()
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return ((b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA77 + b[2:] * 0xC2B2AE3D) >> 17).astype(np.int64) % BUCKETS


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # languages x buckets
    most: int = MOST_TRIGRAMS

    def log_likelihood(self, text: str) -> np.ndarray:
        t = trigrams(text)
        if not len(t):
            return np.zeros(len(self.languages))
        total = np.zeros(len(self.languages))
        for at in range(0, len(t), STRETCH):
            total += self.log_p[:, t[at : at + STRETCH]].sum(axis=1, dtype=float)
        return (total - total.max()) / len(t) * min(len(t), self.most)


def counted(rows: Iterable[tuple[str, str]]) -> dict[str, np.ndarray]:
    """How often each bucket occurs in the texts of a language, from (language, text)."""
    counts: dict[str, np.ndarray] = {}
    for lang, text in rows:
        if lang not in counts:
            counts[lang] = np.zeros(BUCKETS, np.int64)
        counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    return counts


def model_of(counts: dict[str, np.ndarray]) -> TextModel:
    """Smoothed shares of the buckets, languages in order."""
    languages = tuple(sorted(counts))
    shares = np.array([counts[x] + 0.1 for x in languages]).reshape(len(languages), BUCKETS)
    return TextModel(languages, np.log(shares / shares.sum(axis=1, keepdims=True)).astype(np.float32))


def fit_texts(rows: list[tuple[str, str]]) -> TextModel:
    return model_of(counted(rows))


def fitted(documents: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = MAX_TEXTS) -> TextModel:
    known = documents.where(F.col(lang).isNotNull() & F.col(id).isNotNull()).groupBy(id).agg(F.min(lang).alias("_lang"))
    rows = bounded_rows(documents.select(id, F.col(text).cast("string").alias("_text")), known, id, bound).select("_lang", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, n in counted(zip(batch.column(0).to_pylist(), (t or "" for t in batch.column(1).to_pylist()))).items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "at", "n"])
        released()

    # executors count; what comes to the driver is a number for each language and bucket
    found = rows.mapInArrow(run, "lang string, at long, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).groupBy("lang")
    counts = {}
    for r in found.agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n")).collect():
        counts[r["lang"]] = np.zeros(BUCKETS, np.int64)
        counts[r["lang"]][r["at"]] = r["n"]
    return model_of(counts)


def parts_of(url: str) -> tuple[str, str, str, str]:
    """Host, domain (last two labels), suffix (last label), and the path segment that may name a language."""
    found = _HOST.match(url)
    host = found[1].lower().rstrip(".") if found else ""
    labels = host.split(".")
    segment = _SEGMENT.match(url)
    return host, ".".join(labels[-2:]), labels[-1], segment[1].lower() if segment else ""


def evidence(pages: DataFrame, model: TextModel, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, host, domain, suffix, segment, markup, text): ``text`` is the log likelihood of each language."""
    sent = pages.sparkSession.sparkContext.broadcast(model)
    names = [id, "host", "domain", "suffix", "segment", "markup", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, htmls = (c.to_pylist() for c in batch.columns)
            addresses = [parts_of(u or "") for u in urls]
            markup = [declared(h or "") for h in htmls]
            text = [sent.value.log_likelihood(visible(h or "")).astype(float).tolist() for h in htmls]
            columns = list(zip(*addresses)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, pa.string()) for c in columns], pa.array(markup, pa.string()), pa.array(text, pa.list_(pa.float64()))], names=names)
        released()

    rows = pages.select(F.col(id).cast("long").alias(id), F.col(url).cast("string").alias("u"), F.col(html).cast("string").alias("h"))
    return rows.mapInArrow(run, f"{id} long, host string, domain string, suffix string, segment string, markup string, text array<double>")


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return F.transform(e, lambda v: v / total)


def _sums(n: int, of: str = "post") -> list[Column]:
    return [F.sum(F.get(F.col(of), F.lit(k))).alias(f"n{k}") for k in range(n)]


def _array(n: int) -> Column:
    return F.array(*[F.col(f"n{k}") for k in range(n)])


def _trust(rows: DataFrame, column: str, n: int) -> DataFrame:
    """(column, log P(value | language)) from all pages, smoothed; a missing value says nothing."""
    counts = rows.groupBy(column).agg(*_sums(n)).select(column, _array(n).alias("c"))
    totals = rows.agg(*_sums(n)).select(_array(n).alias("t"))
    log_p = F.transform(F.arrays_zip("c", "t"), lambda x: F.log((x["c"] + 0.5) / (x["t"] + 5.0)))
    # the totals are one row
    return counts.crossJoin(F.broadcast(totals)).select(F.col(column).alias(f"_{column}"), F.when(F.col(column) == "", F.array(*[F.lit(0.0)] * n)).otherwise(log_p).alias(f"{column}_log"))


def identified(pages: DataFrame, model: TextModel, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``id``, ``lang``, ``probability``, ``text_lang``, ``markup``, ``host``."""
    n = len(model.languages)
    if not n:
        rows = pages.select(F.col(id).cast("long").alias(id), *[F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("probability", "double"), ("text_lang", "string"), ("markup", "string"), ("host", "string"))])
        return rows
    rows = written(evidence(pages, model, id, url, html))
    zero = F.lit(0.0)
    base = rows.withColumn("post", _softmax(F.col("text")))
    add = lambda *names: F.transform(F.arrays_zip(*names), lambda x: sum((x[c] for c in names[1:]), x[names[0]]))
    for column in ("markup", "suffix", "segment"):
        t = written(_trust(base, column, n))
        if t.limit(SMALL + 1).count() <= SMALL:
            t = F.broadcast(t)
        base = base.join(t, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")
        base = base.withColumn(f"{column}_log", F.coalesce(f"{column}_log", F.array(*[zero] * n)))
    said = base.withColumn("said", add("text", "markup_log", "suffix_log", "segment_log")).withColumn("post", _softmax(F.col("said")))
    said = written(said.select(id, "host", "domain", "suffix", "markup", "text", "said", "post"))
    hosts = said.groupBy("host", "domain", "suffix").agg(*_sums(n), F.count("*").alias("rows"))
    domains = hosts.groupBy("domain", "suffix").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)])
    suffixes = domains.groupBy("suffix").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)])
    whole = suffixes.agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(n)]).select(_array(n).alias("all_n"))
    tree = hosts.select("host", F.col("domain").alias("d"), F.col("suffix").alias("s"), _array(n).alias("host_n"))
    tree = tree.join(domains.select(F.col("domain").alias("d"), _array(n).alias("domain_n")), "d")
    tree = tree.join(suffixes.select(F.col("suffix").alias("s"), _array(n).alias("suffix_n")), "s").crossJoin(F.broadcast(whole))
    # written, so that pages are joined between plain exchanges, of which a frequent host's part can be split
    tree = written(tree.select(F.col("host").alias("h"), "host_n", "domain_n", "suffix_n", "all_n"))
    found = said.join(tree, F.col("host") == F.col("h"))

    def shrunk(counts: str, above: Column) -> Column:
        """Counts without the page's own posterior, shrunk towards the level above."""
        own = F.transform(F.arrays_zip(F.col(counts).alias("c"), F.col("post").alias("p"), above.alias("a")), lambda x: F.struct(F.greatest(x["c"] - x["p"], zero).alias("c"), x["a"].alias("a")))
        total = F.aggregate(own, zero, lambda t, x: t + x["c"])
        return F.transform(own, lambda x: (x["c"] + F.lit(STRENGTH) * x["a"]) / (total + STRENGTH))

    found = found.withColumn("prior", shrunk("all_n", F.array(*[F.lit(1.0 / n)] * n)))
    for level in ("suffix_n", "domain_n", "host_n"):
        found = found.withColumn("prior", shrunk(level, F.col("prior")))
    found = found.withColumn("p", _softmax(F.transform(F.arrays_zip("said", "prior"), lambda x: x["said"] + F.log(x["prior"]))))
    names = F.array(*[F.lit(x) for x in model.languages])
    first = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    return found.select(id, first(F.col("p")).alias("lang"), F.array_max("p").alias("probability"), F.when(F.array_max("text") > F.array_min("text"), first(F.col("text"))).alias("text_lang"), "markup", "host")
