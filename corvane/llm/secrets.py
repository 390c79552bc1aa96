r"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

Every historical version of a file is addressed by the SHA-256 of its content.  A stored
ledger keeps which blobs were scanned with which rule versions, and the findings.  A scan
takes only the pairs that the ledger lacks, each blob once however many paths hold it, and
findings are joined back to all paths and versions that hold the blob.

Matches are leftmost and non-overlapping per rule; positions count code points, the
end is exclusive.  They come from splitting a text at the matches: the lengths of the
pieces between and of the matches, summed up, are the positions.

Defined cases: a null content is empty and has no findings.  Repeated rows are paths
of their own with the same findings.  A null path is kept.  An empty table gives an
empty table; other columns are ignored.  Ties of start are ordered as the rules are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds candidates; those stay whose group ``group`` has ``least`` characters at least.

    A finding is the whole match, or with ``tail`` the group alone, which then ends the match.  Texts without the
    literal ``needs`` have none, and aren't searched by the pattern.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: str = "1"
    tail: bool = False
    needs: str = ""


# The patterns and lengths of the base rules. A run of hex digits or of
# an access key is found whole, so its least length can stand in the pattern itself.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, needs="AKIA"),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Further rules: private-key headers and JSON web tokens.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1, needs="PRIVATE KEY-----"),
    # only at the beginning of a run, so that each run is read once
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", 1, 24, "2", True, "eyJ"),
)
RULES = BASE + MORE


KINDS = "array<struct<kind:string,version:string>>"
SPANS = "array<struct<start:bigint,ord:int,kind:string,end:bigint,version:string>>"


def addressed(versions: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, content, blob): nulls become empty texts."""
    return versions.select(F.col(path).alias("path"), text_of(content).alias("content")).withColumn("blob", F.sha2(F.encode("content", "UTF-8"), 256))


def _pairs(rules: tuple[Rule, ...]) -> Column:
    return F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]).cast(KINDS)


def unseen(rows: DataFrame, seen: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, content, todo): each blob of ``rows`` once, with the rule versions that ``seen`` (blob, scanned) lacks, if any.

    All rows of a blob hold the same text, so the first will do; each task sends one on.
    """
    texts = rows.groupBy("blob").agg(F.first("content").alias("content"))
    known = seen.groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("known"))
    todo = F.array_except(_pairs(rules), F.coalesce("known", F.array().cast(KINDS)))
    return texts.join(known, "blob", "left").select("blob", "content", todo.alias("todo")).where(F.size("todo") > 0)


def findings(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, scanned, spans) from (blob, content, todo): the findings of the rules to do, in order; one row per blob."""
    found = []
    for k, r in enumerate(rules):
        text, pattern = F.col("content"), F.lit(r.pattern)
        hit = F.array_contains(F.col("todo.kind"), r.kind) & text.contains(r.needs) & text.rlike(r.pattern)
        zipped = F.arrays_zip(
            F.transform(F.split(text, r.pattern, -1), lambda x: F.length(x)).alias("gap"),
            F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x)).alias("len"),
            F.transform(F.regexp_extract_all(text, pattern, F.lit(r.group)), lambda x: F.length(x)).alias("kept"),
        )
        own = lambda x: x["kept"] if r.tail else x["len"]  # noqa: B023, E731
        zipped = F.transform(zipped, lambda x: F.struct(F.lit(k).alias("ord"), x["gap"].alias("gap"), x["len"].alias("len"), own(x).alias("own"), (x["kept"] >= r.least).alias("kept")))
        found.append(F.when(hit, F.filter(zipped, lambda x: x["len"].isNotNull())))
    kind = "array<struct<ord:int,gap:int,len:int,own:int,kept:boolean>>"
    each = F.filter(F.array(*[F.coalesce(f.cast(kind), F.array().cast(kind)) for f in found]), lambda a: F.size(a) > 0)
    # a blob without matches keeps a row of nulls; all steps stay in the partition of the blob
    rows = blobs.select("blob", "todo", F.explode_outer(each).alias("m")).select("blob", "todo", F.posexplode_outer("m").alias("pos", "m")).select("blob", "todo", "pos", "m.*")
    w = Window.partitionBy("blob", "ord").orderBy("pos")
    rows = rows.withColumn("end", F.sum((F.col("gap") + F.col("len")).cast("long")).over(w))
    names, versions = (F.array(*[F.lit(x) for x in column]) for column in zip(*[(r.kind, r.version) for r in rules]))
    span = F.struct((F.col("end") - F.col("own")).alias("start"), "ord", F.get(names, F.col("ord")).alias("kind"), "end", F.get(versions, F.col("ord")).alias("version"))
    spans = F.array_sort(F.collect_list(F.when(F.col("kept"), span)))
    return rows.groupBy("blob").agg(F.first("todo").alias("scanned"), spans.cast(SPANS).alias("spans"))


class Ledger:
    """A table in a folder that driver and executors share: for each scan a row per blob, the rule versions it was scanned with, and what they found.

    A scan appends its rows in one write; one that fails leaves none, and is done again by the next.
    """

    SCHEMA = f"blob string, scanned {KINDS}, spans {SPANS}"

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        empty = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split(" ", 1) for c in self.SCHEMA.split(", "))])
        empty.write.mode("append").parquet(folder)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.folder)

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content") -> None:
        """Scan the blobs of ``versions`` with the rule versions that they haven't been scanned with."""
        findings(unseen(addressed(versions, path, content), self.rows().select("blob", "scanned"), rules), rules).write.mode("append").parquet(self.folder)

    def joined_back(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content") -> DataFrame:
        """(path, blob, spans) for each version: the findings of its blob by these rule versions, sorted, empty if none."""
        now = F.filter(F.flatten(F.collect_list("spans")), lambda s: F.array_contains(_pairs(rules), F.struct(s["kind"].alias("kind"), s["version"].alias("version"))))
        found = self.rows().where(F.size("spans") > 0).groupBy("blob").agg(F.array_sort(now).alias("spans"))
        # written, so that the join is between plain exchanges, of which a frequent blob's part can be split
        return addressed(versions, path, content).select("path", "blob").join(written(found), "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))
