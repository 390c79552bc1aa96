"""Mixing sources to target weights, in DataFrame functions only.

Each row gets a hash-random key.  Rows are sorted by key within their source, in
ranges of the key; prefix sums of the sizes are taken within each range, and the sums
of the ranges before are added, first over ranges of a stripe, then over stripes.  A
source's mix is its rows in this order, once for each whole epoch in its budget, and
then up to the exact budget; the row at the cut gives a part of its tokens.

Targets: a share of all tokens is dealt to the sources by weight; no source takes more
than ``most`` times its size, and what it can't take goes to the others by weight, until
none is above.  This is min(most x size, level x weight) for one common level, found
by sorting the sources by size / weight.

Defined cases: a null text has no tokens, a null source is a source of its own (last in
order).  Ties of the key are broken by the id, then by size; rows equal in all three are
interchangeable.  Reruns agree: keys depend on a seed and the id, or where that is null the
rest of the row.  An empty table
gives an empty table; input columns named like outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, field, unpacked, whole_row, written

#: Ranges of a source: two levels, STRIPES times a power of two that follows its rows.
STRIPES = 512
ROWS_PER_RANGE = 20_000
OUT = ("size", "source_size", "target", "taken")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, n_rows, target) from (source, source_size, n_rows): one row per source, a table that is small beside the rows.

    The k-th source by code point, null last, weighs ``weights[k % len(weights)]``.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    at = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(at, F.lit(len(weights))) + 1)
    s = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    # sources reach their most in order of most / weight; the level is that at which the rest takes what is left
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0))).withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - F.col("full")) / F.col("open"))
    # the level of the first source that stays open; where none does, all take their most
    s = s.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") < F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("level")))).over(everything)["level"])
    return s.select("source", "source_size", "n_rows", F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most")).alias("target"))


def mix(df: DataFrame, size: Column, id: str = "doc_id", source: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, whole: bool = False, without_id: Column | None = None) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` (its source's) and ``taken`` (tokens the mix takes of the row, repeats counted).

    With ``whole``, a row at the cut is taken whole if at least half of it is inside, else not, so that
    ``taken`` is a multiple of ``size``.  ``without_id`` stands for a null id in the key (by default the hash of
    all columns), so that rows without an id spread over the ranges.
    """
    without_id = F.xxhash64(*df.columns) if without_id is None else without_id
    # 40 bits of a digest of seed and id
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), without_id.cast("string"), F.lit("")))
    key = F.conv(F.substring(F.md5(named), 1, 10), 16, 10).cast("long")
    rows = df.select(whole_row(df), F.col(source).alias("s"), size.cast("long").alias("size"), key.alias("key"))
    # what all sums are made of: a few numbers a row, so that texts are read once for them
    narrow = written(rows.select("s", "size", "key"))
    sizes = narrow.groupBy(F.col("s").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    plan = targets(sizes, weights, share, most)
    level = F.greatest(F.lit(0.0), F.ceil(F.log2(F.col("n_rows") / F.lit(STRIPES * ROWS_PER_RANGE))))
    plan = written(plan.select(F.col("source").alias("p"), "source_size", "target", F.pow(F.lit(2.0), level).cast("long").alias("fine")))
    width = F.lit((1 << 40) // STRIPES)

    def placed(x: DataFrame) -> DataFrame:
        x = x.join(plan, F.col("s").eqNullSafe(F.col("p")))
        return x.withColumn("stripe", F.floor(F.col("key") / width)).withColumn("range", F.floor(F.pmod("key", width) * F.col("fine") / width))

    sums = placed(narrow).groupBy("s", "stripe", "range").agg(F.sum("size").alias("n"))
    stripes = sums.groupBy("s", "stripe").agg(F.sum("n").alias("n"))
    earlier = lambda *k: Window.partitionBy(*k[:-1]).orderBy(k[-1]).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda w: F.coalesce(F.sum("n").over(w), F.lit(0))
    stripes = stripes.select(F.col("s").alias("s1"), F.col("stripe").alias("t1"), before(earlier("s", "stripe")).alias("a"))
    ranges = sums.withColumn("b", before(earlier("s", "stripe", "range"))).join(stripes, F.col("s").eqNullSafe(F.col("s1")) & (F.col("stripe") == F.col("t1")))
    ranges = ranges.select(F.col("s").alias("s2"), F.col("stripe").alias("t2"), F.col("range").alias("r2"), (F.col("a") + F.col("b")).alias("offset"))
    inside = Window.partitionBy("s", "stripe", "range").orderBy("key", field(id), "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed(rows).withColumn("here", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(ranges, F.col("s").eqNullSafe(F.col("s2")) & (F.col("stripe") == F.col("t2")) & (F.col("range") == F.col("r2")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - (F.col("offset") + F.col("here"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest))
    if whole:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    return unpacked(rows.withColumn("taken", (epochs * F.col("size") + part).cast("long")), *OUT)
