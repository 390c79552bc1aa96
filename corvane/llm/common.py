"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word and line rules here: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch on its way to Python and back, where the session has the default (64 MB).
BATCH_BYTES = 8 << 20
_DEFAULT_BATCH_BYTES = 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches, which a task holds several times, in both processes; a setting of the session's own stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).rstrip("b") == str(_DEFAULT_BATCH_BYTES):
        spark.conf.set(name, str(BATCH_BYTES))


def released() -> None:
    """Give back memory that Arrow and the allocator hold for later: processes go on with other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where it is unset and all run on one machine."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="corvane-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, "corvane")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict]:
    """``written``, and aggregates over the rows as they were written."""
    out = written(df)
    return out, out.agg(*[c.alias(name) for name, c in sums.items()]).first().asDict()


def text_of(column: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that no name put beside it clashes with one of theirs."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row")


def field(column: str) -> Column:
    """A column of a ``whole_row``."""
    return F.col("row").getField(column)


def unpacked(rows: DataFrame, *more: str) -> DataFrame:
    """The columns of each ``whole_row``, without those whose place ``more`` takes, and ``more``."""
    names = [f.name for f in rows.schema["row"].dataType.fields if f.name not in more]
    return rows.select(*[field(c).alias(c) for c in names], *more)


def bounded_rows(df: DataFrame, keys: DataFrame, key: str, bound: int, seed: int = 0) -> DataFrame:
    """The rows of ``df`` for at most ``bound`` of ``keys``, chosen by a hash of the key.

    ``keys`` is narrow.  The chosen keys are at most ``bound`` rows, so that they can
    be broadcast, and the wide rows of ``df`` are not shuffled.
    """
    chosen = keys.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(bound)
    return df.join(F.broadcast(chosen), key)
