"""A corpus pipeline of the operators in ``corvane.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bpe, exact, mixing, near, quality
from corvane.llm.common import table, written
from corvane.llm.queries import PREDICTED_FROM, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as label 0 go."""
    docs = docs.select(*COLUMNS)
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, score="_score").where(F.col("_score") >= PREDICTED_FROM).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the owner stays."""
    return exact.drop_copies(docs.select(*COLUMNS))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the smallest doc_id stays."""
    return near.drop_near_copies(docs.select(*COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as its source's budget takes it, whole documents only."""
    rows = mixing.mix(docs.select(*COLUMNS).withColumn("_words", mixing.n_words(F.col("text"))), F.col("_words"), whole=True)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return rows.where(times > 0).withColumn("_k", F.explode(F.sequence(F.lit(1), times))).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_sha256, decoded_sha256) for each row of the mix."""
    path, pattern = vocabulary()
    rows = bpe.encode(docs.select("doc_id", "source", "text"), path, pattern).drop("text")
    rows = bpe.decode(rows, path, pattern)
    return rows.select("doc_id", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

#: The quality classifier's training and the byte-level merges can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each but the last is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
