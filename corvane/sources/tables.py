"""Scans and sinks: tab-separated records, truth, id lists, Parquet parts, and a view of pages as records."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = ("entity_id", "business_name", "business_address", "country")
TRUTH = ("source1_entity_id", "matched_entity_ids")


def guarded(path: str | os.PathLike) -> str:
    """Training code must not read a folder named ``test``."""
    if "test" in Path(str(path)).parts:
        raise ValueError(f"training may not read {path}")
    return str(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where all run on one machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="corvane-")
    return found.rstrip("/")


def stored(rows: DataFrame) -> DataFrame:
    """Cut the lineage of what is read more than once: write the rows in the shared folder and read them back."""
    folder = f"{shared_folder(rows.sparkSession)}/corvane-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = RECORD, line_breaks: bool = False, header: tuple[str, ...] | None = None) -> DataFrame:
    """The named columns of a tab-separated file with a header, as strings; empty cells are empty strings.

    Files are split among tasks unless quoted cells may hold ``line_breaks``.  With the ``header`` given, no job reads it.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
    names = header or reader.option("inferSchema", False).csv(path).columns
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"{path} lacks the columns {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return reader.schema(schema).option("enforceSchema", True).csv(path).select(*columns).na.fill("")


def read_source(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """Records with ``target_source``: the given tag, or the id's part before the first dash."""
    rows = read_tsv(spark, path)
    return rows.withColumn("target_source", F.lit(source) if source else F.substring_index("entity_id", "-", 1))


def source_of_file(path: Column) -> Column:
    """The tag S1, S2 or S3 from a name that holds source1, source2 or source3."""
    return F.concat(F.lit("S"), F.regexp_extract(path, r"source(\d)[^/]*$", 1))


def id_list(x: Column) -> Column:
    return F.filter(F.split(F.coalesce(x, F.lit("")), ","), lambda t: t != "")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    return with_lists(read_tsv(spark, path, TRUTH))


def with_lists(truth: DataFrame) -> DataFrame:
    return truth.withColumn("matched_list", id_list(F.col("matched_entity_ids"))).withColumn("n_matches", F.size("matched_list").cast("long"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode(id_list(F.col("matched_entity_ids"))).alias("candidate_entity_id")).distinct()


def suffix_number(id: Column) -> Column:
    """The number after an id's first dash, -1 if it is none."""
    return F.coalesce(F.regexp_extract(id, r"^[^-]*-(\d+)$", 1).try_cast("bigint"), F.lit(-1))


def suffix_modulo(id: Column, m: int) -> Column:
    return F.pmod(suffix_number(id), F.lit(m)) == 0


def target_pool(targets: DataFrame, positives: DataFrame, m: int) -> DataFrame:
    """Targets that are positives or fall in the modulo sample, first of each id by source; positives is one column entity_id."""
    marked = targets.join(positives.select("entity_id").distinct().withColumn("_hit", F.lit(True)), "entity_id", "left")
    kept = marked.where(F.col("_hit").isNotNull() | suffix_modulo(F.col("entity_id"), m)).drop("_hit")
    return first_of_each(kept)


def first_of_each(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("entity_id").orderBy("target_source", *[c for c in RECORD[1:] if c in rows.columns])
    return rows.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")


def missing_positives(pool: DataFrame, positives: DataFrame) -> DataFrame:
    return positives.select("entity_id").distinct().join(pool, "entity_id", "left_anti")


def of_countries(records: DataFrame, countries: DataFrame) -> DataFrame:
    """Records whose normalised country is among those of another table."""
    return records.join(countries.select("country_norm").distinct(), "country_norm", "left_semi")


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def first_column_ids(lines: DataFrame) -> DataFrame:
    """Distinct ids in the first column of text lines (value), without the header line and blanks."""
    ids = F.trim(F.split("value", "\t")[0])
    return lines.select(ids.alias("entity_id")).where("entity_id <> '' and entity_id not in ('entity_id', 'source1_entity_id')").distinct()


def with_multiplicity(lists: DataFrame) -> DataFrame:
    """(source1_entity_id, n_rows, ids): how many rows an id has, and all ids listed for it."""
    return lists.groupBy("source1_entity_id").agg(F.count("*").alias("n_rows"), F.array_sort(F.flatten(F.collect_list(id_list(F.col("matched_entity_ids"))))).alias("ids"))


def page_entities(pages: DataFrame) -> DataFrame:
    """Pages as records of three sources: the title is the name, the address the address, the language of its path the country."""
    n = F.col("page_id") % 3 + 1
    return pages.select(
        F.concat(F.lit("S"), n.cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("entity_id"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("business_name"),
        F.col("url").alias("business_address"),
        F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})", 1).alias("country"),
        F.concat(F.lit("S"), n.cast("string")).alias("target_source"),
    )


# Sinks


def lists_by_rank(pairs: DataFrame, s1: DataFrame, rank: str, name: str = "matched_entity_ids") -> DataFrame:
    """One row per S1 record with its ids in the order of ``rank``, each once; empty where it has none."""
    first = pairs.groupBy("source1_entity_id", "candidate_entity_id").agg(F.min(rank).alias("r"))
    listed = first.groupBy("source1_entity_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "candidate_entity_id"))), lambda x: x["candidate_entity_id"]), ",").alias(name))
    return _all_of(s1, listed, name)


def lists_sorted(pairs: DataFrame, s1: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    listed = pairs.groupBy("source1_entity_id").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.trim("candidate_entity_id")))).alias(name))
    return _all_of(s1, listed, name)


def _all_of(s1: DataFrame, listed: DataFrame, name: str) -> DataFrame:
    ids = s1.select(F.trim("entity_id").alias("source1_entity_id")).distinct()
    return ids.join(listed, "source1_entity_id", "left").select("source1_entity_id", F.coalesce(name, F.lit("")).alias(name))


def empty_lists(s1: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    return s1.select(F.trim("entity_id").alias("source1_entity_id"), F.lit("").alias(name))


def write_lists(lists: DataFrame, path: str) -> None:
    """Tab-separated with a header; an empty list leaves nothing after the tab. Written anew as a whole, so a rerun repeats nothing."""
    lists.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "\u0000").csv(path)


def write_parts(rows: DataFrame, folder: str) -> None:
    """Parquet by country; a rerun overwrites only the countries it holds."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country_norm").parquet(folder)


def write_json(spark: SparkSession, values: dict, folder: str) -> None:
    """One line of JSON, in a folder that Spark reaches."""
    spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(folder)


def read_rule(text: str) -> dict:
    """A decision rule from JSON: the short form (threshold, cap) is a global rule without exclusivity."""
    rule = json.loads(text)
    mode = rule.get("mode", "global")
    if mode not in ("global", "source_specific"):
        raise ValueError(f"unknown mode {mode}")
    s2, s3 = (rule["threshold"],) * 2 if mode == "global" else (rule["threshold_s2"], rule["threshold_s3"])
    return {"mode": mode, "threshold_s2": float(s2), "threshold_s3": float(s3), "cap": rule.get("cap"), "bipartite": bool(rule.get("bipartite", False))}
