"""Metrics and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_non_latin

PAIR = ["source1_entity_id", "candidate_entity_id"]


def fbeta(tp: Column, n_pred: Column, n_truth: Column, beta: float = 0.5) -> Column:
    """Without truth: 1 if nothing is predicted, else 0; without a hit: 0."""
    b = beta * beta
    p, r = tp / n_pred, tp / n_truth
    return F.when(n_truth == 0, F.when(n_pred == 0, F.lit(1.0)).otherwise(F.lit(0.0))).when((n_pred == 0) | (tp == 0), F.lit(0.0)).otherwise((1 + b) * p * r / (b * p + r))


def per_entity(s1: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(source1_entity_id, n_pred, n_truth, tp) for all S1 ids; a missing one has none."""
    a = predicted.select(*PAIR).distinct().withColumn("p", F.lit(1))
    b = truth.select(*PAIR).distinct().withColumn("t", F.lit(1))
    counts = a.join(b, PAIR, "full").groupBy("source1_entity_id").agg(F.count("p").alias("n_pred"), F.count("t").alias("n_truth"), F.count(F.col("p") + F.col("t")).alias("tp"))
    return s1.select("source1_entity_id").distinct().join(counts, "source1_entity_id", "left").na.fill(0)


def macro_fbeta(s1: DataFrame, predicted: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    rows = per_entity(s1, predicted, truth)
    return rows.agg(F.coalesce(F.avg(fbeta(F.col("tp"), F.col("n_pred"), F.col("n_truth"), beta)), F.lit(0.0)).alias("score"), F.count("*").alias("n"))


def blocking_audit(s1: DataFrame, candidates: DataFrame, truth: DataFrame, beta: float = 0.5) -> DataFrame:
    """Pair recall, full-entity recall, candidates per record, and the score of the best choice among candidates."""
    rows = per_entity(s1, candidates, truth)
    has = F.col("n_truth") > 0
    return rows.agg(
        F.coalesce(F.try_divide(F.sum("tp"), F.sum("n_truth")), F.lit(0.0)).alias("pair_recall"),
        F.coalesce(F.try_divide(F.count_if(has & (F.col("tp") == F.col("n_truth"))), F.count_if(has)), F.lit(0.0)).alias("full_entity_recall"),
        F.coalesce(F.avg("n_pred"), F.lit(0.0)).alias("avg_candidates"),
        F.coalesce(F.avg(fbeta(F.col("tp"), F.col("tp"), F.col("n_truth"), beta)), F.lit(0.0)).alias("oracle_score"),
    )


def miss_breakdown(s1: DataFrame, candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """How many records with truth have no candidates, none that is true, some, or all."""
    rows = per_entity(s1, candidates, truth).where("n_truth > 0")
    none, hit = F.col("n_pred") == 0, F.col("tp")
    return rows.agg(
        F.count_if(none).alias("zero_candidates"),
        F.count_if(~none & (hit == 0)).alias("zero_overlap"),
        F.count_if((hit > 0) & (hit < F.col("n_truth"))).alias("partial"),
        F.count_if(hit == F.col("n_truth")).alias("full"),
    )


def country_statistics(s1: DataFrame, predicted: DataFrame) -> DataFrame:
    """Rows, share with a match, mean list size by country; the last row, with a null country, is the total."""
    n = predicted.select(*PAIR).distinct().groupBy("source1_entity_id").agg(F.count("*").alias("n"))
    rows = s1.select(F.col("entity_id").alias("source1_entity_id"), "country_norm").join(n, "source1_entity_id", "left").na.fill(0, ["n"])
    return rows.rollup("country_norm").agg(F.count("*").alias("n_rows"), F.avg((F.col("n") > 0).cast("double")).alias("non_empty_rate"), F.avg("n").alias("avg_size"))


def raw_labels(records: DataFrame) -> DataFrame:
    return records.groupBy("country_norm").agg(F.array_join(F.array_sort(F.collect_set("country")), ",").alias("labels"))


def non_latin_audit(records: DataFrame) -> DataFrame:
    name, address = has_non_latin(F.col("business_name")), has_non_latin(F.col("business_address"))
    return records.groupBy("country").agg(F.count("*").alias("n_rows"), F.count_if(name).alias("n_name"), F.count_if(address).alias("n_address"), F.count_if(name | address).alias("n_either"))


def shared_targets(links: DataFrame) -> DataFrame:
    """Targets that are listed more than once, and how often."""
    return links.groupBy("candidate_entity_id").agg(F.count("*").alias("n_claims")).where("n_claims > 1")


def cross_country_links(truth: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    a = s1.select(F.col("entity_id").alias(PAIR[0]), F.col("country_norm").alias("a"))
    b = targets.select(F.col("entity_id").alias(PAIR[1]), F.col("country_norm").alias("b"))
    rows = truth.join(a, PAIR[0]).join(b, PAIR[1])
    return rows.groupBy(F.col("a").alias("country_norm")).agg(F.count("*").alias("n_links"), F.count_if(F.col("a") != F.col("b")).alias("n_cross"))


def class_balance(pairs: DataFrame) -> DataFrame:
    p, n = F.greatest(F.sum("label"), F.lit(1)), F.greatest(F.sum(1 - F.col("label")), F.lit(1))
    return pairs.agg((n / p).alias("scale_pos_weight"))
