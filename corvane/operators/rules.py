"""Rule matchers: exact keys with a unique owner, name and number, and weighted votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import address_overlaps, jaccard, rule_score
from ..functions.text import clean_address_tokens, clean_name_tokens, token_set, useful_numbers

PAIR = ["source1_entity_id", "candidate_entity_id"]


def _owned(rows: DataFrame, key: list[str], most: int) -> DataFrame:
    """Rows whose key has at most ``most`` owners; counted apart, so that a frequent key isn't gathered in one task."""
    few = rows.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") <= most).select(*key)
    return rows.join(few, key, "left_semi")


def _s1(s1: DataFrame) -> DataFrame:
    return s1.where("name_norm <> ''").withColumnRenamed("entity_id", "source1_entity_id")


def _targets(targets: DataFrame) -> DataFrame:
    return targets.where("name_norm <> ''").withColumnRenamed("entity_id", "candidate_entity_id")


EXACT = ["country_norm", "name_norm", "address_norm"]
NUMBER = ["country_norm", "name_norm", "number"]


def exact_matches(s1: DataFrame, targets: DataFrame) -> DataFrame:
    """Equal country, name and address (not empty), where one S1 record alone has them."""
    keys = _owned(_s1(s1).where("address_norm <> ''").select("source1_entity_id", *EXACT), EXACT, 1)
    return _targets(targets).select("candidate_entity_id", "target_source", *EXACT).join(keys, EXACT).select(*PAIR, "target_source")


def _numbers(rows: DataFrame, id: str, *more: str) -> DataFrame:
    return rows.select(id, "country_norm", "name_norm", *more, F.explode(useful_numbers(F.col("address_numbers"))).alias("number"))


def number_matches(s1: DataFrame, targets: DataFrame, most_owners: int = 3) -> DataFrame:
    """Equal country, name and a number of three digits or more with few owners, where addresses overlap."""
    keys = _owned(_numbers(_s1(s1), "source1_entity_id", "address_norm"), NUMBER, most_owners)
    pairs = _numbers(_targets(targets), "candidate_entity_id", "target_source", "address_norm").withColumnRenamed("address_norm", "_t").join(keys, NUMBER)
    return pairs.where(address_overlaps(token_set(F.col("address_norm")), token_set(F.col("_t")))).select(*PAIR, "target_source").distinct()


def first_come(links: DataFrame, most: int = 8, order: tuple[str, ...] = ("target_source", "candidate_entity_id")) -> DataFrame:
    """At most ``most`` distinct targets of each S1 record, in the order of the targets."""
    w = Window.partitionBy("source1_entity_id").orderBy(*order)
    return links.select(*PAIR, "target_source").distinct().withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= most).drop("_at")


def exact_rules(s1: DataFrame, targets: DataFrame, most: int = 8) -> DataFrame:
    return first_come(exact_matches(s1, targets).unionByName(number_matches(s1, targets)), most)


def votes(s1: DataFrame, targets: DataFrame, most_token_frequency: int = 2500, most_per_target: int = 25) -> DataFrame:
    """(pair, target_source, votes): 6 for an exact key with one owner, 4 for each name and number with up to four, 1 for each shared name token; the best S1 records of each target."""
    # the exact keys of S1 need a name and an address; numbers are those of records with a name
    a, b = _s1(s1), _targets(targets)
    exact = exact_matches(s1, targets).select(*PAIR, F.lit(6).alias("w"))
    owned = _owned(_numbers(a, "source1_entity_id"), NUMBER, 4)
    number = _numbers(b, "candidate_entity_id").join(owned, NUMBER).select(*PAIR, F.lit(4).alias("w"))
    tokens = lambda rows, id: rows.select(id, "country_norm", F.explode(clean_name_tokens(F.col("name_norm"))).alias("token"))
    known = tokens(s1.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id")
    common = ["country_norm", "token"]
    known = _owned(known, common, most_token_frequency)
    token = tokens(b, "candidate_entity_id").join(known, common).select(*PAIR, F.lit(1).alias("w"))
    summed = exact.unionByName(number).unionByName(token).groupBy(*PAIR).agg(F.sum("w").alias("votes"))
    w = Window.partitionBy("candidate_entity_id").orderBy(F.col("votes").desc(), "source1_entity_id")
    best = summed.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= most_per_target).drop("_at")
    return best.join(b.select("candidate_entity_id", "target_source"), "candidate_entity_id")


def vote_scores(s1: DataFrame, targets: DataFrame, voted: DataFrame) -> DataFrame:
    """Add the sets' similarities and the rule score."""
    sets = lambda rows, id, m: rows.select(F.col("entity_id").alias(id), clean_name_tokens(F.col("name_norm")).alias(f"n{m}"), clean_address_tokens(F.col("address_norm")).alias(f"a{m}"), useful_numbers(F.col("address_numbers")).alias(f"u{m}"))
    rows = voted.join(sets(s1, "source1_entity_id", "s"), "source1_entity_id").join(sets(targets, "candidate_entity_id", "c"), "candidate_entity_id")
    some = lambda a, b: F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(jaccard(a, b))
    rows = rows.withColumns({"name_score": some("ns", "nc"), "address_score": some("as", "ac"), "number_overlap": F.arrays_overlap("us", "uc")})
    return rows.withColumn("score", rule_score(F.col("name_score"), F.col("address_score"), F.col("number_overlap"))).drop("ns", "nc", "as", "ac", "us", "uc")


def accepted(threshold: float = 0.64) -> Column:
    """Nearly exact, or above the threshold with a strong name and evidence from the address."""
    exact = (F.col("score") >= 0.82) & (F.col("name_score") >= 0.70)
    name = (F.col("name_score") >= 0.55) & (F.col("votes") >= 2)
    evidence = (F.col("address_score") >= 0.16) | F.col("number_overlap")
    return exact | ((F.col("score") >= threshold) & name & evidence)


def fuzzy_rules(s1: DataFrame, targets: DataFrame, most: int = 8, threshold: float = 0.64, **limits) -> DataFrame:
    scored = vote_scores(s1, targets, votes(s1, targets, **limits))
    return first_come(scored.where(accepted(threshold)), most)
