"""The three runs: train, link, validate. Each is one lazy plan up to its sinks; all countries run together."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalized
from ..operators import blocking, checks, decision, features, metrics, model, sampling
from ..operators.keys import KeyConfig
from ..sources import tables


@dataclass(frozen=True)
class LinkConfig:
    """One set of knobs for training and linking, so that the two can't differ."""

    keys: KeyConfig = field(default_factory=KeyConfig)
    blocking: blocking.BlockingConfig = field(default_factory=blocking.BlockingConfig)
    per_positive: float = 6.0
    seed: int = 42
    any_script: bool = True
    model: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Trained:
    model: model.MatchModel
    rule: dict
    scores: dict


def pair_rows(s1: DataFrame, targets: DataFrame, config: LinkConfig) -> tuple[DataFrame, DataFrame]:
    """(candidates, features with the candidate rank) of normalised records."""
    candidates = tables.stored(blocking.keyed_candidates(s1, targets, config.blocking, config.keys))
    rows = features.pair_features(candidates, s1, targets)
    return candidates, rows.join(candidates.select(*features.PAIR, "candidate_rank"), features.PAIR)


def train(s1: DataFrame, targets: DataFrame, truth: DataFrame, config: LinkConfig = LinkConfig(), sample: int | None = None) -> Trained:
    """Block once, split the S1 records, fit, choose a rule on tune, and score holdout once."""
    truth_rows = tables.with_lists(truth)
    ids = truth_rows.select("source1_entity_id", (F.col("n_matches") > 0).alias("matched")) if sample is None else sampling.stratified_sample(truth_rows, sample, config.seed)
    split = tables.stored(sampling.three_way_split(ids, seed=config.seed).select("source1_entity_id", "split"))
    pairs = tables.truth_pairs(truth)
    records = tables.stored(normalized(s1, config.any_script).join(split.select(F.col("source1_entity_id").alias("entity_id")), "entity_id", "left_semi"))
    pool = tables.stored(normalized(targets, config.any_script))
    candidates, rows = pair_rows(records, pool, config)
    rows = tables.stored(features.labelled(rows, pairs).join(split, "source1_entity_id"))
    fitted = model.train(rows.where("split = 'fit'"), config.per_positive, config.seed, **config.model)
    part = lambda name: (decision.scored_pairs(fitted.predict(rows.where(F.col("split") == name)).select(*features.PAIR, "candidate_rank", "probability")), pairs.join(split.where(F.col("split") == name), "source1_entity_id", "left_semi"), split.where(F.col("split") == name).select("source1_entity_id"))
    tune, tune_truth, tune_ids = part("tune")
    rule = decision.choose(tables.stored(tune), tune_truth, tune_ids)
    hold, hold_truth, hold_ids = part("holdout")
    kept = decision.decide(hold, rule)
    found = metrics.macro_fbeta(hold_ids, kept, hold_truth).first()
    audit = metrics.blocking_audit(hold_ids, hold, hold_truth).first()
    return Trained(fitted, rule, {"tune": rule["score"], "holdout": found["score"], "n_holdout": found["n"], **audit.asDict()})


def link(s1: DataFrame, targets: DataFrame, trained: model.MatchModel, rule: dict, config: LinkConfig = LinkConfig()) -> tuple[DataFrame, DataFrame]:
    """(matches, candidates) as id lists with a row for every S1 record. Exclusivity holds over all records, not by batch."""
    a, b = tables.stored(normalized(s1, config.any_script)), tables.stored(normalized(targets, config.any_script))
    candidates, rows = pair_rows(a, b, config)
    scored = decision.scored_pairs(trained.predict(rows).select(*features.PAIR, "candidate_rank", "probability"))
    kept = decision.decide(scored, rule)
    return tables.lists_by_rank(kept, s1, "prob_rank"), tables.lists_by_rank(candidates, s1, "candidate_rank", "candidate_entity_ids")


def validate(matches: DataFrame, candidates: DataFrame, s1: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """The report of both files; a match that is no candidate is a warning."""
    # each check reads the lists
    matches, candidates = tables.stored(matches), tables.stored(candidates)
    found = checks.offences(matches, s1, targets)
    listed = checks.offences(candidates.withColumnRenamed("candidate_entity_ids", "matched_entity_ids"), s1, targets)
    warned = checks.not_among_candidates(matches, candidates).select(F.lit("warning_not_a_candidate").alias("check"), F.col("id").alias("offender"))
    return checks.report(found.unionByName(listed.withColumn("check", F.concat(F.lit("candidates_"), "check"))).unionByName(warned))
