"""Features of candidate pairs, by name, with their keys kept beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.text import pipe_set, token_set

PAIR = ["source1_entity_id", "candidate_entity_id"]
SIDE = ("name_norm", "address_norm", "combined_norm", "legal_form", "address_numbers", "landmark_tokens", "country_norm")
#: In the order that models are trained with.
FEATURES = (
    "candidate_rank", "candidate_strength", "name_tfidf_score", "address_tfidf_score", "combined_tfidf_score", "token_score",
    "keyed_score", "keyed_rank", "name_jaccard", "address_jaccard", "combined_jaccard", "name_sequence_ratio",
    "address_sequence_ratio", "shared_name_tokens", "shared_address_tokens", "shared_numbers", "has_number_overlap",
    "number_conflict", "legal_form_overlap", "legal_form_conflict", "landmark_overlap", "same_country", "candidate_is_s2",
    "candidate_is_s3", "name_length_diff", "address_length_diff", "s1_name_token_count", "candidate_name_token_count",
    "s1_address_token_count", "candidate_address_token_count", "name_exact_match", "address_exact_match", "name_levenshtein",
    "address_levenshtein", "name_jaro_winkler", "address_jaro_winkler", "name_token_sort_ratio", "name_token_set_ratio",
    "address_token_sort_ratio", "address_token_set_ratio", "name_overlap_coefficient", "address_overlap_coefficient",
    "name_length_ratio", "name_prefix4_match", "name_char3gram_jaccard", "name_first_token_match", "name_first_token_conflict",
    "address_presence", "name_addr_sim_product", "name_addr_sim_sum", "name_addr_sim_max", "name_addr_sim_min",
    "exact_name_missing_addr",
)
#: Those that need an Arrow function; the others stay in the JVM.
ARROW = (
    "name_sequence_ratio", "address_sequence_ratio", "name_jaro_winkler", "address_jaro_winkler", "name_token_sort_ratio",
    "name_token_set_ratio", "address_token_sort_ratio", "address_token_set_ratio", "name_first_token_match",
    "name_first_token_conflict", "name_addr_sim_product", "name_addr_sim_sum", "name_addr_sim_max", "name_addr_sim_min",
)


def repeated_ids(records: DataFrame) -> DataFrame:
    """Ids that a side of the enrichment join must not have twice."""
    return records.groupBy("entity_id").agg(F.count("*").alias("n")).where("n > 1").select("entity_id")


#: Sets that features compare, by the text that they are made of.
SETS = {
    "nt": (token_set, "name_norm"), "at": (token_set, "address_norm"), "ct": (token_set, "combined_norm"), "num": (pipe_set, "address_numbers"),
    "leg": (pipe_set, "legal_form"), "land": (pipe_set, "landmark_tokens"), "n3": (S.char_ngrams, "name_norm"),
}


def enriched(candidates: DataFrame, s1: DataFrame, targets: DataFrame, sets: dict = {}) -> DataFrame:
    """Left joins of both sides' texts, and of ``sets`` of them, made for each record; ``s_`` and ``c_`` name the sides."""

    def side(rows, id, mark, *more):
        made = [f(F.coalesce(F.col(c), F.lit(""))).alias(f"{mark}_{k}") for k, (f, c) in sets.items()]
        rows = rows.select(F.col("entity_id").alias(id), *more, *[F.col(c).alias(f"{mark}_{c}") for c in SIDE], *made)
        # pairs with sets aren't sorted
        return rows.hint("shuffle_hash") if sets else rows

    rows = candidates.join(side(s1, PAIR[0], "s"), PAIR[0], "left").join(side(targets, PAIR[1], "c", "target_source"), PAIR[1], "left")
    rows = rows.na.fill("", subset=[f"{m}_{c}" for m in "sc" for c in SIDE])
    return rows.withColumns({f"{m}_{k}": F.coalesce(f"{m}_{k}", F.array().cast("array<string>")) for m in "sc" for k in sets}) if sets else rows


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def pair_features(candidates: DataFrame, s1: DataFrame, targets: DataFrame, arrow: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """(pair, ``keep`` of the candidates' columns, ``f_`` and each feature's name); without ``arrow`` those of ``ARROW`` are left out."""
    rows = enriched(candidates, s1, targets, SETS)
    have = set(candidates.columns)
    given = lambda c, default: F.coalesce(F.col(c).cast("double"), F.lit(default)) if c in have else F.lit(default)
    s, c = (lambda x: F.col(f"s_{x}")), (lambda x: F.col(f"c_{x}"))
    both = lambda x: (F.size(s(x)) > 0) & (F.size(c(x)) > 0)
    meet = lambda x: both(x) & F.arrays_overlap(s(x), c(x))
    apart = lambda x: both(x) & ~F.arrays_overlap(s(x), c(x))
    equal = lambda x: (s(x) == c(x)) & (s(x) != "")
    size = lambda x: F.size(x).cast("double")
    length = lambda x: F.length(x).cast("double")
    n, a = "name_norm", "address_norm"
    first = lambda x: F.substring_index(x, " ", 1)
    strings = {
        "_ns": S.token_sort_ratio(s(n), c(n)), "_as": S.token_sort_ratio(s(a), c(a)), "_ft": S.indel_ratio(first(s(n)), first(c(n))),
        "_nq": S.sequence_matcher_ratio(s(n), c(n)), "_aq": S.sequence_matcher_ratio(s(a), c(a)),
        "_nj": S.jaro_winkler_similarity(s(n), c(n)), "_aj": S.jaro_winkler_similarity(s(a), c(a)),
        "_nu": S.token_set_ratio(s(n), c(n)), "_au": S.token_set_ratio(s(a), c(a)),
    }
    # one Arrow call for all; what sets share is counted once
    rows = rows.withColumns({f"_{k}": S.shared(s(k), c(k)) for k in ("nt", "at", "ct", "num", "n3")} | (strings if arrow else {}))
    jaccard = lambda k: S.ratio(F.col(f"_{k}"), F.size(s(k)) + F.size(c(k)) - F.col(f"_{k}"))
    overlap = lambda k: S.ratio(F.col(f"_{k}"), F.least(F.size(s(k)), F.size(c(k))))
    f = {
        "candidate_rank": given("candidate_rank", 9999.0),
        "candidate_strength": given("candidate_strength", 0.0),
        **{k: given(k, 0.0) for k in ("name_tfidf_score", "address_tfidf_score", "combined_tfidf_score", "token_score", "keyed_score")},
        "keyed_rank": given("keyed_rank", 9999.0),
        "name_jaccard": jaccard("nt"),
        "address_jaccard": jaccard("at"),
        "combined_jaccard": jaccard("ct"),
        "shared_name_tokens": F.col("_nt").cast("double"),
        "shared_address_tokens": F.col("_at").cast("double"),
        "shared_numbers": F.col("_num").cast("double"),
        "has_number_overlap": _flag(F.col("_num") > 0),
        "number_conflict": _flag(both("num") & (F.col("_num") == 0)),
        "legal_form_overlap": _flag(meet("leg")),
        "legal_form_conflict": _flag(apart("leg")),
        "landmark_overlap": _flag(meet("land")),
        "same_country": _flag(s("country_norm") == c("country_norm")),
        "candidate_is_s2": _flag(F.col("target_source") == "S2"),
        "candidate_is_s3": _flag(F.col("target_source") == "S3"),
        "name_length_diff": F.abs(length(s(n)) - length(c(n))),
        "address_length_diff": F.abs(length(s(a)) - length(c(a))),
        "s1_name_token_count": size(s("nt")),
        "candidate_name_token_count": size(c("nt")),
        "s1_address_token_count": size(s("at")),
        "candidate_address_token_count": size(c("at")),
        "name_exact_match": _flag(equal(n)),
        "address_exact_match": _flag(equal(a)),
        "name_levenshtein": S.levenshtein_similarity(s(n), c(n)),
        "address_levenshtein": S.levenshtein_similarity(s(a), c(a)),
        "name_overlap_coefficient": overlap("nt"),
        "address_overlap_coefficient": overlap("at"),
        "name_length_ratio": S.ratio(F.least(length(s(n)), length(c(n))), F.greatest(length(s(n)), length(c(n)))),
        "name_prefix4_match": _flag((F.length(s(n)) >= 4) & (F.length(c(n)) >= 4) & (F.substring(s(n), 1, 4) == F.substring(c(n), 1, 4))),
        "name_char3gram_jaccard": jaccard("n3"),
        "address_presence": _flag(c(a) != ""),
        "exact_name_missing_addr": _flag(equal(n) & (c(a) == "")),
    }
    if arrow:
        present = (s(n) != "") & (c(n) != "")
        f |= {
            "name_sequence_ratio": F.col("_nq"),
            "address_sequence_ratio": F.col("_aq"),
            "name_jaro_winkler": F.col("_nj"),
            "address_jaro_winkler": F.col("_aj"),
            "name_token_sort_ratio": F.col("_ns"),
            "name_token_set_ratio": F.col("_nu"),
            "address_token_sort_ratio": F.col("_as"),
            "address_token_set_ratio": F.col("_au"),
            "name_first_token_match": _flag(present & (F.col("_ft") >= 0.80)),
            "name_first_token_conflict": _flag(present & (F.col("_ft") < 0.50)),
            "name_addr_sim_product": F.col("_ns") * F.col("_as"),
            "name_addr_sim_sum": F.col("_ns") + F.col("_as"),
            "name_addr_sim_max": F.greatest("_ns", "_as"),
            "name_addr_sim_min": F.least("_ns", "_as"),
        }
    finite = lambda x: F.when(F.isnan(x) | x.isNull() | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)
    # what is made of filled texts and sets is finite; an expression within ``finite`` is worked on four times
    given_or_arrow = {k for k in FEATURES[:8] if k in have} | {*ARROW}
    return rows.select(*PAIR, *keep, *[(finite(f[k]) if k in given_or_arrow else f[k]).alias(f"f_{k}") for k in FEATURES if k in f])


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``label``: 1 if the pair is a true one."""
    hits = truth.select(*PAIR).distinct().withColumn("_hit", F.lit(1))
    return pairs.join(hits, PAIR, "left").withColumn("label", F.coalesce("_hit", F.lit(0))).drop("_hit")
