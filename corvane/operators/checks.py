"""Checks of output lists: (source1_entity_id, matched_entity_ids) rows and their raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import id_list, stored

OFFENDERS = 5


def header_fault(spark: SparkSession, path: str, columns: tuple[str, str]) -> str | None:
    """Why a file can't be read at all: missing, empty, separated by commas, or another header."""
    try:
        first = spark.read.text(path).first()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return "missing"
        raise
    if first is None:
        return "empty"
    if "\t" not in first["value"] and "," in first["value"]:
        return "comma-separated"
    return None if tuple(first["value"].split("\t")) == columns else "wrong header"


def parsed(lines: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids, malformed) of text lines (value) without the header."""
    parts = F.split("value", "\t")
    return lines.select(F.trim(parts[0]).alias("source1_entity_id"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("matched_entity_ids"), (F.size(parts) < 2).alias("malformed"))


def offences(lists: DataFrame, required: DataFrame, known: DataFrame | None = None, prefixes: tuple[str, ...] = ("S2-", "S3-")) -> DataFrame:
    """(check, offender): every offence against the lists; ``required`` and ``known`` have a column entity_id."""
    ids = id_list(F.col("matched_entity_ids"))
    say = lambda rows, check, column="source1_entity_id": rows.select(F.lit(check).alias("check"), F.col(column).alias("offender"))
    if "malformed" in lists.columns:
        bad = lists.where("malformed")
        lists = lists.where("not malformed")
    else:
        bad = lists.where(F.lit(False))
    each = lists.select("source1_entity_id", F.explode(ids).alias("id"))
    own = F.col("id").startswith("S1-")
    good = F.lit(False)
    for p in prefixes:
        good = good | F.col("id").startswith(p)
    seen = lists.select("source1_entity_id").distinct()
    need = required.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    found = [
        say(bad, "malformed_row"),
        say(lists.groupBy("source1_entity_id").agg(F.count("*").alias("n")).where("n > 1"), "duplicate_s1"),
        say(lists.where(F.size(ids) != F.size(F.array_distinct(ids))), "duplicate_id_in_list").distinct(),
        say(each.where(own), "self_match", "id").distinct(),
        say(each.where(~own & ~good), "bad_prefix", "id").distinct(),
        say(need.join(seen, "source1_entity_id", "left_anti"), "missing_s1"),
        say(seen.join(need, "source1_entity_id", "left_anti"), "unexpected_s1"),
    ]
    if known is not None:
        found.append(say(each.where(good).select("id").distinct().join(known.select(F.col("entity_id").alias("id")), "id", "left_anti"), "unknown_target", "id"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def not_among_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """(source1_entity_id, id): matched ids that the record's candidate list lacks."""
    pairs = lambda rows, c: rows.select("source1_entity_id", F.explode(id_list(F.col(c))).alias("id")).distinct()
    return pairs(matched, "matched_entity_ids").join(pairs(candidates, "candidate_entity_ids"), ["source1_entity_id", "id"], "left_anti")


def report(found: DataFrame) -> DataFrame:
    """(check, n, sample): how many offenders, and the first five in order; only the first five are ever gathered."""
    found = stored(found.distinct())
    first = Window.partitionBy("check").orderBy("offender")
    some = found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= OFFENDERS)
    some = some.groupBy("check").agg(F.array_join(F.array_sort(F.collect_list("offender")), ",").alias("sample"))
    return found.groupBy("check").agg(F.count("offender").alias("n")).join(some, "check")


def country_gate(lists: DataFrame, s1: DataFrame, country: str, candidates: DataFrame | None = None) -> DataFrame:
    """The report of one country's lists (rows of other countries' records are left out); a match that is no candidate counts as an offence here."""
    own = s1.where(F.col("country_norm") == country)
    ids = own.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    lists = lists.join(ids, "source1_entity_id", "left_semi")
    found = offences(lists, own)
    if candidates is not None:
        candidates = candidates.join(ids, "source1_entity_id", "left_semi")
        listed = offences(candidates.select("source1_entity_id", F.col("candidate_entity_ids").alias("matched_entity_ids")), own).where(F.col("check").isin("missing_s1", "duplicate_s1"))
        found = found.unionByName(listed.withColumn("check", F.concat(F.lit("candidates_"), "check")))
        found = found.unionByName(not_among_candidates(lists, candidates).select(F.lit("not_a_candidate").alias("check"), F.col("source1_entity_id").alias("offender")))
    return report(found)
