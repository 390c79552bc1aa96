"""Blocking keys: one record, many keys, and the postings they build."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import alnum, core_tokens, pipe_list, soundex


@dataclass(frozen=True)
class KeyConfig:
    prefix: int = 5
    least_token: int = 3
    least_core: int = 4
    #: Single tokens that more targets have than this make no key.
    most_frequent: int = 250
    #: Keys with more postings than this are left out.
    most_postings: int = 5000


_KEY = "array<struct<kind:string,value:string,gate:string>>"


def _key(kind: str, value: Column, gate: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), (gate if gate is not None else F.lit(None)).cast("string").alias("gate"))


def _some(condition: Column, keys: Column) -> Column:
    return F.when(condition, keys.cast(_KEY)).otherwise(F.array().cast(_KEY))


def proposed(config: KeyConfig = KeyConfig(), sound=soundex) -> Column:
    """All keys of a record in order; ``gate`` is the token whose frequency decides on the key, if one does.

    Reads ``_name`` and ``_address`` (tokens), ``_numbers``, ``_compact`` from the row.
    """
    name, address, numbers, compact = (F.col(c) for c in ("_name", "_address", "_numbers", "_compact"))
    prefix = F.substring(compact, 1, config.prefix)
    first, city = F.get(name, F.lit(0)), F.get(address, F.size(address) - 1)
    core = lambda tokens: F.filter(tokens, lambda t: F.length(t) >= config.least_core)
    has_name, has_address = F.size(name) > 0, F.size(address) > 0
    joined = lambda a, b: F.concat(a, F.lit("_"), b)
    with_number = lambda n: F.concat(
        F.array(_key("addr_num", n)),
        _some(has_name, F.array(_key("name_num", joined(first, n)))),
        F.transform(address, lambda t: _key("addr_num_street", joined(n, t))).cast(_KEY),
    )
    return F.concat(
        _some(F.length(compact) >= 4, F.array(_key("name_compact", compact))),
        _some(F.length(prefix) >= 3, F.array(_key("name_prefix", prefix))),
        _some(has_name, F.array(_key("name_first_token", first))),
        _some(F.size(name) >= 2, F.array(_key("name_sorted", F.array_join(F.array_sort(name), " ")), _key("name_first2", F.array_join(F.slice(name, 1, 2), " ")))),
        F.filter(F.flatten(F.transform(core(name), lambda t: F.array(_key("name_token", t, t), _key("name_soundex", sound(t), t)))), lambda k: k["value"] != "").cast(_KEY),
        F.transform(core(address), lambda t: _key("addr_token", t, t)).cast(_KEY),
        F.flatten(F.transform(numbers, with_number)).cast(_KEY),
        _some(has_address & has_name, F.array(_key("name_city", joined(first, city)))),
        _some(has_address, F.transform(numbers, lambda n: _key("num_city", joined(n, city)))),
    )


def with_tokens(records: DataFrame, config: KeyConfig = KeyConfig()) -> DataFrame:
    return records.select(
        "country_norm",
        "entity_id",
        core_tokens(F.col("name_norm"), config.least_token).alias("_name"),
        core_tokens(F.col("address_norm"), config.least_token).alias("_address"),
        F.filter(pipe_list(F.col("address_numbers")), lambda n: F.length(n) >= config.least_token).alias("_numbers"),
        alnum(F.col("name_norm")).alias("_compact"),
    )


def token_frequency(targets: DataFrame, config: KeyConfig = KeyConfig()) -> DataFrame:
    """(country_norm, token, n): a target with the token in its name and in its address counts twice."""
    once = lambda c: F.array_distinct(core_tokens(F.col(c), config.least_core))
    tokens = targets.select("country_norm", F.explode(F.concat(once("name_norm"), once("address_norm"))).alias("token"))
    return tokens.groupBy("country_norm", "token").agg(F.count("*").alias("n"))


def keys(records: DataFrame, frequency: DataFrame | None, config: KeyConfig = KeyConfig()) -> DataFrame:
    """(country_norm, entity_id, ord, kind, value), with multiplicity; ``frequency`` None leaves out the gate."""
    rows = with_tokens(records, config).select("country_norm", "entity_id", F.posexplode(proposed(config)).alias("ord", "k"))
    rows = rows.select("country_norm", "entity_id", "ord", "k.kind", "k.value", "k.gate")
    if frequency is not None:
        # only frequent tokens are looked up; they are few beside all tokens
        frequent = frequency.where(F.col("n") > config.most_frequent).select(F.col("country_norm").alias("_c"), F.col("token").alias("_t"))
        rows = rows.join(frequent, (F.col("country_norm") == F.col("_c")) & (F.col("gate") == F.col("_t")), "left_anti")
    return rows.drop("gate")


def posting_sizes(target_keys: DataFrame, config: KeyConfig = KeyConfig()) -> DataFrame:
    """(country_norm, kind, value, size, dsize): postings with multiplicity and distinct targets, of keys that aren't too large."""
    per_target = target_keys.groupBy("country_norm", "kind", "value", "entity_id").agg(F.count("*").alias("m"))
    sizes = per_target.groupBy("country_norm", "kind", "value").agg(F.sum("m").alias("size"), F.count("*").alias("dsize"))
    return sizes.where(F.col("size") <= config.most_postings)


def postings(target_keys: DataFrame, config: KeyConfig = KeyConfig()) -> DataFrame:
    return target_keys.join(posting_sizes(target_keys, config), ["country_norm", "kind", "value"])
