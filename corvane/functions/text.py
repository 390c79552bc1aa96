"""Normalisation of names and addresses as Spark columns.

Latin text is folded inside the JVM by ``translate``; texts in other scripts go through
an Arrow function that names letters by their Unicode name.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexicons import ADDRESS_ABBREVIATIONS, LANDMARK_TOKENS, LEGAL_FORMS, SOUNDEX_CODES, SOUNDEX_LETTERS, STOP_TOKENS

#: Latin letters without a decomposition, and what they are written as.
SPELLED = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i"}


def _bare(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@lru_cache
def _folds() -> tuple[str, str]:
    """Latin, Greek and Cyrillic letters that decompose to one letter, and full-width ones, and that letter, by rule from the Unicode decompositions.

    The table stands in every plan, so it has no rarer scripts; ``romanised`` reads those.
    """
    pairs = [(chr(cp), _bare(chr(cp))) for cp in (*range(0x80, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0xFF01, 0xFF5F))]
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@lru_cache
def _ligatures() -> tuple[tuple[str, str], ...]:
    """Latin letters that decompose to several: ligatures and digraphs."""
    pairs = [(chr(cp), _bare(chr(cp))) for cp in (*range(0x80, 0x250), *range(0xFB00, 0xFB07))]
    return tuple((a, b) for a, b in pairs if len(b) > 1 and b.isascii() and b.isalpha())


def strip_accents(x: Column) -> Column:
    """Letters without their marks, in their plain form; Latin ligatures spelled out."""
    out = F.regexp_replace(F.translate(F.coalesce(x.cast("string"), F.lit("")), *_folds()), r"\p{Mn}", "")
    for letter, letters in _ligatures():
        out = F.replace(out, F.lit(letter), F.lit(letters))
    return out


def to_ascii(x: Column) -> Column:
    """``strip_accents``, and letters like ß spelled out."""
    out = strip_accents(x)
    for letter, spelled in SPELLED.items():
        out = F.replace(out, F.lit(letter), F.lit(spelled))
    return out


def _romanise(text: str) -> str:
    out = []
    for c in unicodedata.normalize("NFKD", text):
        if ord(c) < 128:
            out.append(c)
        elif c in SPELLED:
            out.append(SPELLED[c])
        elif unicodedata.category(c) == "Nd":
            out.append(str(unicodedata.digit(c)))
        elif unicodedata.category(c)[0] == "L":
            # "DEVANAGARI LETTER KA" reads ka
            name = unicodedata.name(c, "").split(" WITH ")[0].split(" ")
            out.append(name[-1].lower() if "LETTER" in name else " ")
        elif "VOWEL SIGN" in unicodedata.name(c, ""):
            out.append(unicodedata.name(c).split(" ")[-1].lower())
        elif not unicodedata.combining(c) and unicodedata.category(c)[0] != "M":
            out.append(" ")
    return "".join(out)


def romanised(x: Column) -> Column:
    """Any script in ASCII letters.

    Latin texts are folded in the JVM; only texts with other letters go to an Arrow function (nulls stand for the
    rest), each distinct text of a batch once.
    """

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        known = {t: _romanise(t) for t in texts.dropna().unique()}
        return pd.Series([known.get(t) for t in texts], dtype=object)

    others = r"[^\x00-\u024F\u1E00-\u1EFF\u2000-\u206F\uFB00-\uFB06\uFF01-\uFF5E\p{Mn}]"
    return F.coalesce(run(F.when(x.rlike(others), x.cast("string"))), to_ascii(x))


def tokenize(x: Column, any_script: bool = True) -> Column:
    folded = romanised(x) if any_script else to_ascii(x)
    return F.regexp_extract_all(F.replace(F.lower(folded), F.lit("&"), F.lit(" and ")), F.lit(r"(?U)\w+"), F.lit(0))


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for kv in d.items() for v in kv])


def _words(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _listed(tokens: Column) -> Column:
    return F.concat_ws("|", F.array_sort(F.array_distinct(tokens)))


def name_parts(tokens: Column) -> tuple[Column, Column]:
    """(name_norm, legal_form) from tokens: legal forms are taken out first, then stop words."""
    forms = _literal_map(LEGAL_FORMS)
    is_form = lambda t: t.isin(*LEGAL_FORMS)
    core = F.filter(tokens, lambda t: ~is_form(t) & ~t.isin(*STOP_TOKENS))
    legal = F.transform(F.filter(tokens, is_form), lambda t: forms[t])
    return F.concat_ws(" ", core), _listed(legal)


def address_parts(tokens: Column, raw: Column) -> tuple[Column, Column, Column]:
    """(address_norm, address_numbers, landmark_tokens): landmarks are taken out before stop words; numbers come from the raw text."""
    short = _literal_map(ADDRESS_ABBREVIATIONS)
    kept = F.filter(tokens, lambda t: ~t.isin(*LANDMARK_TOKENS) & ~t.isin(*STOP_TOKENS))
    spelled = F.transform(kept, lambda t: F.when(t.isin(*ADDRESS_ABBREVIATIONS), short[t]).otherwise(t))
    numbers = F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(r"\p{Nd}+"), F.lit(0))
    return F.concat_ws(" ", spelled), F.concat_ws("|", numbers), _listed(F.filter(tokens, lambda t: t.isin(*LANDMARK_TOKENS)))


def normalized(records: DataFrame, any_script: bool = True) -> DataFrame:
    """The records with the seven normalised columns."""
    t = records.withColumn("_n", tokenize(F.col("business_name"), any_script)).withColumn("_a", tokenize(F.col("business_address"), any_script))
    name, legal = name_parts(F.col("_n"))
    address, numbers, landmarks = address_parts(F.col("_a"), F.col("business_address"))
    t = t.withColumns({"name_norm": name, "legal_form": legal, "address_norm": address, "address_numbers": numbers, "landmark_tokens": landmarks}).drop("_n", "_a")
    country = F.coalesce("country", F.lit(""))
    return t.withColumns({"combined_norm": F.trim(F.concat_ws(" ", "name_norm", "address_norm", country)), "country_norm": F.trim(F.lower(strip_accents(country)))})


def token_list(x: Column) -> Column:
    """Tokens of a normalised text, in order, with repeats."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"\s+"), lambda t: t != "")


def token_set(x: Column) -> Column:
    return F.array_distinct(token_list(x))


def pipe_list(x: Column) -> Column:
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda t: t != "")


def pipe_set(x: Column) -> Column:
    return F.array_distinct(pipe_list(x))


def core_tokens(x: Column, least: int = 3) -> Column:
    return F.filter(token_list(x), lambda t: F.length(t) >= least)


def alnum(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"[^\p{L}\p{N}]", "")


def alnum_prefix(x: Column, n: int) -> Column:
    return F.substring(alnum(x), 1, n)


def soundex(x: Column) -> Column:
    """First letter and three codes: a letter counts if its code differs from that of the letter before it.

    So vowels, h and w part equal codes; digits are left out; a text without letters gives an empty text.
    """
    letters = F.lower(F.regexp_replace(x, r"[^\p{L}]", ""))
    codes = F.translate(F.regexp_replace(letters, "[^a-z]", "a"), SOUNDEX_LETTERS, SOUNDEX_CODES)
    runs = F.replace(F.substring(F.regexp_replace(codes, r"(.)\1+", "$1"), 2, 1 << 20), F.lit("0"), F.lit(""))
    return F.when(letters == "", "").otherwise(F.rpad(F.concat(F.substring(letters, 1, 1), runs), 4, "0"))


def has_non_latin(x: Column) -> Column:
    return strip_accents(x).rlike(r"[^\x00-\x7F]")


def clean_name_tokens(x: Column) -> Column:
    return F.filter(token_set(x), lambda t: (F.length(t) >= 3) & ~t.rlike(r"^\p{Nd}+$"))


def clean_address_tokens(x: Column) -> Column:
    return F.filter(token_set(x), lambda t: F.length(t) >= 3)


def useful_numbers(x: Column) -> Column:
    return F.filter(pipe_set(x), lambda t: F.length(t) >= 3)
