import random

import pandas as pd
from pyspark.sql import functions as F

from corvane.functions import similarity as S
from corvane.functions import text as X


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column).first()[0]


def test_names_lose_stop_words_and_legal_forms(spark):
    name, legal = X.name_parts(X.tokenize(F.col("x")))
    assert one(spark, name, x="Acme Pvt. Ltd. & Sons") == "acme sons"
    assert one(spark, legal, x="Acme Pvt. Ltd. & Sons") == "limited|private"
    assert one(spark, name, x=None) == ""
    assert one(spark, name, x="Bar Bar the Bar") == "bar bar bar"


def test_addresses_keep_numbers_and_landmarks(spark):
    parts = X.address_parts(X.tokenize(F.col("x")), F.col("x"))
    got = [one(spark, p, x="12/3 MG Rd, Near SBI, Bangalore 560004") for p in parts]
    assert got == ["12 3 mg road sbi bangalore 560004", "12|3|560004", "near"]


def test_accents(spark):
    assert one(spark, X.to_ascii(F.col("x")), x="Café Straße Øre") == "Cafe Strasse Ore"
    assert one(spark, X.strip_accents(F.col("x")), x="Café ß") == "Cafe ß"
    assert one(spark, X.romanised(F.col("x")), x="Straße é") == "Strasse e"
    assert one(spark, X.has_non_latin(F.col("x")), x="कमल") is True


def test_other_scripts_and_forms(spark):
    for x, wanted in (("Ἀθήνα Ёлка", "Αθηνα Елка"), ("Ｆｕｌｌ２", "Full2"), ("ﬁne ĳs ﬄ", "fine ijs ffl"), (None, "")):
        assert one(spark, X.strip_accents(F.col("x")), x=x) == wanted
    assert one(spark, X.romanised(F.col("x")), x="दिल Café ß") == "daila Cafe ss"
    rows = spark.createDataFrame([("Straße",), (None,), ("дом",), ("",)], "x string").select(X.romanised(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in rows] == ["Strasse", "", "deoem", ""]
    got = spark.createDataFrame([("a", "रमेश स्टोर", "1 Main St", "India")], "entity_id string, business_name string, business_address string, country string")
    assert X.normalized(got).first()["name_norm"].isascii() and not X.normalized(got, False).first()["name_norm"].isascii()


def test_simplified_soundex(spark):
    for word, code in (("robert", "r163"), ("ashcraft", "a226"), ("3m", "m000"), ("123", ""), ("", ""), ("pfister", "p236")):
        assert one(spark, X.soundex(F.col("x")), x=word) == code


def procedural_soundex(word):
    codes = dict(zip("abcdefghijklmnopqrstuvwxyz", "01230120022455012623010202"))
    letters = [c for c in word.lower() if c.isalpha()]
    if not letters:
        return ""
    out, before = letters[0], codes[letters[0]]
    for c in letters[1:]:
        if codes[c] != "0" and codes[c] != before:
            out += codes[c]
        before = codes[c]
    return (out + "000")[:4]


def test_soundex_agrees_with_a_loop(spark):
    import random

    r = random.Random(1)
    words = ["".join(r.choice("abcdfghklmnprstwz1") for _ in range(r.randint(0, 9))) for _ in range(300)]
    rows = spark.createDataFrame([(w,) for w in words], "x string").select("x", X.soundex(F.col("x")).alias("c")).collect()
    assert all(procedural_soundex(x) == c for x, c in rows)


def dp(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_longest_common_subsequence():
    import random

    r = random.Random(2)
    for _ in range(300):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(0, 14))) for _ in range(2))
        assert S._lcs(a, b) == dp(a, b)


def test_string_similarities():
    assert S.indel("", "") == 1.0 and S.indel("a", "") == 0.0
    assert S.token_sort("b a", "a b") == 1.0
    assert S.token_set("a b", "a b c") == 1.0 and S.token_set("", "") == 0.0
    assert abs(S.jaro_winkler("martha", "marhta") - 0.9611) < 1e-4
    assert S.jaro_winkler("", "") == 0.0
    assert S.sequence_ratio("tide", "diet") == 0.25 and S.sequence_ratio("diet", "tide") == 0.5


def test_set_similarities(spark):
    a, b = F.split("x", " "), F.split("y", " ")
    assert one(spark, S.jaccard(a, b), x="a b", y="b c") == 1 / 3
    empty = F.array().cast("array<string>")
    assert one(spark, S.jaccard(empty, empty), x="") == 0.0
    assert one(spark, S.overlap_coefficient(a, b), x="a b c", y="b") == 1.0
    grams = lambda: S.char_ngrams(F.col("x"))
    assert one(spark, grams(), x="ab") == ["ab"] and one(spark, grams(), x="") == [] and one(spark, grams(), x="abcd") == ["abc", "bcd"]
    assert one(spark, S.levenshtein_similarity(F.col("x"), F.col("y")), x="", y="") == 1.0


def test_similarities_of_many_pairs_are_those_of_each():
    """Empty and equal texts, letters outside the first plane, and texts of 63 to 210 letters, beyond a word of bits and difflib's limit."""
    r = random.Random(5)

    def text():
        if r.random() < 0.3:
            return "".join(r.choice("abñ𝔸 ") for _ in range(r.choice((0, 1, 2, 9, 63, 64, 65, 210))))
        return " ".join(r.choice(("ab", "ba", "http", "tion", "example", "org", "en", "1234", "html", "a")) for _ in range(r.randrange(1, 12)))

    pool = [text() for _ in range(60)]
    a, b = [pd.Series([r.choice(pool) for _ in range(900)]) for _ in "ab"]
    for many, one in ((S._indels, S.indel), (S._token_sorts, S.token_sort), (S._token_sets, S.token_set), (S._jaro_winklers, S.jaro_winkler), (S._sequence_ratios, S.sequence_ratio)):
        assert many(a, b).tolist() == [one(*p) for p in zip(a, b)]
        assert many(a[:0], b[:0]).tolist() == []
