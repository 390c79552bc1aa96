import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvane.operators import blocking, nearest


def vector_batches(s1, targets, n):
    """The same for vectors: (country, {term: (count, weight)}, norm)."""
    for batch in batches({i: (c, (v, norm)) for i, (c, v, norm) in s1.items()}, {i: (c, (v, norm)) for i, (c, v, norm) in targets.items()}, None, n):
        rows = batch
        kinds = {"terms": pa.list_(pa.int32()), "counts": pa.list_(pa.int32()), "norm": pa.float64(), "weights": pa.list_(pa.float64())}
        made = [{"terms": sorted(v), "counts": [v[t][0] for t in sorted(v)], "norm": norm, "weights": [v[t][1] for t in sorted(v)] if not r["side"] else None} for r in rows for v, norm in [r["tokens"]]]
        arrays = [pa.array([r[c] for r in rows], k) for c, k in KEYS] + [pa.array([x[c] for x in made], k) for c, k in kinds.items()]
        yield pa.RecordBatch.from_arrays(arrays, [c for c, _ in KEYS] + [*kinds])


KEYS = (("country_norm", pa.string()), ("chunk", pa.int32()), ("side", pa.int32()), ("target_source", pa.string()), ("entity_id", pa.string()))


def batches(s1, targets, kind, n):
    """Rows as ``met`` sends them, ``n`` to a batch: of each country the S1 records, then targets by source and id."""
    rows = [(c, 0, 0, "", i, v) for i, (c, v) in s1.items()] + [(c, 0, 1, i[:2], i, v) for i, (c, v) in targets.items()]
    rows.sort(key=lambda r: r[:5])
    names = [*(c for c, _ in KEYS), "tokens"]
    for at in range(0, len(rows), n):
        some = [dict(zip(names, r)) for r in rows[at : at + n]]
        yield some if kind is None else pa.RecordBatch.from_pylist(some, pa.schema([*KEYS, ("tokens", kind)]))


def test_most_common_tokens_by_blocks(monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 7)
    r = random.Random(4)
    some = lambda: r.sample("abcdefghijklmnop", r.randrange(7))
    s1 = {f"S1-{k}": (r.choice("xy"), some()) for k in range(15)}
    targets = {f"S{r.choice('23')}-{k}": (r.choice("xyz"), some()) for k in range(120)}
    found = {}
    for batch in nearest.most_common(5, 9)(batches(s1, targets, pa.list_(pa.string()), 11)):
        for x in batch.to_pylist():
            found.setdefault(x["source1_entity_id"], []).append((x["candidate_entity_id"], x["score"]))
    for s, (country, mine) in s1.items():
        near = sorted((-len(set(mine) & set(v)), t[:2], t) for t, (c, v) in targets.items() if c == country and set(mine) & set(v))[:9]
        score = {t: -n / len({*mine, *targets[t][1]}) for n, _, t in near}
        # of equal shares the last by source and id
        wanted = sorted(sorted(score, reverse=True), key=lambda t: -score[t])[:5]
        assert found.get(s, []) == [(t, score[t]) for t in wanted]


def test_largest_products_by_blocks(monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 13)
    r = random.Random(6)
    weight = {t: 1 + r.random() for t in range(30)}
    vector = lambda: (r.choice("xyz"), {t: (r.randrange(1, 4), weight[t]) for t in {*r.sample(range(4), 2), *r.sample(range(30), 3)}}, 1 + r.random())
    s1, targets = {f"S1-{k}": vector() for k in range(20)}, {f"S{r.choice('23')}-{k}": vector() for k in range(150)}
    targets |= {f"{i}-twin": v for i, v in [*targets.items()][:40]}
    found = {}
    for batch in nearest.largest_products(6)(vector_batches(s1, targets, 17)):
        for x in batch.to_pylist():
            found.setdefault(x["source1_entity_id"], []).append((x["candidate_entity_id"], x["score"]))
    for s, (country, mine, a) in s1.items():
        score = {t: round(sum(n * w * v[g][0] * w for g, (n, w) in mine.items() if g in v) / a / b, 9) for t, (c, v, b) in targets.items() if c == country}
        wanted = sorted((t for t in score if score[t]), key=lambda t: (-score[t], t[:2], t))[:6]
        got = found.get(s, [])
        assert [t for t, _ in got] == wanted and all(abs(x - score[t]) < 2e-9 for t, x in got)


def test_products_are_not_stored(spark, monkeypatch):
    """40 records and 60 targets of the same words make 2400 products, but no table of as many rows."""
    kept, write = [], blocking.stored
    monkeypatch.setattr(blocking, "stored", lambda rows: kept.append(write(rows)) or kept[-1])
    side = lambda n, source: spark.range(n).select(F.lit("us").alias("country_norm"), F.lit(source).alias("target_source"), F.concat(F.lit(f"{source}-"), F.col("id").cast("string")).alias("entity_id"), F.lit("one word").alias("name_norm"))
    got = blocking.tfidf_blocking(side(40, "S1"), side(60, "S2"), "name_norm", 3, "name_tfidf")
    wanted = [(f"S1-{k}", t, 1.0, n) for k in range(40) for n, t in enumerate(sorted(f"S2-{k}" for k in range(60))[:3], 1)]
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(wanted)
    assert max(rows.count() for rows in kept) < 2400


def test_the_union_stores_no_products(spark, monkeypatch):
    kept, write = [], blocking.stored
    monkeypatch.setattr(blocking, "stored", lambda rows: kept.append(write(rows)) or kept[-1])
    words = {c: F.lit("word") for c in ("name_norm", "address_norm", "combined_norm")} | {"country_norm": F.lit("us"), "address_numbers": F.lit("")}
    side = lambda n, source: spark.range(n).select(F.lit(source).alias("target_source"), F.concat(F.lit(f"{source}-"), F.col("id").cast("string")).alias("entity_id")).withColumns(words)
    got = blocking.union_candidates(side(40, "S1"), side(60, "S2"), blocking.BlockingConfig(name_top_k=2, address_top_k=2, combined_top_k=2, token_top_k=2)).collect()
    assert {r["source1_entity_id"] for r in got} == {f"S1-{k}" for k in range(40)}
    assert max(rows.count() for rows in kept) < 2400


def test_no_token_is_too_frequent(spark):
    """20 001 targets share a token, which no limit on frequency may leave out."""
    side = lambda rows: rows.withColumns({"country_norm": F.lit("us"), "address_norm": F.lit(""), "address_numbers": F.lit("")})
    s1 = side(spark.createDataFrame([("S1-1", "common one")], "entity_id string, name_norm string"))
    targets = side(spark.range(20_001).select(F.format_string("S2-%05d", "id").alias("entity_id"), F.lit("S2").alias("target_source"), F.concat(F.lit("common x"), F.col("id").cast("string")).alias("name_norm")))
    got = blocking.token_blocking(s1, targets, top_k=2).orderBy("token_rank").collect()
    # the 40 first with one token in common are scored, and of equal scores the last win
    assert [(r["candidate_entity_id"], round(r["token_score"], 6)) for r in got] == [("S2-00039", 0.333333), ("S2-00038", 0.333333)]


def levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, c in enumerate(a):
        now = [i + 1]
        for j, d in enumerate(b):
            now.append(min(last[j] + (c != d), last[j + 1] + 1, now[-1] + 1))
        last = now
    return last[-1]


def test_distances_of_texts_in_words_of_64():
    r = random.Random(1)
    text = lambda n: "".join(r.choice("abñ𝔸") for _ in range(n))
    a, b = [text(n) for n in (0, 1, 5, 63, 64, 65, 128, 130)], [text(n) + "z" * (n % 2) for n in (0, 1, 7, 64, 70, 150)]
    d = nearest.Distances(pa.array(a))
    letters, starts, sizes = nearest._letters(pa.array(b))
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    assert d.to(i, d.numbered(letters), starts[j], sizes[j], most=11).tolist() == [levenshtein(a[x], b[y]) for x, y in zip(i, j)]


def test_keyed_scores_count_all_pairs_and_store_none(spark, monkeypatch):
    """All 40 records share a name with all 60 targets; the best address counts, whatever block and group it is in."""
    kept, write = [], blocking.stored
    monkeypatch.setattr(blocking, "stored", lambda rows: kept.append(write(rows)) or kept[-1])
    id = F.col("id").cast("string")
    side = lambda n, source: spark.range(n).select(F.lit(source).alias("target_source"), F.concat(F.lit(f"{source}-"), id).alias("entity_id"), F.lit("us").alias("country_norm"), F.lit("same name").alias("name_norm"), F.concat(F.lit("road "), id).alias("address_norm"), F.lit("").alias("address_numbers"))
    got = blocking.keyed_scores(side(40, "S1"), blocking.KeyIndex.of(side(60, "S2"))).collect()
    assert {(r["source1_entity_id"], r["n"], r["best"]) for r in got} == {(f"S1-{k}", 60, 1.0) for k in range(40)}
    assert max(rows.count() for rows in kept) < 2400


def test_keyed_scores_by_blocks_and_groups(monkeypatch):
    r = random.Random(3)
    text = lambda: "".join(r.choice("abc ") for _ in range(r.choice((0, 4, 9, 70))))
    record = lambda: (r.choice("xy"), {"keys": r.sample(range(40), r.randrange(1, 4)), "name": text(), "address": text()})
    s1, targets = {f"S1-{k}": record() for k in range(30)}, {f"S{r.choice('23')}-{k}": record() for k in range(150)}
    monkeypatch.setattr(nearest, "BLOCK", 13)
    monkeypatch.setattr(nearest, "CELLS", 40)
    monkeypatch.setattr(nearest, "MEETINGS", 20)
    kind = pa.struct([("keys", pa.list_(pa.int32())), ("name", pa.string()), ("address", pa.string())])
    flat = [pa.RecordBatch.from_arrays([*b.columns[:5], *b.columns[5].flatten()], [c for c, _ in KEYS] + ["keys", "name", "address"]) for b in batches(s1, targets, kind, 17)]
    found = {x["source1_entity_id"]: (x["n"], round(x["best"], 9)) for batch in nearest.counted_by_key((0.7, 0.3))(iter(flat)) for x in batch.to_pylist()}
    like = lambda a, b: 1.0 if not a and not b else 1.0 - levenshtein(a, b) / max(len(a), len(b))
    wanted = {}
    for s, (country, x) in s1.items():
        scores = [0.7 * like(x["name"], y["name"]) + 0.3 * like(x["address"], y["address"]) for c, y in targets.values() if c == country and {*x["keys"]} & {*y["keys"]}]
        if scores:
            wanted[s] = (len(scores), round(max(scores), 9))
    assert found == wanted


def grams_of(word, least, most):
    w, out = f" {word} ", []
    for n in range(least, most + 1):
        if n == least or len(w) >= n:
            out += [w[i : i + n] for i in range(max(len(w) - n + 1, 1))]
    return out


def test_counted_grams_by_batches(monkeypatch):
    """Grams of two lengths, of words shorter than the least, and of an alphabet too large for one number."""
    monkeypatch.setattr(nearest, "BLOCK", 1000)
    r = random.Random(2)
    for letters, ngrams in (("abé", (3, 5)), ("abé", (5, 6)), ([chr(x) for x in range(0x4E00, 0x4E00 + 9000)], (3, 5))):
        texts = [(r.choice("xy"), ["".join(r.choice(letters) for _ in range(r.randrange(1, 8))) for _ in range(r.randrange(5))]) for _ in range(2200)]
        wanted = {}
        for c, words in texts:
            found = [g for w in words for g in grams_of(w, *ngrams)]
            for g in found:
                wanted.setdefault((c, g), [0, 0])[1] += 1
            for g in {*found}:
                wanted[c, g][0] += 1
        batch = pa.RecordBatch.from_pydict({"country_norm": [c for c, _ in texts], "text": ["".join(f" {w} " for w in words) for _, words in texts]})
        got = {}
        for b in nearest.counted_grams(ngrams)(iter([batch])):
            for x in b.to_pylist():
                n = got.setdefault((x["country_norm"], x["gram"]), [0, 0])
                n[0], n[1] = n[0] + x["df"], n[1] + x["cf"]
        assert got == wanted


def test_no_row_or_list_of_a_records_grams_is_stored(spark, monkeypatch):
    kept, write = [], blocking.stored
    monkeypatch.setattr(blocking, "stored", lambda rows: kept.append(write(rows)) or kept[-1])
    side = lambda n, source: spark.range(n).select(F.lit(source).alias("target_source"), F.concat(F.lit(f"{source}-"), F.col("id").cast("string")).alias("entity_id"), F.lit("us").alias("country_norm"), F.lit("some longer name").alias("name_norm"))
    got = blocking.tfidf_blocking(side(3, "S1"), side(60, "S2"), "name_norm", 2, "b").collect()
    assert sorted((r["source1_entity_id"], r["candidate_entity_id"], r["b_score"]) for r in got) == [(f"S1-{k}", f"S2-{c}", 1.0) for k in range(3) for c in (0, 1)]
    assert max(rows.count() for rows in kept) == len({g for w in ("some", "longer", "name") for g in grams_of(w, 3, 5)})
