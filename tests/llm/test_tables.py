"""Operators over whole tables: mixing, exact and near dedup, WARC, language, and the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from corvane.llm import exact, langid, mixing, near, quality, warc
from corvane.llm.common import table
from corvane.llm.queries import PREDICTED_FROM, vocabulary

SF = "/root/testdata/sf0.001"


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# mixing


def mixed(spark, rows, **more):
    made = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit("clash")).withColumn("size", F.lit(None).cast("string"))
    return mixing.mix(made, mixing.n_words(F.col("text")), **more)


def mix_rows(seed=1, n=400):
    r = random.Random(seed)
    rows = [(k, r.choice(["b", "b", "b", "a", "é", None, "z"]), r.choice([None, "", *["w " * r.randrange(1, 30)] * 4])) for k in range(n)]
    return [*rows, rows[0], rows[0], (None, "a", "x y"), (None, "a", "x y")]


def test_targets_and_budgets(spark):
    rows = mix_rows()
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(brute.WORD.findall(t or ""))
    wanted = brute.targets(sizes)
    got = mixed(spark, rows).collect()
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6
        assert r["size"] == len(brute.WORD.findall(r["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == len(rows) and all(taken[s] == round(wanted[s]) for s in sizes)
    again = mixed(spark, rows[::-1])
    assert sorted(map(str, again.repartition(3).collect())) == sorted(map(str, got))
    assert mixed(spark, []).count() == 0
    assert all(r["taken"] == 0 for r in mixed(spark, [(1, "a", None), (2, None, "")]).collect())


def test_whole_documents_come_near(spark):
    got = mixed(spark, mix_rows(2), whole=True).collect()
    by, target = Counter(), {}
    for r in got:
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        by[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(by[s] - target[s]) <= 30 for s in target)


def test_ranges_add_up(spark):
    before = mixing.ROWS_PER_RANGE, mixing.STRIPES
    try:
        one = sorted(map(str, mixed(spark, mix_rows(3)).collect()))
        mixing.ROWS_PER_RANGE, mixing.STRIPES = 1, 4
        assert sorted(map(str, mixed(spark, mix_rows(3)).collect())) == one
    finally:
        mixing.ROWS_PER_RANGE, mixing.STRIPES = before


# exact dedup

COPIES = [(5, "a b"), (3, "ab"), (9, "a  b"), (2, "a  b"), (7, None), (8, ""), (6, " \n"), (None, "zz"), (4, "zz"), (None, "q"), (1, "x" * 50_000), (10, "x" * 50_000 + "\t"), (3, "ab"), (11, "x" * 49_999)]


def test_exact_groups_equal_plain_ones(spark):
    rows = documents(spark, COPIES).withColumn("key", F.lit(1)).withColumn("keep_id", F.lit("clash"))
    got = Counter(tuple(r) for r in exact.exact_groups(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == Counter(brute.exact(COPIES))
    assert exact.exact_groups(rows.where("false")).count() == 0
    kept = exact.drop_copies(rows)
    assert kept.columns == rows.columns
    assert kept.count() == len({brute.SPACE.sub("", t or "") for _, t in COPIES})


@pytest.mark.parametrize("held", [1, 1500, 2000, 20_000, 1 << 40])
def test_tries_spill_and_keep_owners(held):
    r = random.Random(held)
    trie, plain = exact.OwnerTrie(held), {}
    for _ in range(3000):
        key = bytes(r.choice(b"ab") for _ in range(r.randrange(0, 12))) * r.choice((1, 3))
        owner = (r.randrange(5), r.choice((None, *range(20))), 1)
        trie.insert(key, owner)
        plain[key] = exact.better(plain[key], owner) if key in plain else owner
    got = list(trie.items())
    assert len(got) == len(plain) and dict(got) == plain


# near dedup


def near_rows(seed=1):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.randrange(4, 120))]
        for _ in range(r.choice((1, 2, 5))):
            copy = list(base)
            for _ in range(r.choice((0, 0, 1, 2, 6))):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows), r.choice((" ", "\n ")).join(copy)))
    hub = [r.choice(words) for _ in range(150)]
    for _ in range(60):  # a large group
        copy = list(hub)
        copy[r.randrange(150)] = r.choice(words)
        rows.append((len(rows), " ".join(copy)))
    r.shuffle(rows)
    return [*rows, rows[0], (900, None), (901, ""), (902, "one"), (903, "one"), (904, "one two"), (900, "repeated id " * 9)]


def test_near_classes_equal_all_pairs(spark):
    rows = near_rows()
    wanted = brute.near(rows)
    made = documents(spark, [*rows, (None, "alone"), (None, None)]).withColumn("set", F.lit(1)).withColumn("rep", F.lit(2))
    got = near.near_groups(made).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert r["class_id"] == wanted.get(r["doc_id"]) and r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["class_id"])
    assert near.near_groups(made.where("false")).count() == 0


def test_a_group_about_the_threshold_loses_no_link(spark):
    """Copies with edits from few words, so that some of their shingles are in one, two, three or more of them."""
    r = random.Random(5)
    base, rows = [f"b{k}" for k in range(150)], []
    for k in range(150):
        copy = list(base)
        for _ in range(r.randrange(2, 7)):
            copy[r.randrange(150)] = f"e{r.randrange(4)}"
        rows.append((k, " ".join(copy[: r.choice((150, 150, 140, 125))])))
    rows += [rows[3], (4, rows[9][1] + " and more")]  # a repeated row; an id of two texts
    wanted = brute.near(rows)
    assert 1 < len(set(wanted.values())) < 150
    got = {x["doc_id"]: x["class_id"] for x in near.near_groups(documents(spark, rows)).collect()}
    assert got == wanted


def test_rare_shingles_name_up_to_three_ids(spark):
    texts = {1: "a b c d e", 2: "a b c d e f", 3: "a b c d e f g", 4: "x y", 5: "b c d e f g", 6: "x y"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(4)
    got = {tuple(sorted(x["ids"])): x["met"] for x in near.rare_shingles(df).collect()}
    assert got == {(1, 2, 3): 1, (2, 3, 5): 1, (3, 5): 1, (4, 6): 1}
    assert near.rare_shingles(df.where("false")).count() == 0


def test_links_across_pivots_are_found(spark):
    """A chain: neighbours are near, the ends are not, so that no single pivot reaches all."""
    base = [f"c{k}" for k in range(100)]
    rows = []
    for k in range(12):
        rows.append((100 - k, " ".join([*(f"d{j}" for j in range(k * 4)), *base[k * 4 :]])))
    got = {r["doc_id"]: r["class_id"] for r in near.near_groups(documents(spark, rows)).collect()}
    assert got == brute.near(rows)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 62, 400).astype(np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 1 << 62, 100).astype(np.uint64)])
    s = near.signatures([a, b, a[:1], a[:0]], k=2000)
    assert abs((s[0] == s[1]).mean() - 300 / 500) < 0.04 and s[2].all() and not s[3].any()
    w = near.signatures([a[:50], a[:50]], [np.full(50, 2.0), np.full(50, 0.5)], k=2000)
    assert abs((w[0] == w[1]).mean() - 0.25) < 0.04
    assert (near.signatures([a[::-1]], k=144) == near.signatures([a], k=144)).all()


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(100 + k, 101 + k) for k in range(20)] + [(7, 7)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    for few in (0, 1000):
        got = {x["id"]: x["least"] for x in near.components(spark.createDataFrame(edges, "a long, b long"), few).collect()}
        assert all(got.get(x, x) == find(x) for x in parent)
        assert near.components(spark.createDataFrame([], "a long, b long"), few).count() == 0


# columns named like those that the operators add for themselves

CLASHES = {
    "exact": ("row", "sha", "n", "key", "key_sha256", "keep_id", "group_size", "at", "n_chars", "n_rows", "id", "kept", "_key", "_keep", "_sha", "_n", "_at"),
    "near": ("row", "stays", "id", "key", "bands", "rep", "bucket", "set", "class", "class_id", "kept", "pivot", "n", "_id", "_least"),
    "mixing": ("row", "s", "key", "p", "fine", "stripe", "range", "s1", "t1", "a", "b", "s2", "t2", "r2", "n", "n_rows", "offset", "here", "level", "weight", "_s", "_s2", "_fine", "_key", "_here", "_range"),
}


@pytest.mark.parametrize("operator", CLASHES)
def test_extra_columns_keep_their_values(spark, operator):
    names = CLASHES[operator]
    rows = [(k, f"w{k % 7} some words of a text that has more than five", "ab"[k % 2]) for k in range(12)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wide = made.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in names})
    if operator == "mixing":
        run = lambda x: mixing.mix(x, mixing.n_words(F.col("text")))
    else:
        run = exact.drop_copies if operator == "exact" else near.drop_near_copies
    got, plain = run(wide), run(made)
    assert got.columns == [*wide.columns, *(mixing.OUT if operator == "mixing" else ())]
    got = got.collect()
    assert all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in names)
    assert sorted(tuple(r[c] for c in plain.columns) for r in got) == sorted(map(tuple, plain.collect()))


def test_exact_dedup_of_string_ids(spark):
    rows = spark.createDataFrame([("b", "x y"), ("a", "xy "), ("", "xy"), (None, "x y"), ("é", None)], "doc_id string, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_groups(rows).collect()}
    assert got == {("b", "a", 4, False), ("a", "a", 4, True), ("", "a", 4, False), (None, "a", 4, False), ("é", "é", 1, True)}
    assert sorted(r["doc_id"] for r in exact.drop_copies(rows).collect()) == ["a", "é"]


def test_rows_without_an_id_are_mixed_alike_each_time(spark):
    rows = [(None, "a", "w " * k) for k in range(1, 60)] + [(None, "a", "w w")] * 3
    got = [sorted((r["text"], r["taken"]) for r in mixed(spark, x).collect()) for x in (rows, rows[::-1])]
    assert got[0] == got[1] and sum(t for _, t in got[0]) == round(1.5 * sum(len(t.split()) for _, _, t in rows))


def test_the_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from corvane.llm.common import shared_dir

    context = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None))
    for master in ("yarn", "spark://a:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(context(master))


# WARC


def response(body, *http, **head):
    block = b"HTTP/1.1 200 OK\r\n" + b"".join(h + b"\r\n" for h in http) + b"\r\n" + body
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<r>", "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)} | head
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items() if v is not None) + b"\r\n" + block + b"\r\n\r\n"


def read_back(data, packed=False, payload=True):
    import io

    return [r["payload"] if payload else r["record_id"] for r in warc.WarcReader("", payload).records(warc._Stream(io.BytesIO(data), packed))]


def test_warc_bodies_of_others():
    import gzip

    chunked, zipped = b"Transfer-Encoding: chunked", b"Content-Encoding: gzip"
    whole = gzip.compress(b"abc") + gzip.compress(b"def")
    data = [
        response(b"4;x=y\r\nWiki\r\n5\r\npedia\r\n0\r\n\r\n", chunked),
        response(b"4\r\nWikiXX5\r\n", chunked),
        response(b"ffffffff\r\nabc", chunked),
        response(whole, zipped),
        response(b"not gzip", zipped),
        response(whole[:-3], zipped),
        response(f"{len(whole):x}\r\n".encode() + whole + b"\r\n0\r\n\r\n", chunked, zipped),
        response(b"raw", b"Content-Encoding: br"),
        response(b""),
    ]
    wanted = [b"Wikipedia", b"4\r\nWikiXX5\r\n", b"ffffffff\r\nabc", b"abcdef", b"not gzip", whole[:-3], b"abcdef", b"raw", b""]
    assert read_back(b"".join(data)) == wanted


def test_warc_records_that_are_broken():
    import gzip

    good = response(b"one")
    assert read_back(good + response(b"two", **{"Content-Length": None}) + b"noise\n" + good) == [b"one", b"one"]
    assert read_back(response(b"x", **{"Content-Length": "many"}) + good) == [b"one"]
    for payload in (True, False):
        assert len(read_back(good + good[:-20], payload=payload)) == 1
        assert len(read_back(gzip.compress(good) + gzip.compress(good)[:-30], True, payload)) == 1
    assert read_back(b"") == [] and read_back(b"\r\n\r\n") == []


def test_warc_appends_and_overwrites(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    pages = lambda *ids: warc.archived(spark.createDataFrame([(i, "u", f"page {i}") for i in ids], "page_id long, url string, html string"))
    read = lambda: sorted(r["record_id"] for r in warc.read_warc(spark, path).collect())
    warc.write_warc(pages(1, 2), path)
    warc.write_warc(pages(3), path)
    assert read() == ["urn:page:1", "urn:page:2", "urn:page:3"]
    warc.write_warc(pages(4), path, "overwrite")
    assert read() == ["urn:page:4"]


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://x/é\r\n", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (4, "u", "x" * 300_000), (4, "u", "x" * 300_000), (None, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("sha", F.lit(1))
    path = f"file://{tmp_path}/w"
    warc.write_warc(warc.archived(pages).repartition(3), path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == len(rows)
    first = defaultdict(lambda: 1 << 60)
    for i, _, h in rows:
        first[h or ""] = min(first[h or ""], i or 1 << 60)
    html = {f"urn:page:{'' if i is None else i}": (h or "") for i, _, h in rows}
    for r in got:
        h = html[r["record_id"]]
        own = int(r["record_id"][9:] or first[h])
        assert r["payload_digest"] == warc.base32(hashlib.sha1(h.encode()).digest()) and r["payload_length"] == len(h.encode())
        assert r["record_type"] == ("response" if own == first[h] else "revisit")
        assert r["refers_to"] == (None if own == first[h] else f"urn:page:{first[h]}")
        assert r["payload"] is None if own != first[h] else bytes(r["payload"]).decode() == h
    only = warc.read_warc(spark, path).where("record_type = 'revisit'")
    assert {r["record_id"] for r in only.collect()} == {"urn:page:3", "urn:page:5"}
    assert warc.read_warc(spark, path).where(F.col("target_uri").isin("u")).count() == 5
    bare = warc.read_warc(spark, path, payload=False)
    assert bare.where("payload is not null").count() == 0 and bare.where("payload_digest is null").count() == 0


def test_warc_small_payloads_and_empty_tables(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    assert warc.archived(pages, least=3).where("record_type = 'revisit'").count() == 0
    path = f"file://{tmp_path}/e"
    warc.write_warc(warc.archived(pages.where("false")), path)
    assert warc.read_warc(spark, path).count() == 0


def test_warc_skips_payloads_it_does_not_want(monkeypatch):
    import io

    row = {"record_type": "response", "record_id": "urn:page:1", "target_uri": "u", "payload_digest": None, "refers_to": None, "payload_length": 3, "payload": b"abc"}
    data = warc.record(row) + warc.record(row | {"record_id": "urn:page:2"})
    decoded = []
    real = warc._payload
    monkeypatch.setattr(warc, "_payload", lambda *a: decoded.append(1) or real(*a))
    reader = warc.WarcReader("", True)
    reader.wanted = {"record_id": {"urn:page:2"}}
    assert [r["record_id"] for r in reader.records(warc._Stream(io.BytesIO(data), False))] == ["urn:page:2"] and len(decoded) == 1
    import gzip

    packed = gzip.compress(data[: len(data) // 2]) + gzip.compress(data[len(data) // 2 :])
    assert len(list(reader.records(warc._Stream(io.BytesIO(packed), True)))) == 1


# language

TEXT = {"en": "the house and the river with that which was there", "fr": "la maison et le fleuve avec ce qui était là dans une", "de": "das Haus und der Fluss mit dem was nicht da war"}


def test_languages(spark):
    model = langid.fit_texts([(k, v) for k, v in TEXT.items()] * 3)
    page = lambda lang, body: f'<html lang="{lang}"><nav>the and that</nav><p>{body}</p></html>'
    rows = [(k, f"http://h{k % 2}.example.com/fr/{k}", page("fr", TEXT["fr"])) for k in range(20)]
    rows += [(30, "http://x.de/1", page("de", TEXT["de"])), (31, None, None), (32, "http://h0.example.com/fr/9", ""), (33, "no address", page("en", TEXT["en"])), (33, "no address", page("en", TEXT["en"]))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("clash")).withColumn("host", F.lit(1))
    got = defaultdict(list)
    for r in langid.identified(pages, model).collect():
        got[r["page_id"]].append((r["lang"], r["probability"], r["text_lang"]))
    assert all(got[k][0][0] == "fr" for k in range(20)) and got[30][0][0] == "de" and [x[0] for x in got[33]] == ["en", "en"]
    assert got[32][0][0] == "fr" and got[32][0][2] is None  # by the host's prior and the address alone
    assert 0 < got[31][0][1] <= 1
    assert langid.identified(pages.where("false"), model).count() == 0
    none = langid.identified(pages, langid.fit_texts([])).collect()
    assert len(none) == len(rows) and none[0]["lang"] is None


def test_late_declarations_are_found(spark):
    model = langid.fit_texts(list(TEXT.items()))
    late = f'<!-- {"x" * 25_000} -->\n<html class="a" lang = " FR-ca"><p>{TEXT["fr"]}</p></html>'
    rows = [(1, "http://a.com/", late), (2, "http://a.com/", f'<html>{"<p>" * 10_000}<HTML\nLANG=de>')]
    got = langid.identified(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect()
    assert {r["page_id"]: r["markup"] for r in got} == {1: "fr", 2: "de"}
    assert langid.declared("<html " * 200_000) == langid.declared(f"<html lang={' ' * 200_000}>") == langid.declared("<html>lang=en") == ""


def test_visible_text_takes_time_in_proportion():
    import time

    for page in ("<!--" * 250_000, "<script>" * 120_000, "<" * 1_000_000, "</nav " * 160_000, "<nav>" * 100_000 + "</nav>", "&a" * 500_000, "<script></script " * 60_000):
        began = time.time()
        langid.visible(page)
        assert time.time() - began < 1, page[:10]
    assert langid.visible("a<b>c</b>d<!-- <p>x</p> -->e<SCRIPT>f</script >g<nav>h<nav>i</nav>j&amp;k <l").split() == ["a", "c", "d", "e", "g", "j", "k", "<l"]
    assert langid.visible("x<!-- y <p>z").split() == ["x", "z"] and langid.visible("<navy>s</navy>").split() == ["s"]


def test_languages_equal_a_plain_fusion(spark):
    import math

    r = random.Random(3)
    model = langid.fit_texts(list(TEXT.items()))
    names = model.languages
    n = len(names)
    rows = []
    for k in range(60):
        lang = r.choice(names)
        words = r.choice((TEXT[lang], " ".join(r.sample(TEXT[lang].split(), 4)), ""))
        rows.append((k, r.choice((None, f"http://{r.choice('abc')}.{r.choice(('x', 'y'))}.{r.choice(('com', lang))}/{r.choice((lang, 'p'))}/{k}")), r.choice((f"<p>{words}</p>", f"<html lang='{r.choice((lang, 'xx'))}'>{words}"))))
    rows += [rows[0], (None, None, None)]
    softmax = lambda x: [math.exp(v - max(x)) / sum(math.exp(w - max(x)) for w in x) for v in x]
    pages = []
    for i, url, html in rows:
        host, domain, suffix, segment = langid.parts_of(url or "")
        pages.append({"id": i, "host": host, "domain": domain, "suffix": suffix, "segment": segment, "markup": langid.declared(html or ""), "text": list(model.log_likelihood(langid.visible(html or "")))})
    for p in pages:
        p["post"], p["said"] = softmax(p["text"]), p["text"]
    total = [sum(p["post"][k] for p in pages) for k in range(n)]
    for column in ("markup", "suffix", "segment"):
        for p in pages:
            if p[column]:
                seen = [sum(q["post"][k] for q in pages if q[column] == p[column]) for k in range(n)]
                p["said"] = [s + math.log((c + 0.5) / (t + 5)) for s, c, t in zip(p["said"], seen, total)]
    for p in pages:
        p["post"] = softmax(p["said"])
    wanted = Counter()
    for p in pages:
        prior = [1 / n] * n
        for same in ((), ("suffix",), ("domain", "suffix"), ("host", "domain", "suffix")):
            own = [max(sum(q["post"][k] for q in pages if all(q[c] == p[c] for c in same)) - p["post"][k], 0) for k in range(n)]
            prior = [(own[k] + 5 * prior[k]) / (sum(own) + 5) for k in range(n)]
        post = softmax([s + math.log(q) for s, q in zip(p["said"], prior)])
        wanted[(p["id"], names[post.index(max(post))], round(max(post), 6))] += 1
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert Counter((x["page_id"], x["lang"], round(x["probability"], 6)) for x in langid.identified(made, model).collect()) == wanted


def test_the_model_is_counted_in_executors(spark):
    rows = [(k, TEXT[x] + f" {k}", x) for k, x in enumerate(["en", "fr", "de"] * 5)] + [(None, "x", "en"), (99, None, "fr"), (98, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("at", F.lit(1)).withColumn("_x", F.lit(1))
    model = langid.fitted(docs.repartition(4))
    plain = langid.fit_texts([(x, t or "") for i, t, x in rows if i is not None and x])
    assert model.languages == plain.languages and (model.log_p == plain.log_p).all()
    assert langid.fitted(docs.where("false")).languages == ()


# pipeline


def test_pipeline_equals_plain_version(spark):
    import base64

    import tiktoken

    docs = table(spark, SF, "documents")
    model = quality.fitted(docs, table(spark, SF, "labels"))
    score = model.score
    rows = [tuple(r) for r in docs.collect()]
    rows = [r for r in rows if score(r[1] or "") >= PREDICTED_FROM]
    kept = {i for i, keep, *_ in brute.exact([r[:2] for r in rows]) if i == keep}
    rows = [r for r in rows if r[0] in kept]
    classes = brute.near([r[:2] for r in rows])
    rows = [r for r in rows if classes[r[0]] == r[0]]
    size = {r[0]: len(brute.WORD.findall(r[1] or "")) for r in rows}
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    target = brute.targets({s: sum(size[r[0]] for r in x) for s, x in by.items()})
    times = {}
    for s, x in by.items():
        budget, total, before = round(target[s]), sum(size[r[0]] for r in x), 0
        for r in sorted(x, key=lambda r: (hashlib.md5(f"17:{r[0]}".encode()).hexdigest()[:10], r[0])):
            n = size[r[0]]
            part = max(0, min(n, budget - budget // max(total, 1) * total - before))
            times[r[0]] = budget // max(total, 1) + (2 * part >= n) if n else 0
            before += n
    path, pattern = vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    wanted = Counter()
    for r in rows:
        if times[r[0]]:
            ids = known.encode_ordinary(r[1] or "")
            wanted[(r[0], r[3], len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(r[1] or ""))] += times[r[0]]
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == wanted


def test_stages_take_empty_tables(spark):
    empty = spark.createDataFrame([], brute.DOCUMENT).withColumn("score", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, SF).count() == 0, name
