"""The thin queries over the standard tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact, langid, mixing, near, quality, rules, secrets, warc
from .common import fresh_path, table, text_of, written

HEX = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
PREDICTED_FROM = 0.3


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the public vocabulary that is encoded with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    made = chat.format_chats(rows.unionByName(more)).withColumn("t", chat.read_turns(F.col("formatted"))).withColumn("l", chat.loss_text(F.col("segments")))
    turns = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        HEX(turns).alias("turns_sha256"),
        F.length("l").cast("long").alias("loss_chars"),
        HEX(F.col("l")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    rows = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    rows = rows.select("doc_id", "n_tokens", "ids")
    rows = bpe.decode(rows, path, pattern)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, as a history grows: the second scan is of all rows, and takes only the blobs that the first hasn't seen."""
    versions = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, fresh_path(spark, "secrets"))
    ledger.scan(versions.where(F.coalesce(F.xxhash64("doc_id") < 0, F.lit(False))), path="doc_id", content="text")
    ledger.scan(versions, path="doc_id", content="text")
    rows = ledger.joined_back(versions, path="doc_id", content="text")
    base = [r.kind for r in secrets.BASE]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    return rows.select(
        F.col("path").alias("doc_id"),
        *[count(k).alias(f"n_{k}") for k in base],
        HEX(listed(F.filter("spans", lambda s: s["kind"].isin(*base)))).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the words are counted here, once; the mix reads the numbers
    without_id = F.when(F.col("doc_id").isNull(), F.md5(F.encode(text_of(), "UTF-8"))).alias("without_id")
    rows = written(table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("n"), without_id))
    return mixing.mix(rows, F.col("n"), without_id=F.col("without_id")).select("doc_id", "size", "source_size", "target", "taken")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(rules.statistics(table(spark, sf_dir, "documents")))
    learned = rules.fitted(stats, table(spark, sf_dir, "labels"))
    return rules.judged(stats, learned).select("doc_id", *rules.COUNTS, "base_failed", "kept", "rule")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fitted(documents, table(spark, sf_dir, "labels"))
    rows = quality.scored(documents, model)
    return rows.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_warc(warc.archived(table(spark, sf_dir, "pages")), path)
    rows = warc.read_warc(spark, path)
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")
    return rows.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fitted(table(spark, sf_dir, "documents"))
    return langid.identified(table(spark, sf_dir, "pages"), model)


def queries() -> dict:
    import corpus_pipeline

    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return found | {"pipeline": corpus_pipeline.run}


_ESCAPED = "replace(replace(replace(replace(replace(replace({}, '\\', '\\b'), '<turn>', '\\lturn>'), '</turn>', '\\l/turn>'), '<image ', '\\limage '), '<audio ', '\\laudio '), '<document ', '\\ldocument ')"

OP1_SQL = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    cast(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    cast(sum(15 + length(replace({_ESCAPED.format('role')}, chr(10), '\\n')) + length({_ESCAPED.format('text')})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

OP4_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 10))::BIGINT AS key
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighed AS (
    SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight, source_size * 2.0::DOUBLE AS most FROM sizes
), filled AS (
    SELECT *, most / weight AS ratio,
        coalesce(sum(most) OVER b, 0.0::DOUBLE) AS taken_before,
        sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE) AS open_weight,
        sum(source_size) OVER () AS everything
    FROM weighed WINDOW b AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT *, (1.5::DOUBLE * everything - taken_before) / open_weight AS level FROM filled
), targets AS (
    SELECT source, source_size, weight, most,
        coalesce(least(most, (SELECT arg_min(level, ratio) FROM levels WHERE level * weight < most) * weight), most) AS target
    FROM levels
), placed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), epochs AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS e FROM placed
)
SELECT doc_id, size, source_size, target,
    (e * size + greatest(0, least(size, budget - e * source_size - before)))::BIGINT AS taken
FROM epochs
"""

OP5_SQL = r"""
WITH rows AS (
    SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), owned AS (
    SELECT doc_id, text_sha256,
        first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM rows
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM owned
"""

_B32 = "to_base(('0x' || substr(h, {}, 10))::BIGINT, 32, 8)"
OP9_SQL = f"""
WITH rows AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), owned AS (
    SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM rows
)
SELECT page_id, payload_bytes,
    translate({' || '.join(_B32.format(k) for k in (1, 11, 21, 31))}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
    CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM owned
"""


# Fixed values: (kind, pattern, group, least length of the group, whether the group alone is the finding), written out here
# so that a wrong pattern of the operator shows.
_SECRET_RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, False),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, False),
    ("hex", r"[0-9a-f]+", 0, 16, False),
    ("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1, False),
    ("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", 1, 24, True),
)


def _secret_sql(ord: int, kind: str, pattern: str, group: int, least: int, tail: bool) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    lengths = lambda x: f"list_transform({x}, lambda x: length(x))"
    return f"SELECT doc_id, {ord} AS ord, '{kind}' AS kind, {least} AS least, {tail} AS tail, {lengths(f'regexp_split_to_array(t, {p})')} AS g, {lengths(f'regexp_extract_all(t, {p}, 0)')} AS l, {lengths(f'regexp_extract_all(t, {p}, {group})')} AS k FROM docs"


OP3_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matched AS ({' UNION ALL '.join(_secret_sql(k, *r) for k, r in enumerate(_SECRET_RULES))}),
each AS (SELECT doc_id, ord, kind, least, tail, unnest(g[1:len(l)]) AS gap, unnest(l) AS n, unnest(k) AS kept, generate_subscripts(l, 1) AS pos FROM matched WHERE len(l) > 0),
placed AS (SELECT *, (e - CASE WHEN tail THEN kept ELSE n END)::BIGINT AS b FROM (SELECT *, sum(gap + n) OVER (PARTITION BY doc_id, ord ORDER BY pos)::BIGINT AS e FROM each)),
spans AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord) FILTER (ord < 3) AS base,
        string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, ord) AS spans
    FROM placed WHERE kept >= least GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN spans USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    found = {"op1_chat_format": OP1_SQL, "op3_secret_scan": OP3_SQL, "op4_mix_sources": OP4_SQL, "op5_exact_dedup": OP5_SQL, "op9_warc": OP9_SQL}
    import corpus_pipeline

    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
