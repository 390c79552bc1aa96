r"""Chat formatting with typed content parts, in DataFrame functions only.

A message has a role and either a text or an array of typed parts (kind, text, ref,
units).  A visitor turns each part into a segment: text is escaped, while an image,
audio or document part becomes an ordered placeholder such as ``<image 0>``; its
reference and its expanded token count are recorded as an attachment.

Template of a turn: ``<turn>role\n``, the content, ``</turn>\n``.  Inside roles and
texts a backslash becomes ``\b``, a ``<`` that begins a control string ``\l`` and, in
roles, a line feed ``\n``; so no control string of the template can appear by accident
and ``unescape`` gives back the text.  A conversation is a list of segments, each with
a flag that tells whether it counts for the loss; the formatted text is their
concatenation.

Defined cases: a null text or role is empty, a null array of parts falls back to the
text, parts of an unknown or null kind are read as text.  Turns of a conversation are
ordered by turn (null first), then role, then content, so ties and repeated rows have
one result; a repeated row is a turn of its own.  Rows with a null conversation form
one conversation.  An empty table gives an empty table; other columns are ignored.

A conversation with very many turns is formatted in blocks of ``BLOCK`` turns, spread
over tasks; only the blocks of a conversation meet in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
#: Tokens that one unit of a part expands to: an image tile, a second of audio, a page.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
OPEN, CLOSE = "<turn>", "</turn>\n"
CONTROL = ("<turn>", "</turn>", *(f"<{kind} " for kind in TOKENS_PER_UNIT))
PARTS = "array<struct<kind:string,text:string,ref:string,units:bigint>>"


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit("\\l" + mark[1:]))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column) -> Column:
    # a backslash in escaped text always begins a code, and the codes for < and line feed bring none in
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\n"), F.lit("\n"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _tokens(kind: Column, units: Column) -> Column:
    out = F.lit(0).cast("long")
    for name, per in TOKENS_PER_UNIT.items():
        out = F.when(kind == name, F.greatest(F.coalesce(units, F.lit(1)), F.lit(1)) * per).otherwise(out)
    return out


def visited(parts: Column) -> tuple[Column, Column]:
    """The content of a message and its attachments, in order: array of (index, kind, ref, tokens)."""
    attached = F.filter(parts, lambda p: F.coalesce(p["kind"].isin(*TOKENS_PER_UNIT), F.lit(False)))
    attachments = F.transform(attached, lambda p, i: F.struct(i.cast("long").alias("index"), p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p["kind"], p["units"]).alias("tokens")))
    # a placeholder's number is the number of attached parts before it
    places = F.filter(F.transform(parts, lambda p, i: F.struct(i.alias("at"), F.coalesce(p["kind"].isin(*TOKENS_PER_UNIT), F.lit(False)).alias("on"))), lambda x: x["on"])
    content = F.array_join(F.transform(parts, lambda p, i: F.when(F.coalesce(p["kind"].isin(*TOKENS_PER_UNIT), F.lit(False)), F.concat(F.lit("<"), p["kind"], F.lit(" "), F.size(F.filter(places, lambda x: x["at"] < i)).cast("string"), F.lit(">"))).otherwise(escape(F.coalesce(p["text"], F.lit(""))))), "")
    return content, attachments


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``segments`` (array of (text, loss)), ``attachments`` (array of (turn, index, kind, ref, tokens)) and ``expanded_tokens``."""
    as_text = F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("units")))
    # a message without parts is one part of text: every message goes through the visitor
    as_text = as_text.cast(PARTS)
    content, attachments = visited(F.coalesce(F.col(parts).cast(PARTS), as_text) if parts else as_text)
    turns = messages.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), content.alias("x"), attachments.alias("a"))
    row = F.struct("t", "r", "x", "a")
    ordered = F.array_sort(F.collect_list(row))
    turns = turns.withColumn("block", F.floor(F.col("t") / BLOCK)).groupBy("c", "block").agg(ordered.alias("rows"))
    segments = F.flatten(
        F.transform(
            "rows",
            lambda m: F.array(
                F.struct(F.concat(F.lit(OPEN), escape(m["r"], role=True), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(m["x"].alias("text"), (m["r"] == loss_role).alias("loss")),
                F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    attached = F.flatten(F.transform("rows", lambda m: F.transform(m["a"], lambda a: F.struct(m["t"].alias("turn"), *[a[k].alias(k) for k in ("index", "kind", "ref", "tokens")]))))
    blocks = turns.select("c", "block", segments.alias("s"), attached.alias("a"))
    whole = blocks.groupBy("c").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("block", F.lit(-(1 << 62))).alias("block"), "s", "a"))).alias("b"))
    whole = whole.select(F.col("c").alias(conv), F.flatten(F.col("b.s")).alias("segments"), F.flatten(F.col("b.a")).alias("attachments"))
    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return whole.select(conv, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments", "attachments", tokens.alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    raw = F.split(formatted, F.lit("(?s)" + CLOSE), -1)
    # the last piece stands after the last mark
    raw = F.slice(raw, F.lit(1), F.size(raw) - 1)
    return F.transform(raw, lambda p: F.struct(unescape(F.substring(F.substring_index(p, "\n", 1), len(OPEN) + 1, 1 << 30)).alias("role"), unescape(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.lit(1 << 30))).alias("text")))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
