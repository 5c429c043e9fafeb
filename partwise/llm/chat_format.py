"""Chat formatting with typed content parts, in DataFrame functions only.

A message body is a list of parts, each a struct of type (text, image, audio, document), text, ref and units. A
visitor flattens it: text is escaped, any other part becomes a numbered placeholder, its reference is recorded, and the
tokens that the placeholder expands to are counted. Turns are marked by control strings `<|name|>`; in texts and roles a
backslash is doubled and `<|` becomes `<\\|`, so no control string can occur in them, and unescaping gives them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of one unit of an attachment: a patch of an image, a frame of audio, a page of a document. A unit of any other type is one token.
UNIT_TOKENS = {"image": 1, "audio": 1, "document": 256}
PART = "struct<type:string,text:string,ref:string,units:int>"
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A body that is one text; null is an empty text."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units"))).cast(f"array<{PART}>")


def _attached(parts: Column) -> Column:
    return F.filter(parts, lambda p: p["type"] != "text")


def flattened(parts: Column, unit_tokens: dict[str, int] | None = None) -> Column:
    """struct(body, attachments array<struct(place, type, ref, tokens)>, media_tokens) of an array of parts.

    A part of a null type is a text; a null part is nothing. In a placeholder a type has its letters, digits, `.`, `-`
    and `_`, and `_` for anything else, so no type can close it; attachments have the type as it is. Units below 0 or
    null count as none.
    """
    tokens = F.create_map(*[F.lit(x) for pair in (UNIT_TOKENS if unit_tokens is None else unit_tokens or {"": 1}).items() for x in pair])
    whole = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    parts = F.transform(whole, lambda p: F.struct(F.coalesce(p["type"], F.lit("text")).alias("type"), p["text"].alias("text"), p["ref"].alias("ref"), p["units"].alias("units")))
    visit = F.transform(parts, lambda p, i: F.when(p["type"] == "text", escaped(p["text"])).otherwise(F.concat(F.lit("<|"), F.regexp_replace(p["type"], r"[^\p{L}\p{N}._-]", "_"), F.lit(":"), F.size(_attached(F.slice(parts, F.lit(1), i))).cast("string"), F.lit("|>"))))
    count = lambda p: F.greatest(F.coalesce(p["units"], F.lit(0)), F.lit(0)).cast("long") * F.coalesce(F.element_at(tokens, p["type"]), F.lit(1)).cast("long")
    media = F.transform(_attached(parts), lambda p, i: F.struct(i.alias("place"), p["type"].alias("type"), p["ref"].alias("ref"), count(p).alias("tokens")))
    return F.struct(F.array_join(visit, "").alias("body"), media.alias("attachments"), F.aggregate(media, F.lit(0).cast("long"), lambda n, m: n + m["tokens"]).alias("media_tokens"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id from rows (conv_id, turn, role, parts): formatted, loss_spans, attachments, media_tokens.

    Turns stand in the order of turn, nulls first, equal ones by role and content. loss_spans are (start, length) in code
    points of every assistant body. A null role or body is empty; rows of a null conv_id are a conversation; an empty
    table gives an empty result. Other columns are ignored.
    """
    flat = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), flattened(F.col("parts")).alias("flat"))
    piece = flat.select("conv_id", "turn", "role", "flat.*", F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)).alias("head"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    ranked = piece.withColumn("place", F.row_number().over(order))
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("start", F.coalesce(F.sum(F.length("head") + F.length("body") + F.lit(len(END))).over(so_far), F.lit(0)) + F.length("head"))
    row = F.struct("place", "role", F.concat("head", "body", F.lit(END)).alias("piece"), "start", F.length("body").alias("length"), "attachments", "media_tokens")
    rows = ranked.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["role"] == "assistant"), lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("rows", lambda r: F.transform(r["attachments"], lambda a: F.struct(r["place"].alias("turn"), a["place"].alias("place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))).alias("attachments"),
        F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + r["media_tokens"]).alias("media_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns array<struct(role, text)> and the loss_text that formatted rows hold, unescaped."""
    cut = F.transform(F.slice(F.split("formatted", r"<\|turn\|>"), 2, 1 << 30), lambda t: F.split(t, r"<\|body\|>"))
    turns = F.transform(cut, lambda t: F.struct(unescaped(t[0]).alias("role"), unescaped(F.regexp_replace(t[1], r"<\|end\|>$", "")).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"]))), "")
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what read_back finds."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(8 + 8 + 7 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
