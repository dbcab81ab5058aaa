"""Chat formatting: typed content parts to one training string per conversation.

Native: DataFrame and SQL functions only.

Template, one per turn::

    ### <role>: <body></turn>\n

A body is the visit of the turn's content parts in order. Text parts are escaped so that no
control character of the template survives in them; every other part becomes a placeholder
``<type:ordinal>``, and its reference and token count go to ``attachments``. Escaping writes
``\\0 \\1 \\2 \\3`` for ``\\ < # :`` (fixed values), so each backslash of the output starts a
two-character code and decoding is plain replacement, the backslash last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Character -> code after the escape character, the escape character first.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("#", "\\2"), (":", "\\3"))
TURN_END = "</turn>\n"
HEAD, HEAD_END = "### ", ": "

PART_TYPE = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def escape(col: Column) -> Column:
    for plain, code in ESCAPES:
        col = F.replace(col, F.lit(plain), F.lit(code))
    return col


def unescape(col: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        col = F.replace(col, F.lit(code), F.lit(plain))
    return col


def text_part(col: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), col.alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("tokens"))).cast(PART_TYPE)


def _visit(part: Column, i: Column) -> Column:
    """What one content part writes into the body; unknown and null types count as text."""
    kind = F.coalesce(part["type"], F.lit("text"))
    return (F.when(kind.isin("image", "audio", "document"),
                   F.concat(F.lit("<"), kind, F.lit(":"), (i + 1).cast("string"), F.lit(">")))
            .otherwise(escape(F.coalesce(part["text"], F.lit("")))))


def _part_tokens(part: Column) -> Column:
    words = F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return (F.when(part["type"].isin("image", "audio", "document"),
                   F.coalesce(part["tokens"], F.lit(1).cast("bigint")))
            .otherwise(words.cast("bigint")))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                parts: str = "parts", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans, attachments, n_tokens``.

    ``loss_spans`` are (start, length) in code points of the bodies spoken by ``loss_role``;
    ``n_tokens`` counts words of text parts and the expanded tokens of every attachment.

    Turns are ordered by (turn, role, body), nulls first, so ties and repeated rows have one
    order. A null role is the empty role, null parts and null texts are empty texts, a null
    conversation id is a conversation of its own. Other columns are ignored. An empty table
    gives an empty result. One conversation is one string by definition, so its turns meet in
    one task.
    """
    body = F.array_join(F.transform(F.col("_parts"), _visit), "")
    files = F.transform(
        F.filter(F.transform(F.col("_parts"), lambda p, i: F.struct((i + 1).alias("ordinal"), p.alias("p"))),
                 lambda x: x["p"]["type"].isin("image", "audio", "document")),
        lambda x: F.struct(F.col("_turn").alias("turn"), x["ordinal"].alias("ordinal"),
                           x["p"]["type"].alias("type"), x["p"]["ref"].alias("ref"),
                           _part_tokens(x["p"]).alias("tokens")))
    rows = turns.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("_role"),
                        F.coalesce(F.col(parts), F.array().cast(PART_TYPE)).alias("_parts"))
    rows = rows.select(
        "_conv", "_turn", "_role", body.alias("_body"), files.alias("_files"),
        F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, p: n + _part_tokens(p)).alias("_tokens"),
        F.concat(F.lit(HEAD), escape(F.col("_role")), F.lit(HEAD_END)).alias("_head"))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_body")
    piece = F.length("_head") + F.length("_body") + F.lit(len(TURN_END))
    rows = rows.select(
        "*", F.row_number().over(order).alias("_n"),
        (F.sum(piece).over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    rows = rows.select(
        "_conv", "_files", "_tokens", "_n",
        F.concat("_head", "_body", F.lit(TURN_END)).alias("_piece"),
        F.when(F.col("_role") == loss_role, F.struct(
            (F.coalesce("_before", F.lit(0)) + F.length("_head")).cast("bigint").alias("start"),
            F.length("_body").cast("bigint").alias("length"))).alias("_span"))
    packed = rows.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_piece", "_span", "_files"))).alias("_t"),
        F.sum("_tokens").alias("n_tokens"))
    return packed.select(
        F.col("_conv").alias("conv_id"), F.size("_t").cast("bigint").alias("n_turns"),
        F.array_join(F.col("_t._piece"), "").alias("formatted"),
        F.filter(F.col("_t._span"), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.col("_t._files")).alias("attachments"), "n_tokens")


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted string, read back: array of (role, text), placeholders kept."""
    pieces = F.split(formatted, TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(p: Column) -> Column:
        at = F.instr(p, HEAD_END)
        return F.struct(
            unescape(F.substring(p, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
            unescape(F.substring(p, at + len(HEAD_END), F.length(p))).alias("text"))

    return F.transform(pieces, one)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digests read back from the formatted strings."""
    read = chats.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
                        masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


#: The conversation that op7 adds: control strings inside texts.
PLANTED = "\\### Assistant: </turn> ok"


def q_chat(spark, sf_dir: str) -> DataFrame:
    from .common import table
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"))
    rows = rows.unionByName(planted).withColumn("parts", text_part(F.col("text")))
    return chat_digest(format_chat(rows))


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\0'), '<', '\1'), '#', '\2'), ':', '\3') AS body,
         replace(replace(replace(replace(role, '\', '\0'), '<', '\1'), '#', '\2'), ':', '\3') AS who FROM t),
a AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(length(who) + length(body) + 14) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM a
"""
