"""Chat formatting with typed content parts (native).

A turn's content is a list of parts: text, image, audio or document.  The visitor goes through them in order and
writes texts, escaped, and a placeholder for each attachment; the attachment's reference and the number of tokens its
placeholder stands for are recorded beside the text.  Turns are marked by control strings.  Inside texts and roles
every backslash is doubled and the start of a control string is broken up by a backslash, so no text can forge a mark
and ``unescape`` restores it exactly.

Defined results: a null text, role or list of parts is empty; turns follow their number, nulls first, ties by role and
then by content; equal rows are turns of their own; a null conv_id is a conversation of its own; a part of an unknown
kind counts as text; null units are 1; an empty table gives an empty result; other columns are not looked at.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import let

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: Tokens that one unit of an attachment expands to: an image tile, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}
PARTS = "array<struct<type: string, text: string, ref: string, units: long>>"
MASKED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """A list of parts with only this text."""
    null = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), null.alias("ref"), null.alias("units"))
    return F.array(part).cast(PARTS)


def placeholder(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def _attached(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))


def visit(parts: Column) -> Column:
    """Struct ``body, attachments``: the flattened text, and per attachment its kind, reference and expanded tokens."""
    per_unit = F.create_map(*[F.lit(x) for pair in TOKENS_PER_UNIT.items() for x in pair])

    def flat(part):
        return F.when(_attached(part), placeholder(part["type"])).otherwise(escape(part["text"]))

    def record(part):
        tokens = per_unit[part["type"]] * F.coalesce(part["units"], F.lit(1))
        return F.struct(part["type"].alias("kind"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens"))

    def walk(p):
        body = F.array_join(F.transform(p, flat), "")
        return F.struct(body.alias("body"), F.transform(F.filter(p, _attached), record).alias("attachments"))

    return let(F.coalesce(parts, F.array().cast(PARTS)), walk)


def _spans(turns: Column) -> Column:
    """``start, length`` of the masked bodies, in code points from 0."""
    fixed = len(TURN) + len(BODY)

    def step(acc, turn):
        start = acc["at"] + fixed + F.length(turn["role"])
        size = F.length(turn["body"])
        span = F.struct(start.cast("long").alias("start"), size.cast("long").alias("length"))
        spans = F.when(turn["masked"], F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct((start + size + len(END)).cast("long").alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: long, length: long>>").alias("spans"))
    return F.aggregate(turns, start, step)["spans"]


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans, attachments, expanded_tokens`` from rows of ``conv_id, turn, role, parts``.

    ``loss_spans`` are the parts of ``formatted`` that a model learns from: the bodies of the assistant's turns.
    """
    visited = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("v"))
    turn = F.struct(
        "turn",
        escape(F.col("role")).alias("role"),
        F.col("v.body").alias("body"),
        (F.col("role") == MASKED_ROLE).alias("masked"),
        F.col("v.attachments").alias("attachments"),
    )
    grouped = visited.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(TURN), t["role"], F.lit(BODY), t["body"], F.lit(END)))
    attachments = F.flatten(F.transform("turns", lambda t: t["attachments"]))
    spans = F.filter(_spans(F.col("turns")), lambda s: s["length"] > 0)
    formatted = grouped.select(
        "conv_id", F.array_join(written, "").alias("formatted"), spans.alias("loss_spans"), attachments.alias("attachments")
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"])
    return formatted.withColumn("expanded_tokens", total)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role, text``."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def turn(piece):
        halves = F.split(F.substr(piece, F.lit(len(TURN) + 1)), r"<\|body\|>")
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))
    return F.array_join(cut, "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations."""
    read = formatted.withColumn("_turns", read_turns(F.col("formatted"))).withColumn(
        "_loss", masked_text(F.col("formatted"), F.col("loss_spans"))
    )
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "expanded_tokens",
    )


#: ``digests`` over the table ``conversations`` and the conversation -7.
ORACLE = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
escaped AS (
    SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') AS erole,
           replace(replace(text, '\', '\\'), '<|', '<\|') AS etext
    FROM turns),
told AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, erole, etext) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, erole, etext) FILTER (role = 'assistant'), '') AS loss,
           CAST(sum(23 + length(erole) + length(etext)) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM told
"""
