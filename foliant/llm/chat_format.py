"""Operator 3, chat formatting with typed content parts, in DataFrame functions only.

A message's content is a list of typed parts. A visitor turns the list into one
text: text parts stand as they are; each image, audio or document part becomes
a placeholder in its place, numbered by the part's place in the message
(``<|image:1|>``). The attachments (kind, reference, ordinal, part, expanded
token count) are recorded in order beside the text.

The template marks a turn as ``### role``, a line break, the text, ``</turn>``
and a line break. Inside roles and texts the three characters that markers are
made of are escaped (``\\`` as ``\\b``, ``#`` as ``\\h``, ``<`` as ``\\l``, and in
roles a line break as ``\\n``), so a text can neither open nor close a turn nor
forge a placeholder, and the output reads back exactly.

Defined results: a null text is empty; a null role is ``user``; a conversation's
rows are ordered by turn (null first), then role, then text before escaping;
repeated rows are turns each; a null conv_id is a conversation; extra columns
are ignored; an empty table gives no rows; texts of any length stay whole; an
unknown kind of part is kept as an attachment of no tokens. A conversation is
one output row, so it must fit a task; conversations are independent of each
other. Spans come from running sums, so a conversation's time grows with its
turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>\n"
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    part = F.named_struct(F.lit("type"), F.lit("text"), F.lit("text"), F.coalesce(text, F.lit("")), *[x for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")) for x in (F.lit(n), F.lit(None).cast(t))])
    return F.array(part).cast(PARTS)


def part_tokens(part: Column, patch: int = 28, audio_rate: float = 12.5, page_tokens: int = 512) -> Column:
    """Expanded tokens of an attachment: image patches, audio frames or document pages."""
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / F.lit(patch)) * F.ceil(F.coalesce(part["height"], F.lit(0)) / F.lit(patch))
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(audio_rate))
    document = F.coalesce(part["pages"], F.lit(0)) * F.lit(page_tokens)
    kind = part["type"]
    return F.when(kind == "image", image).when(kind == "audio", audio).when(kind == "document", document).otherwise(F.lit(0)).cast("long")


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def visit(parts: Column) -> dict[str, Column]:
    """The visitor over one message's parts: ``raw`` (its texts as they are), ``body`` (escaped text with placeholders) and ``attachments``."""
    parts = F.coalesce(parts, F.array().cast(PARTS))
    # a placeholder's "<" never occurs in escaped text
    placeholder = lambda p, i: F.concat(F.lit("<|"), escape(F.coalesce(p["type"], F.lit(""))), F.lit(":"), i.cast("string"), F.lit("|>"))
    raw = F.concat_ws("", F.transform(parts, lambda p: F.when(_is_text(p), F.coalesce(p["text"], F.lit(""))).otherwise(F.lit(""))))
    body = F.concat_ws("", F.transform(parts, lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder(p, i))))
    seen = F.transform(parts, lambda p, i: F.struct(_is_text(p).alias("is_text"), i.alias("part"), p["type"].alias("kind"), p["ref"].alias("ref"), part_tokens(p).alias("tokens")))
    attachments = F.transform(F.filter(seen, lambda p: ~p["is_text"]), lambda p, i: F.struct(i.alias("ordinal"), p["part"], p["kind"], p["ref"], p["tokens"]))
    return {"raw": raw, "body": body, "attachments": attachments}


def format_chat(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of messages (conv_id, turn, role, content: PARTS).

    formatted: the text; spans: (start, length) in code points of the text under
    the loss mask, one for each message of ``loss_roles``; attachments with the
    turn's index; n_turns; attachment_tokens.
    """
    seen = visit(F.col("content"))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), *[c.alias(k) for k, c in seen.items()])
    rows = rows.withColumn("piece", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"), "body", F.lit(CLOSE)))
    # the order of turns, by a window and an aggregation over the same exchange
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "raw", "body").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0).cast("long")))
    one = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "role", "body", "piece", "attachments"))).alias("t"))
    start = lambda t: t["at"] + F.char_length(F.lit(OPEN)) + F.char_length(escape_role(t["role"])) + 1
    spans = F.transform(F.filter("t", lambda t: t["role"].isin(*loss_roles)), lambda t: F.struct(start(t).cast("long").alias("start"), F.char_length(t["body"]).cast("long").alias("length")))
    refs = F.flatten(F.transform("t", lambda t, i: F.transform(t["attachments"], lambda a: F.struct(i.alias("message"), a["ordinal"].alias("ordinal"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return one.select(
        "conv_id",
        F.concat_ws("", F.transform("t", lambda t: t["piece"])).alias("formatted"),
        spans.alias("spans"),
        refs.alias("attachments"),
        F.size("t").cast("long").alias("n_turns"),
        F.aggregate(refs, F.lit(0).cast("long"), lambda acc, a: acc + a["tokens"]).alias("attachment_tokens"),
    )


def parse_chat(formatted: Column) -> Column:
    """array<struct<role, text>> read back from the formatted text (placeholders stay as written)."""
    turns = F.split(formatted, CLOSE, -1)
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))

    def read(piece: Column) -> Column:
        rest = F.substr(piece, F.lit(len(OPEN) + 1))
        line = F.substring_index(rest, "\n", 1)
        return F.struct(unescape_role(line).alias("role"), unescape(F.substr(rest, F.char_length(line) + 2)).alias("text"))

    return F.transform(turns, read)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))))
