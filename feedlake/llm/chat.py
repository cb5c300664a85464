r"""Chat formatting with typed content parts, as DataFrame expressions.

A message is (conv_id, turn, role, content); content is an array of parts
``struct<type: string, text: string, ref: string, units: double>``.  A visitor
maps each part, in order, to a piece of the formatted text: text parts are
escaped and copied, image, audio and document parts become numbered
placeholders, and each placeholder adds an attachment record (its reference and
the number of model tokens it expands to).

    <|turn|>role\\n ...parts... <|end|>\\n

Escaping is reversible: a backslash is doubled, then a bar gets a backslash
before it; in roles a line feed becomes backslash n.  So ``<|`` in the output is
always the template's own, also where the pieces of two parts meet, and
read_back() restores the messages exactly.

One conversation becomes one value, so a conversation must fit a task; nothing
else is gathered.

Defined cases: null text is empty; a null role is the empty role; null or empty
content is an empty message; parts of an unknown or null type count as text;
null units count as 0, and tokens are rounded up; turns are ordered by (turn,
role, formatted body) with nulls first, so ties and repeated rows have one
order; a null conv_id is a conversation of its own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Start of every control string of the template; escaped text never holds it.
MARK = "<|"
#: Model tokens for one unit: an image tile, a second of audio, a document page.
TOKENS_PER_UNIT = {"image": 256.0, "audio": 25.0, "document": 768.0}
#: Roles whose text is under the loss mask.
LOSS_ROLES = ("assistant",)

#: Code points of a block of cut().
BLOCK = 1024

PART = "struct<type: string, text: string, ref: string, units: double>"


def text_part(text: Column) -> Column:
    """Content that consists of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("double").alias("units"))).cast(f"array<{PART}>")


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("|"), F.lit("\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\|"), F.lit("|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # Pieces between doubled backslashes hold the single-backslash forms only.
    pieces = F.transform(F.split(role, r"\\\\", -1),
                         lambda p: F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n")))
    return F.array_join(pieces, "\\")


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin(*TOKENS_PER_UNIT), F.lit(False))


def tokens(part: Column) -> Column:
    """Model tokens that an attachment expands to."""
    rate = F.lit(0.0)
    for kind, each in TOKENS_PER_UNIT.items():
        rate = F.when(part["type"] == kind, F.lit(each)).otherwise(rate)
    return F.ceil(rate * F.coalesce(part["units"], F.lit(0.0))).cast("long")


def visit(content: Column) -> tuple[Column, Column]:
    """(body, attachments) of a message: the parts' text in order, and a record for each attachment.

    Each attachment first becomes the bare mark ``<|``, which no escaped text
    holds, also where two parts meet.  The text is then cut at the marks and the
    numbered placeholders are put between the pieces, so the cost is linear in
    the number of parts.
    """
    parts = F.filter(F.coalesce(content, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    marked = F.array_join(F.transform(parts, lambda p: F.when(is_attachment(p), F.lit(MARK)).otherwise(escape(p["text"]))), "")
    found = F.transform(F.filter(parts, is_attachment), lambda p, i: F.struct(
        F.concat(F.lit("<|"), p["type"], F.lit(":"), (i + 1).cast("string"), F.lit("|>")).alias("placeholder"),
        p["type"].alias("type"), p["ref"].alias("ref"), tokens(p).alias("tokens")))
    return marked, found


def placed(marked: Column, found: Column) -> Column:
    """The marks of visit() replaced by the placeholders, in order."""
    holders = F.concat(F.array(F.lit("")), F.transform(found, lambda a: a["placeholder"]))
    return F.array_join(F.zip_with(holders, F.split(marked, r"<\|", -1), lambda h, s: F.concat(h, s)), "")


def format_chat(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: conv_id, formatted, attachments, expanded_tokens, loss_spans.

    ``attachments`` is in order of appearance; ``turn_index`` counts a conversation's
    messages from 0.  ``loss_spans`` are (start, end) code points in ``formatted``, end
    exclusive, of the bodies of messages whose role is under the loss mask.
    """
    marked, found = visit(F.col("content"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), marked.alias("marked"), found.alias("attachments"))
    rows = rows.select("conv_id", "turn", "role", placed(F.col("marked"), F.col("attachments")).alias("body"), "attachments")
    rows = rows.withColumn("head", F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("head_chars", F.char_length("head")).withColumn("body_chars", F.char_length("body"))
    # Offsets and message numbers are running sums over the conversation's rows, so their cost is linear.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("head_chars") + F.col("body_chars") + len(END) + 1
    rows = rows.select(
        "conv_id", (F.row_number().over(order) - 1).alias("i"), "role",
        F.concat("head", "body", F.lit(END + "\n")).alias("piece"), "attachments",
        (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.col("head_chars")).alias("start"), "body_chars")
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("i", "role", "piece", "attachments", "start", "body_chars"))).alias("ms"))
    conv = conv.withColumn("formatted", F.array_join(F.transform("ms", lambda m: m["piece"]), ""))
    spans = F.transform(F.filter("ms", lambda m: m["role"].isin(*loss_roles)),
                        lambda m: F.struct(m["start"].alias("start"), (m["start"] + m["body_chars"]).alias("end")))
    found = F.flatten(F.transform("ms", lambda m: F.transform(m["attachments"], lambda a: F.struct(
        m["i"].alias("turn_index"), a["placeholder"].alias("placeholder"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return conv.select("conv_id", "formatted", found.alias("attachments"),
                       F.aggregate(found, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
                       spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The messages of a formatted conversation: array of (role, text), unescaped.

    Placeholders stay in the text as they are.
    """
    pieces = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape_role(F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text")))


def cut(formatted: Column, spans: Column) -> Column:
    """The text of each (start, end) span of code points, in order.

    Texts are found from their start, so the formatted text is first cut into
    blocks; a span reads the blocks it lies in, and the cost is linear.
    """
    blocks = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def one(blocks: Column, s: Column) -> Column:
        first = F.floor(s["start"] / BLOCK).cast("int")
        several = F.slice(blocks, first + 1, F.floor(s["end"] / BLOCK).cast("int") - first + 1)
        return F.substr(F.array_join(several, ""), (s["start"] % BLOCK + 1).cast("int"), (s["end"] - s["start"]).cast("int"))

    # The array of one value binds the blocks once for all spans.
    return F.flatten(F.transform(F.array(blocks), lambda b: F.transform(spans, lambda s: one(b, s))))


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, cut from the formatted text, unescaped and joined without anything between."""
    return unescape(F.array_join(cut(formatted, loss_spans), ""))
