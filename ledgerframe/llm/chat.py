r"""Chat formatting by a grammar round trip.

Grammar of a rendered conversation (a deterministic, one-pass parser reads it)::

    conversation := turn*
    turn         := "### " label ": " body "</turn>" "\n"
    label        := "System" | "User" | "Assistant" | "Tool" | "@" hex
    body         := text in which "\x" stands for the character x, and which
                    holds neither "###" nor "</turn>"

``label`` "@" + hex writes any other role by its UTF-8 bytes.  A text is first
rendered as it is and read back; where the recovered text differs from the
source, or the rendered turn breaks the grammar, the text is escaped (backslash
doubled, ``\###``, ``<\/turn>``) and checked again.  The whole conversation is
then parsed once more and compared to its source turns; a difference left after
that raises an error instead of giving a wrong row.

Only DataFrame functions are used.  Texts are escaped and measured before the
one shuffle, on the conversation; offsets come from a window on the same
partitioning.  A conversation is one row of the result, so its turns meet in one
task by definition; every step on it is linear in its length.

Defined cases: NULL role or text counts as empty; turns sort by (turn, role,
text), NULL turns first; rows with a NULL conv_id form one conversation;
repeated rows are repeated turns; an empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, text_or_empty

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Roles with a plain label; the parser reads the label back to the role.
LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("###"), F.lit("\\###"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def role_label(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    return F.coalesce(F.element_at(known, role), F.concat(F.lit("@"), F.hex(F.encode(role, "UTF-8"))))


def label_role(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for k, v in LABELS.items() for x in (v, k)])
    return F.coalesce(F.element_at(known, label),
                      F.decode(F.unhex(F.substring(label, 2, 2 ** 31 - 1)), "UTF-8"))


def body_of(text: Column) -> Column:
    """The text as it is if it reads back identically, else escaped."""
    breaks = F.contains(text, F.lit("###")) | F.contains(text, F.lit("</turn>"))
    identical = ~breaks & (unescaped(text) == text)
    return F.when(identical, text).otherwise(escaped(text))


def parse(rendered: Column) -> Column:
    """array<struct<role, text, label_chars, body_chars>> read from a rendered
    conversation, in order."""
    pieces = F.split(rendered, CLOSE, -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        label = F.substring_index(F.substring(piece, len(OPEN) + 1, 2 ** 31 - 1), COLON, 1)
        head = F.lit(len(OPEN) + len(COLON)) + F.char_length(label)
        body = F.substring(piece, head + 1, F.lit(2 ** 31 - 1))
        return F.struct(label_role(label).alias("role"), unescaped(body).alias("text"),
                        head.alias("head_chars"), F.char_length(body).alias("body_chars"))

    return F.transform(turns, turn)


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text",
                loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, text (rendered) and spans, an
    array<struct<turn_start, start, end, loss>> with the place of each turn and
    of its body in ``text`` (code points, end exclusive) and whether the body is
    under the loss mask."""
    rows = turns.select(col(conv_col).alias("conv_id"), col(turn_col).alias("turn"),
                        text_or_empty(role_col).alias("role"),
                        text_or_empty(text_col).alias("source"))
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), role_label(F.col("role")), F.lit(COLON))) \
        .withColumn("body", body_of(F.col("source")))
    rows = rows.withColumn("chars", (F.char_length("head") + F.char_length("body")
                                     + len(CLOSE)).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "source")
    rows = rows.select(
        "conv_id", "role", "source", "head", "body",
        F.row_number().over(order).alias("place"),
        (F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, 0))
         - F.col("chars")).alias("turn_start"))
    start = F.col("turn_start") + F.char_length("head")
    turn = F.struct(
        F.col("place"), F.col("role"), F.col("source"),
        F.concat("head", "body", F.lit(CLOSE)).alias("rendered"),
        F.struct("turn_start", start.alias("start"),
                 (start + F.char_length("body")).alias("end"),
                 F.col("role").isin(*loss_roles).alias("loss")).alias("span"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.select(
        "conv_id", F.col("turns.span").alias("spans"),
        F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.source.alias("text")))
        .alias("source"),
        F.concat_ws("", F.col("turns.rendered")).alias("text"))
    recovered = F.transform(parse(F.col("text")),
                            lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    return convs.select(
        "conv_id",
        F.when(recovered == F.col("source"), F.col("text")).otherwise(F.raise_error(F.concat(
            F.lit("round trip failed for conversation "), F.col("conv_id").cast("string"))))
        .alias("text"), "spans")


def masked_text(text: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask: each masked body once, in order."""
    pieces = F.split(text, CLOSE, -1)
    bodies = F.zip_with(
        F.slice(pieces, 1, F.size(spans)), spans,
        lambda piece, s: F.when(s.loss, unescaped(F.substring(
            piece, (s.start - s.turn_start + 1).cast("int"), (s.end - s.start).cast("int")))))
    return F.concat_ws("", F.filter(bodies, lambda b: b.isNotNull()))


def chat_report(formatted: DataFrame) -> DataFrame:
    """Digest columns read back from the output of :func:`format_chat`."""
    read = formatted.select("conv_id", "text", parse(F.col("text")).alias("turns"),
                            masked_text(F.col("text"), F.col("spans")).alias("loss"))
    flat = F.concat_ws("", F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("text").cast("long").alias("formatted_chars"))
