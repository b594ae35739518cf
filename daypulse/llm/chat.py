"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation is one formatted stream: every turn is a piece
``<|role|>`` newline, the escaped text, ``</s>`` newline.  Every assistant
turn is an example of its own: all preceding turns (the prefix), then that
reply (the target), of which only the reply's text is trainable.
:func:`expand` writes every example out in full, so its output grows with the
square of a conversation's turns; :func:`examples` only gives the examples'
places in the streams, which grow with the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What the template escapes, as (character, entity); the first is undone last.
TEXT_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("|", "&vb;"))
OPEN, SHUT, END = "<|", "|>\n", "</s>\n"


def escape(col: Column, pairs=TEXT_ESCAPES) -> Column:
    for raw, entity in pairs:
        col = F.replace(col, F.lit(raw), F.lit(entity))
    return col


def unescape(col: Column, pairs=TEXT_ESCAPES) -> Column:
    for raw, entity in reversed(pairs):
        col = F.replace(col, F.lit(entity), F.lit(raw))
    return col


def pieces(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, n (place from 1), piece, start and end in the stream, example, loss_start, loss_end.

    ``turns`` needs conv_id, turn, role and text; other columns are ignored.
    Turns are ordered by turn, role and text, nulls first, so repeated rows
    and ties have one defined order.  Null role and text count as empty; rows
    with a null conv_id are one conversation.  example numbers the trained
    turns from 1 and is null, like the loss offsets, for other turns.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(SHUT))
    own = (
        rows.withColumn("trained", F.col("role") == trained_role)
        .withColumn("head", head).withColumn("body", escape(F.col("text")))
        .withColumn("piece", F.concat("head", "body", F.lit(END)))
        .withColumn("n", F.row_number().over(order))
        .withColumn("end", F.sum(F.length("piece").cast("long")).over(so_far))
        .withColumn("example", F.sum(F.col("trained").cast("int")).over(so_far))
        .withColumn("start", F.col("end") - F.length("piece"))
    )
    at = F.col("start") + F.length("head")
    return own.select(
        "conv_id", "n", "piece", "start", "end",
        F.when(F.col("trained"), F.col("example")).alias("example"),
        F.when(F.col("trained"), at).alias("loss_start"),
        F.when(F.col("trained"), at + F.length("body")).alias("loss_end"),
    )


def examples(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per trained turn: conv_id, example, context_chars, loss_start, loss_end, chars.

    The example is the first ``chars`` characters of the conversation's
    stream, the first ``context_chars`` being all preceding turns; characters
    from loss_start to loss_end are trainable.
    """
    return examples_of(pieces(turns, trained_role))


def examples_of(formatted: DataFrame) -> DataFrame:
    """:func:`examples` of the pieces of conversations; no trained turns give no rows."""
    return formatted.where("example is not null").select(
        "conv_id", "example", F.col("start").alias("context_chars"), "loss_start", "loss_end", F.col("end").alias("chars")
    )


def expand(formatted: DataFrame) -> DataFrame:
    """Every example in full: conv_id, n, example, text, loss_start, loss_end, last; ``formatted`` holds :func:`pieces`.

    An example's text is all pieces before its reply in their order, then the
    reply.  Turns after a conversation's last reply are in no example: each
    comes as its own piece, with null example and loss offsets.  last marks a
    conversation's longest example, which holds the others.
    """
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy("n")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    replied = F.coalesce(F.max(F.when(F.col("example").isNotNull(), F.col("n"))).over(whole), F.lit(0))
    rows = formatted.withColumn("replied", replied).withColumn("turns", F.collect_list("piece").over(so_far))
    return rows.where("example is not null or n > replied").select(
        "conv_id", "n", "example", F.when(F.col("example").isNull(), F.col("piece")).otherwise(F.array_join("turns", "")).alias("text"),
        "loss_start", "loss_end", (F.col("n") == F.col("replied")).alias("last"),
    )


def materialise(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """The examples with their full text; its size grows with the square of a conversation's length."""
    found = expand(pieces(turns, trained_role)).where("example is not null")
    return found.select("conv_id", "example", "text", "loss_start", "loss_end")


def _in_order(column: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct("n", F.col(column).alias("x"))))
    return F.array_join(F.transform(rows, lambda r: r["x"]), "")


def read_back(expanded: DataFrame) -> DataFrame:
    """conv_id, n, chars, loss and stream of each row of :func:`expand`.

    chars counts the example's characters, loss is what its mask covers,
    unescaped; both are null outside examples.  stream is the text of a
    conversation's longest example and of the turns in none, else null.
    """
    masked = F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    own = F.col("example").isNotNull()
    return expanded.select(
        "conv_id", "n", F.when(own, F.length("text").cast("long")).alias("chars"), unescape(masked).alias("loss"),
        F.when(~own | F.col("last"), F.col("text")).alias("stream"),
    )


def turn_lines(stream: Column) -> Column:
    """The turns of a stream, each as its role and text with a line end after both."""

    def line(piece: Column) -> Column:
        head = F.substring_index(piece, SHUT, 1)
        role = unescape(F.substring(head, F.lit(len(OPEN) + 1), F.length(head)), ROLE_ESCAPES)
        text = unescape(F.substring(piece, F.length(head) + len(SHUT) + 1, F.length(piece)))
        return F.concat(role, F.lit("\n"), text, F.lit("\n"))

    parts = F.split(stream, END)  # what follows the last end is empty
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), line)


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation of :func:`pieces`, read back from its examples in full: turns and trained text as counts and SHA-256.

    The turns are those of the conversation's longest example and of the
    pieces in no example.  formatted_chars adds up the characters of all
    examples (context and reply).
    """
    rows = read_back(expand(formatted)).withColumn("loss", F.coalesce("loss", F.lit("")))
    found = rows.groupBy("conv_id").agg(
        turn_lines(_in_order("stream")).alias("lines"),
        F.sum(F.length("loss").cast("long")).alias("loss_chars"),
        F.sha2(_in_order("loss").cast("binary"), 256).alias("loss_sha256"),
        F.coalesce(F.sum("chars"), F.lit(0)).cast("long").alias("formatted_chars"),
    )
    return found.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("turns_sha256"),
        "loss_chars", "loss_sha256", "formatted_chars",
    )
