"""Chat formatting: turns to one string with a loss mask, in Spark expressions only.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn; adjacent turns of one
role share the marks, with ``<|im_sep|>`` between their texts.  Control strings
inside a text are escaped by one more backslash between ``<`` and ``|`` (``<|`` becomes ``<\\|``,
``<\\|`` becomes ``<\\\\|``), so no text can hold a mark and ``parse`` gets every turn back.
The loss mask is a list of spans, one for each assistant text; marks and
separators are outside it.

Turns are ordered by (turn, role, text), null turns first; a null role counts as an empty one, a null
text as an empty text; repeated rows are turns of their own; rows with a null
conversation id form one conversation; extra columns are ignored; an empty table
gives an empty result.  A conversation is one row, however long; work grows with its turns, not with their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN_BLOCK = 256
START, END, SEP = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _header(role: Column) -> Column:
    """A role as one line."""
    return escape(F.replace(F.replace(role, F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1")))


def _role(header: Column) -> Column:
    return F.replace(F.replace(unescape(header), F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))


def turn_starts(turns: Column) -> Column:
    """The places in sorted turns at which another role begins."""
    return F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))


def merge_turns(turns: Column, starts: Column) -> Column:
    """Sorted turns to array<role, texts>: adjacent turns of one role become one.  Both are columns of the frame, not expressions: each is looked up for every start."""
    n = F.size(turns)
    return F.transform(
        starts,
        lambda s, k: F.struct(
            F.get(turns, s)["role"].alias("role"),
            F.transform(F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), n) - s), lambda t: t["text"]).alias("texts"),
        ),
    )


def _pieces(merged: Column, loss_role: str) -> Column:
    """Every text with what stands before and after it."""
    return F.flatten(
        F.transform(
            merged,
            lambda m: F.transform(
                m["texts"],
                lambda x, j: F.struct(
                    F.when(j == 0, F.concat(F.lit(START), _header(m["role"]), F.lit("\n"))).otherwise(F.lit(SEP)).alias("head"),
                    escape(x).alias("body"),
                    F.when(j == F.size(m["texts"]) - 1, F.lit(END)).otherwise(F.lit("")).alias("tail"),
                    (m["role"] == loss_role).alias("loss"),
                ),
            ),
        )
    )


def format_conversations(frame: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): one row a conversation, one shuffle."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    grouped = frame.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    placed = grouped.withColumn("starts", turn_starts(F.col("turns")))
    pieces = placed.select("conv_id", _pieces(merge_turns(F.col("turns"), F.col("starts")), loss_role).alias("pieces"))
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    # places by sums over blocks of pieces, then within each block: no list of all spans is copied for every turn
    narrow = F.transform("pieces", lambda p: F.struct(F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), F.length(p["tail"]).alias("tail"), p["loss"].alias("loss")))
    sized = pieces.select("conv_id", formatted.alias("formatted"), narrow.alias("sizes"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / SPAN_BLOCK).cast("int")), lambda k: F.slice("sizes", k * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))
    sized = sized.withColumn("blocks", cut)
    whole = lambda p: p["head"] + p["body"] + p["tail"]
    sized = sized.withColumn("lengths", F.transform("blocks", lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + whole(p))))
    starts = F.aggregate("lengths", F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    sized = sized.withColumn("starts", starts)
    none = F.array().cast("array<struct<start:int,length:int>>")

    def spans(block: Column, k: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(F.get("starts", k).alias("at"), none.alias("spans")),
            lambda acc, p: F.struct(
                (acc["at"] + whole(p)).alias("at"),
                F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["head"]).alias("start"), p["body"].alias("length"))))).otherwise(acc["spans"]).alias("spans"),
            ),
            lambda acc: acc["spans"],
        )

    return sized.select("conv_id", "formatted", F.flatten(F.transform("blocks", spans)).alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns in a formatted string, as array<role, text>."""

    def turn(segment: Column) -> Column:
        header = F.substring_index(segment, "\n", 1)
        body = F.substring(segment, F.length(header) + 2, F.length(segment) - F.length(header) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda x: F.struct(_role(header).alias("role"), unescape(x).alias("text")))

    segments = F.split(formatted, r"<\|im_start\|>")
    return F.flatten(F.transform(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), turn))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped.  A block of spans takes its stretch of the string once and finds its spans in that, since a place in a string is walked to from its front."""
    last = F.floor((F.size(spans) - 1) / SPAN_BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(spans, k * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))

    def cut(block: Column) -> Column:
        first, end = F.element_at(block, 1)["start"], F.element_at(block, -1)["start"] + F.element_at(block, -1)["length"]
        return F.struct(block.alias("spans"), first.alias("at"), F.substring(formatted, first + 1, end - first).alias("text"))

    text = lambda b: F.array_join(F.transform(b["spans"], lambda s: unescape(F.substring(b["text"], s["start"] - b["at"] + 1, s["length"]))), "")
    return F.when(F.size(spans) > 0, F.array_join(F.transform(F.transform(blocks, cut), text), "")).otherwise("")


def digest(formatted: DataFrame) -> DataFrame:
    """What reading a formatted conversation back gives."""
    turns = parse(F.col("formatted"))
    read = formatted.select("conv_id", "formatted", turns.alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
