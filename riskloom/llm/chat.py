"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts (text, image, audio, document). A visitor over the parts writes
text escaped, puts one placeholder per attachment in its place, and records each attachment with its
position, reference and the number of tokens its placeholder expands to.

Defined cases: a null role or text is the empty one; a part of any other type, or of none, is text; rows
of one conversation are put in order of turn (null first), role and content, so ties and repeated rows
have one result; a null conversation id is a conversation; an empty table gives no rows; columns other
than the named ones are not looked at.

A conversation becomes one row, because its text and digests are one value each: the longest
conversation must fit in an executor's memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PART_TYPE = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


@dataclass(frozen=True)
class Expansion:
    """What one attachment expands to; an unknown size counts as one tile, second or page."""

    tile: int = 28
    tokens_per_second: int = 25
    tokens_per_page: int = 256


def escape(text: Column) -> Column:
    """No control string survives in the result; ``unescape`` gives the text back exactly."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The parts of a turn that is plain text."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), text.cast("string").alias("text"), null.cast("string").alias("ref"),
            null.cast("int").alias("width"), null.cast("int").alias("height"), null.cast("double").alias("seconds"), null.cast("int").alias("pages"),
        )
    )


def _tokens(part: Column, size: Expansion) -> Column:
    tiles = lambda side: F.greatest(F.lit(1), F.ceil(F.coalesce(side, F.lit(size.tile)) / size.tile))
    image = tiles(part["width"]) * tiles(part["height"])
    audio = F.greatest(F.lit(1), F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * size.tokens_per_second))
    pages = F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(1))) * size.tokens_per_page
    return F.when(part["type"] == "image", image).when(part["type"] == "audio", audio).otherwise(pages).cast("long")


def _attached(part: Column) -> Column:
    return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))


def flatten(parts: Column, size: Expansion = Expansion()) -> tuple[Column, Column]:  # noqa: B008
    """(text with placeholders, attachments in order) of an array of parts."""
    body = F.array_join(
        F.transform(
            parts,
            lambda p: F.when(_attached(p), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escape(F.coalesce(p["text"], F.lit("")))),
        ),
        "",
    )
    kept = F.filter(parts, _attached)
    attachments = F.transform(
        kept, lambda p, i: F.struct(i.alias("position"), p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p, size).alias("tokens"))
    )
    return F.coalesce(body, F.lit("")), F.coalesce(attachments, F.array().cast("array<struct<position:int,type:string,ref:string,tokens:bigint>>"))


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
    trained: str = "assistant", size: Expansion = Expansion(),  # noqa: B008
) -> DataFrame:
    """One row per conversation.

    ``formatted``: the whole text. ``pieces``: its consecutive parts, one per turn, with ``offset`` (where the
    piece begins), ``loss_start`` and ``loss_length`` (what is trained on, from the piece's beginning; null for
    other turns). ``attachments``: (turn_index, position, type, ref, tokens). ``expanded_tokens``: their sum.
    """
    body, attachments = flatten(F.col(parts), size)
    name = F.replace(escape(F.coalesce(F.col(role).cast("string"), F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    rows = turns.select(
        F.col(conv).alias("c"), F.col(turn).alias("t"), name.alias("r"), body.alias("b"), attachments.alias("a"),
    )
    begins = F.length("r") + len(OPEN) + 1
    piece = F.concat(F.lit(OPEN), F.col("r"), F.lit("\n"), F.col("b"), F.lit(CLOSE))
    order = Window.partitionBy("c").orderBy("t", "r", "b", "a")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "c",
        "a",
        (F.row_number().over(order) - 1).alias("k"),
        piece.alias("p"),
        F.coalesce(F.sum(F.length("b") + begins + len(CLOSE)).over(before), F.lit(0)).alias("o"),
        F.when(F.col("r") == trained, F.struct(begins.cast("long").alias("s"), F.length("b").cast("long").alias("n"))).alias("l"),
    )
    whole = rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("k", "o", "p", "l", "a"))).alias("turns"))
    pieces = F.transform(
        "turns",
        lambda x: F.struct(
            x["p"].alias("text"), x["o"].alias("offset"), x["l"]["s"].alias("loss_start"), x["l"]["n"].alias("loss_length"),
        ),
    )
    listed = F.flatten(
        F.transform(
            "turns",
            lambda x: F.transform(
                x["a"],
                lambda y: F.struct(x["k"].alias("turn_index"), y["position"].alias("position"), y["type"].alias("type"), y["ref"].alias("ref"), y["tokens"].alias("tokens")),
            ),
        )
    )
    return whole.select(
        F.col("c").alias(conv),
        F.array_join(F.transform("turns", lambda x: x["p"]), "").alias("formatted"),
        pieces.alias("pieces"),
        listed.alias("attachments"),
        F.aggregate(listed, F.lit(0).cast("long"), lambda s, y: s + y["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn, read back from a formatted conversation."""
    shape = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*)$"
    closed = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(
        F.slice(closed, 1, F.size(closed) - 1),
        lambda x: F.struct(unescape(F.regexp_extract(x, shape, 1)).alias("role"), unescape(F.regexp_extract(x, shape, 2)).alias("text")),
    )


def read_loss(pieces: Column) -> Column:
    """The texts under the loss mask, in order."""
    masked = F.filter(pieces, lambda p: p["loss_length"].isNotNull())
    return F.transform(masked, lambda p: unescape(F.substring(p["text"], (p["loss_start"] + 1).cast("int"), p["loss_length"].cast("int"))))


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what the formatted conversations hold, read back from them."""
    rows = formatted.select(conv, F.length("formatted").cast("long").alias("chars"), read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(F.col("pieces")), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return rows.select(
        F.col(conv).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
