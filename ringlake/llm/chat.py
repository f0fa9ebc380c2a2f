"""Chat formatting of typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document.  The
visitor turns the parts into one string: escaped text, and a placeholder for every
attachment.  Attachments are recorded beside it with their place, reference and the
number of tokens that the placeholder stands for.

Template of a turn::

    <|turn|>role<|says|>content<|end|>

Control strings inside roles and texts get an escape mark after their first
character, and marks themselves are doubled up, so that no control string is left
and the original can be restored exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values ---------------------------------------------------------------------
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Control strings of this template and of other common ones.
CONTROL = [
    TURN, SAYS, END, *PLACEHOLDERS.values(),
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
]
MARK = "␛"
IMAGE_SIDE, AUDIO_PER_SECOND, DOCUMENT_PER_PAGE, TEXT_CHARS = 14, 25, 600, 4
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit(MARK), F.lit(MARK + "0"))
    for word in CONTROL:
        out = F.replace(out, F.lit(word), F.lit(word[0] + MARK + "1" + word[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(MARK + "1"), F.lit("")), F.lit(MARK + "0"), F.lit(MARK))


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    nulls = [F.lit(None).cast(kind).alias(name) for name, kind in empty.items()]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *nulls))


def part_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; text is estimated at ``TEXT_CHARS`` characters each."""
    patches = F.ceil(part["width"] / IMAGE_SIDE) * F.ceil(part["height"] / IMAGE_SIDE)
    return F.coalesce(
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_PER_SECOND))
        .when(part["kind"] == "document", part["pages"] * DOCUMENT_PER_PAGE)
        .otherwise(F.ceil(F.char_length(F.coalesce(part["text"], F.lit(""))) / TEXT_CHARS)),
        F.lit(1),
    ).cast("long")


def visited(parts: Column) -> Column:
    """Struct of the flattened content, its attachments in order and its expanded tokens.

    A null list is empty, a null part or a part of unknown kind counts as text, a null
    text is empty.  An attachment whose size is unknown stands for one token.
    """
    held = F.coalesce(parts, F.array().cast(f"array<{PART}>"))

    def shown(part: Column) -> Column:
        out = escaped(F.coalesce(part["text"], F.lit("")))
        for kind, place in PLACEHOLDERS.items():
            out = F.when(part["kind"] == kind, F.lit(place)).otherwise(out)
        return out

    listed = F.transform(
        held,
        lambda part, i: F.struct(
            i.alias("part"), part["kind"].alias("kind"), part["ref"].alias("ref"), part_tokens(part).alias("tokens")
        ),
    )
    return F.struct(
        F.array_join(F.transform(held, shown), "").alias("content"),
        F.filter(listed, lambda a: a["kind"].isin(*PLACEHOLDERS)).alias("attachments"),
        F.aggregate(listed, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("tokens"),
    )


def format_chats(
    turns: DataFrame, parts: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    learned: str = "assistant",
) -> DataFrame:
    """One row per conversation: formatted string, loss spans, attachments and expanded tokens.

    ``loss_spans`` are (start, length) in characters of ``formatted``, from 1, one for
    the content of each ``learned`` turn.  Turns are in order of ``turn``, nulls first,
    then role and content, so repeated and tied rows have one order; all are kept.  A
    null role is an empty one.  A null conversation id is a conversation.  An empty
    table gives an empty table.  Extra columns are not looked at.

    A conversation becomes one string, so one row holds it whole; that is the only
    thing gathered here.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        visited(parts).alias("seen"),
    )
    one = F.struct(
        "turn", "role", F.col("seen.content").alias("content"),
        F.col("seen.attachments").alias("attachments"), F.col("seen.tokens").alias("tokens"),
    )
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(SAYS))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["content"], F.lit(END))), "")
    # Lengths before each turn, then the learned ones among them.
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(head(t)) + F.char_length(t["content"]) + len(END)).alias("at"),
            F.when(
                t["role"] == learned,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.char_length(head(t)) + 1).alias("start"),
                            F.char_length(t["content"]).alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    attachments = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                t["attachments"],
                lambda a: F.struct(
                    i.alias("turn"), a["part"].alias("part"), a["kind"].alias("kind"), a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return gathered.select(
        "conv_id",
        formatted.alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: array of (role, content), unescaped."""
    pieces = F.filter(F.split(formatted, re.escape(END)), lambda piece: piece != "")
    pair = lambda piece: F.split(F.substr(piece, F.lit(len(TURN) + 1)), re.escape(SAYS))
    return F.transform(
        pieces,
        lambda piece: F.struct(
            unescaped(F.get(pair(piece), F.lit(0))).alias("role"),
            unescaped(F.get(pair(piece), F.lit(1))).alias("text"),
        ),
    )


def under_loss(formatted: Column, spans: Column) -> Column:
    """The text that the loss mask covers, unescaped, in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"], s["length"]))), ""
    )
