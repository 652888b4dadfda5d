"""Chat formatting by prefix-target expansion, with built-in functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only its
reply is trainable. A turn is written ``<s>[INST] role [/INST] text</s>``. Control strings inside
roles and texts are broken up by a backslash behind their first character; strings that already
look so get one more, which makes the escape reversible.

As every context is a beginning of the conversation, a conversation is laid out once in the task
that holds it, and its examples are cut from that text one by one. Turns after the last reply
(or a conversation without replies) give one more row without a target.

Defined results: null texts and roles count as empty; a null ``conv_id`` is a conversation; turns
that share a number are ordered by role, then text, and repeated rows stay; null turns come first;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, ROLE_END, END = "<s>[INST] ", " [/INST] ", "</s>"
_REST = r"(?:s>|/s>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(?=\\*{_REST})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(?=\\*{_REST})", "$1")


def format_examples(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """``conv_id, example, n_turns, is_whole, formatted, loss_start, loss_length``.

    ``example`` counts a conversation's rows, ``n_turns`` the turns in ``formatted``;
    ``is_whole`` marks the row that has all of them. The loss span (code points, from 0) is the
    text of the last turn, and null in a row without a target.
    """
    none = F.lit("")
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, none).alias("role"),
        F.coalesce(text_col, none).alias("text"),
    )
    convs = turns.select(F.col(conv_col).alias("conv_id"), turn.alias("t"))
    convs = convs.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(BEGIN), escape(t["role"]), F.lit(ROLE_END)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == target_role).alias("target"),
        ),
    )
    convs = convs.select("conv_id", parts.alias("parts"))
    start = F.struct(
        F.lit(0).cast("long").alias("end"),
        F.array().cast("array<struct<end:bigint,body:bigint,length:bigint,target:boolean>>").alias("at"),
    )

    def step(acc: Column, p: Column) -> Column:
        body = acc["end"] + F.length(p["head"])
        length = F.length(p["body"]).cast("long")
        end = body + length + len(END)
        here = F.struct(
            end.alias("end"), body.alias("body"), length.alias("length"), p["target"].alias("target")
        )
        return F.struct(end.alias("end"), F.concat(acc["at"], F.array(here)).alias("at"))

    whole = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    convs = convs.select(
        "conv_id", whole.alias("whole"), F.aggregate("parts", start, step)["at"].alias("at")
    )
    rows = convs.select("conv_id", "whole", F.size("at").alias("all"), F.posexplode_outer("at").alias("pos", "at"))
    rows = rows.where(F.col("at.target") | (F.col("pos") + 1 == F.col("all")))
    target = F.col("at.target")
    return rows.select(
        "conv_id",
        F.col("pos").cast("long").alias("example"),
        (F.col("pos") + 1).cast("long").alias("n_turns"),
        (F.col("pos") + 1 == F.col("all")).alias("is_whole"),
        F.expr("substring(whole, 1, CAST(at.end AS INT))").alias("formatted"),
        F.when(target, F.col("at.body")).alias("loss_start"),
        F.when(target, F.col("at.length")).alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted example."""
    pieces = F.split(formatted, F.lit("</s>"))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    body = lambda p: F.substring(p, len(BEGIN) + 1, F.length(p))

    def turn(p: Column) -> Column:
        own = body(p)
        at = F.instr(own, ROLE_END)
        return F.struct(
            unescape(F.substring(own, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(own, at + len(ROLE_END), F.length(own))).alias("text"),
        )

    return F.transform(pieces, turn)


def digests(examples: DataFrame) -> DataFrame:
    """What a reader of ``examples`` gets back, one row a conversation.

    All turns come from the row that has them all, the trainable text from the loss spans.
    """
    loss = F.expr("substring(formatted, CAST(loss_start AS INT) + 1, CAST(loss_length AS INT))")
    turns = F.when(F.col("is_whole"), read_turns(F.col("formatted")))
    rows = examples.select(
        "conv_id",
        "example",
        "is_whole",
        F.coalesce(unescape(loss), F.lit("")).alias("loss"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ),
            256,
        ).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("chars"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("example", "loss")))
    return rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("is_whole"), F.col("n_turns"))).alias("n_turns"),
        F.max(F.when(F.col("is_whole"), F.col("turns_sha256"))).alias("turns_sha256"),
        F.sum(F.length("loss")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["loss"]), ""), 256).alias("loss_sha256"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
