"""Relational chat formatting: conversations as marked text, with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged with array
functions, and the merged turns are concatenated:

    <|start|>role<|text|>first text<|next|>second text of the same role<|end|>

Control strings, these marks and those of other common templates, never occur inside a role or a text: where one does, a
backslash goes behind its first character, and one more where backslashes stand there already, so that removing one
backslash restores every text.

``segments`` cuts the formatted text into pieces with a loss flag; the pieces under the loss mask are the assistant's
(escaped) texts and nothing else. Reading back needs only the formatted text or the segments.

Defined results: null text or role is empty; rows are ordered by turn (null first), then role, then text; repeated rows
are turns of their own; rows with a null id form one conversation; other columns are ignored; no rows give no rows.
One conversation is one row by contract, so its turns meet in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
#: Control strings of this template and of other public templates.
CONTROL = [START, TEXT, NEXT, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = rf"([<\[])(?=\\*(?:{_RESTS}))"
_ESCAPED = rf"([<\[])\\(?=\\*(?:{_RESTS}))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def format_conversations(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", loss_role: str = "assistant") -> DataFrame:
    """id, formatted text and segments (text, loss) of each conversation."""
    blank = lambda c: escape(F.coalesce(F.col(c), F.lit("")))
    turns = rows.select(F.col(id_column), F.struct(F.col(turn_column).alias("turn"), blank(role_column).alias("role"), blank(text_column).alias("text")).alias("t"))
    turns = turns.groupBy(id_column).agg(F.array_sort(F.collect_list("t")).alias("turns"))
    first = lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])
    turns = turns.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), first))

    def merged(start: Column, number: Column) -> Column:
        length = F.coalesce(F.get("starts", number + 1), F.size("turns")) - start
        return F.struct(F.get("turns", start)["role"].alias("role"), F.transform(F.slice("turns", start + 1, length), lambda t: t["text"]).alias("texts"))

    groups = turns.select(id_column, F.transform("starts", merged).alias("groups"))

    def segments(group: Column) -> Column:
        loss = group["role"] == loss_role
        piece = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
        head = F.array(piece(F.concat(F.lit(START), group["role"], F.lit(TEXT)), F.lit(False)))
        mark = lambda i: piece(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), F.lit(False))
        body = F.flatten(F.transform(group["texts"], lambda text, i: F.array(mark(i), piece(text, loss))))
        return F.concat(head, body, F.array(piece(F.lit(END), F.lit(False))))

    cut = groups.select(id_column, F.filter(F.flatten(F.transform("groups", segments)), lambda s: s["text"] != "").alias("segments"))
    return cut.select(id_column, F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped, one for each original row."""
    groups = F.filter(F.split(formatted, re.escape(END)), lambda g: g != "")

    def turns(group: Column) -> Column:
        role = unescape(F.regexp_replace(F.substring_index(group, TEXT, 1), re.escape(START), ""))
        return F.transform(F.split(F.substring_index(group, TEXT, -1), re.escape(NEXT)), lambda text: F.struct(role.alias("role"), unescape(text).alias("text")))

    return F.flatten(F.transform(groups, turns))
