"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it as context, and only that reply
under the loss mask. Turns after the last reply make one more example without a mask, so that
the output holds every turn of every conversation. An example holds the turns up to its target, so a conversation's turns fit
in one row wherever its last example does.

A turn is written as `<|im_start|>role`, a line feed, the text, `<|im_end|>` and a line feed.
Inside roles and texts a backslash is doubled and one is put after the first character of
every control string (and line feeds of roles are written as `\\n`), so no text can close a turn
or start one, and every text can be read back.

NULL roles and texts are empty. Rows that share a turn number are ordered by role, then by text;
a NULL turn comes first. Rows with a NULL conv_id form one conversation. Other columns are left
out. A table without rows gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks, and the control strings of this and other templates.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = r"([<\[])(?=\|[A-Za-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """The text without any control string in it; `unescaped` gives it back."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CONTROL), F.lit("$1\\\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def _turn(turn: Column) -> Column:
    return F.struct(turn["role"].alias("role"), turn["text"].alias("text"))


def _head(turn: Column) -> Column:
    role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit(START), role, F.lit("\n"))


def _role(written: Column) -> Column:
    """A role as it was: an escaped n is a line feed if an odd number of backslashes precede it."""
    parts = F.transform(F.split(written, r"\\\\", -1), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, F.lit(r"\\(?!\\)"), F.lit(""))), "\\")


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, target (number of the reply, from 0 in turn order; NULL without one), n_turns, text,
    loss_start and loss_end (code points; the reply inside `text`, both 0 without one)."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    held = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    last = F.size("turns") - 1
    replies = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("turns", i)["role"] == TRAINED_ROLE)
    rest = F.when(F.get("turns", last)["role"] == TRAINED_ROLE, F.array().cast("array<int>")).otherwise(F.array(last))
    heads = F.transform("turns", _head)
    bodies = F.transform("turns", lambda t: escaped(t["text"]))
    written = held.select("conv_id", "turns", heads.alias("heads"), bodies.alias("bodies"), F.concat(replies, rest).alias("ends"))
    written = written.withColumn(
        "parts",
        F.transform(F.arrays_zip("heads", "bodies"), lambda t: F.concat(t["heads"], t["bodies"], F.lit(END + "\n"))),
    )
    single = written.select("*", F.explode("ends").alias("end"))
    context = F.array_join(F.slice("parts", F.lit(1), F.col("end")), "")
    trained = F.get("turns", F.col("end"))["role"] == TRAINED_ROLE
    text = F.concat("context", F.get("parts", F.col("end")))
    start = F.char_length("context") + F.char_length(F.get("heads", F.col("end")))
    return single.withColumn("context", context).select(
        "conv_id",
        F.when(trained, F.col("end")).alias("target"),
        (F.col("end") + 1).alias("n_turns"),
        text.alias("text"),
        F.when(trained, start).otherwise(0).alias("loss_start"),
        F.when(trained, start + F.char_length(F.get("bodies", F.col("end")))).otherwise(0).alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """The turns of an example, read back from its text: an array of role and text."""
    parts = F.split(text, r"<\|im_end\|>\n", -1)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        body = F.substring(part, F.lit(len(START) + 1), F.char_length(part))
        line = F.instr(body, "\n")
        role = _role(F.substring(body, F.lit(1), line - 1))
        return F.struct(
            role.alias("role"), unescaped(F.substring(body, line + 1, F.char_length(body))).alias("text")
        )

    return F.transform(whole, read)


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """What stands under the loss mask, as it was before it was written."""
    return unescaped(F.substring(text, start + 1, end - start))
