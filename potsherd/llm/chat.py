"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its reply is trainable.
A turn is written as ``### role: text </turn>`` and a line feed. In roles and texts each backslash doubles and each
``#`` and ``</turn>`` gets a backslash before it (in roles a colon becomes ``\\c``), so no text or role holds a control
string, and ``unescape`` gives back exactly what was said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from potsherd.llm.common import col, whole_text

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
ESCAPED = ("#", "</turn>")
TRAINED = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in ESCAPED:
        out = F.replace(out, F.lit(mark), F.lit("\\" + mark))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    """Between doubled backslashes, read from the left, each backslash stands before what is escaped or is ``\\c``."""
    plain = F.transform(F.split(text, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\c"), F.lit(":")), F.lit("\\"), F.lit("")))
    return F.array_join(plain, "\\")


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id and ``turns``, its (turn, role, text) by turn, then role, then text."""
    rows = conversations.select(
        col(conv_id).cast("long").alias("conv_id"),
        F.struct(col(turn).cast("long").alias("turn"), whole_text(role).alias("role"), whole_text(text).alias("text")).alias("said"),
    )
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))


def examples(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per example: conv_id, example (from 0), n_turns, formatted, loss_start, loss_length, complete.

    ``formatted`` holds all turns up to the trained reply, whose escaped text (loss_length characters from loss_start)
    is the only part under the loss mask. Turns after the last assistant turn have no reply: they come as one more
    example with all turns as context and a loss_length of 0, so no turn is lost; the example that holds all turns is
    ``complete``. Null texts and roles count as empty, rows without conv_id form one conversation, a null turn comes
    first, repeated rows are repeated turns, an empty reply is an example of loss_length 0, and no rows give none.
    Extra columns play no part, and long texts are kept whole. A conversation lies in one task, its examples are streamed from there.
    """
    spoken = turns(conversations, conv_id, turn, role, text)
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            (t.role == TRAINED).alias("trained"),
            F.concat(F.lit(OPEN), escape_role(t.role), F.lit(AFTER_ROLE)).alias("head"),
            escape(t.text).alias("body"),
        ),
    )
    written = spoken.select("conv_id", parts.alias("parts"))
    ends = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda k: F.get("parts", k - 1).trained | (k == F.size("parts")))
    told = written.select("conv_id", "parts", F.posexplode(ends).alias("example", "n_turns")).select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform(F.slice("parts", 1, F.col("n_turns") - 1), lambda p: F.concat(p.head, p.body, F.lit(CLOSE))), "").alias("context"),
        F.get("parts", F.col("n_turns") - 1).alias("last"),
        (F.col("n_turns") == F.size("parts")).alias("complete"),
    )
    prompt = F.concat("context", F.col("last.head"))
    return told.select(
        "conv_id",
        "example",
        "n_turns",
        F.concat(prompt, F.col("last.body"), F.lit(CLOSE)).alias("formatted"),
        F.length(prompt).cast("long").alias("loss_start"),
        F.when(F.col("last.trained"), F.length("last.body")).otherwise(0).cast("long").alias("loss_length"),
        "complete",
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted example, found by its control strings alone."""

    def turn(part: Column) -> Column:
        head = F.substring_index(part, ":", 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(part, F.length(head) + len(AFTER_ROLE) + 1)).alias("text"),
        )

    parts = F.split(formatted, CLOSE, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the examples finds, per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    reply = unescape(F.substr("formatted", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int")))
    seen = read_back(F.col("formatted"))
    each = formatted.select(
        "conv_id",
        F.struct("example", reply.alias("text")).alias("reply"),
        F.length("formatted").cast("long").alias("chars"),
        F.when(F.col("complete"), F.size(seen)).cast("long").alias("n"),
        F.when(F.col("complete"), F.sha2(F.array_join(F.transform(seen, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), 256)).alias("sha"),
    )
    loss = F.array_join(F.transform(F.array_sort(F.collect_list("reply")), lambda r: r.text), "")
    found = each.groupBy("conv_id").agg(F.max("n").alias("n_turns"), F.max("sha").alias("turns_sha256"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return found.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
