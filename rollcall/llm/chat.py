"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its text is under the loss mask. Turns after the last reply
would be lost that way, so a conversation that doesn't end with a reply gets one
more example that holds all its turns and has an empty mask.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside a text
a backslash is doubled and ``<|`` becomes ``<\\|``, so a text never holds a control
string and reading back is exact. Roles are URL-encoded, which leaves plain names
as they are.

Nulls and odd input: a missing text or role is empty; turns stand by turn number
(missing first), then role, then text, and repeated rows are turns of their own;
rows without a conversation id form one conversation; an empty table gives an
empty result. Columns other than conv_id, turn, role and text are not read.

One conversation is one training text and therefore one row; how many copies of a
conversation or of a first turn there are doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order as an array of role and text."""
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.select("conv_id", turn.alias("_turn")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("_turn")).alias("turns")
    )


def examples(turns: DataFrame) -> DataFrame:
    """The training examples: conv_id, example (from 0), formatted, loss_start, loss_length.

    ``formatted`` is the whole text of an example; the loss mask covers
    ``loss_length`` code points from position ``loss_start`` (0-based).
    """
    formatted = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(START), F.url_encode(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)
        ),
    )
    n = F.size("turns")
    replies = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)), lambda i: i.isNotNull()
    )
    open_end = F.element_at("turns", -1)["role"] != "assistant"
    targets = F.concat(replies, F.when(open_end, F.array(n)).otherwise(F.array().cast("array<int>")))
    one = conversations_of(turns).select(
        "conv_id", formatted.alias("parts"), targets.alias("targets"), open_end.alias("open_end"), n.alias("n")
    )
    each = one.select(
        "conv_id", "parts", "open_end", "n", F.posexplode_outer("targets").alias("example", "upto")
    )
    text = F.array_join(F.slice("parts", F.lit(1), F.col("upto")), "")
    last = F.element_at("parts", F.col("upto"))
    masked = ~(F.col("open_end") & (F.col("upto") == F.col("n")))
    reply_length = F.length(last) - len(START) - len("assistant\n") - len(END)
    return each.select(
        "conv_id", "example", text.alias("formatted"),
        F.when(masked, F.length(text) - len(END) - reply_length).otherwise(F.length(text)).alias("loss_start"),
        F.when(masked, reply_length).otherwise(0).alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn, read back from a formatted example."""
    blocks = F.split(formatted, END.replace("|", "\\|"))
    return F.transform(
        F.slice(blocks, F.lit(1), F.size(blocks) - 1),
        lambda b: F.struct(
            F.url_decode(F.substr(F.substring_index(b, "\n", 1), F.lit(len(START) + 1))).alias("role"),
            unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text"),
        ),
    )


def masked_text(formatted: Column, start: Column, length: Column) -> Column:
    return unescape(F.substr(formatted, start + 1, length))


def digests(made: DataFrame) -> DataFrame:
    """Counts and hashes of each conversation, read back from its examples alone."""
    reply = masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length"))
    read = made.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted"))["formatted"].alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", reply.alias("text")))).alias("replies"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
    ).select(
        "conv_id", "formatted_chars", read_turns(F.col("longest")).alias("turns"),
        F.array_join(F.col("replies.text"), "").alias("loss"),
    )
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
    )
