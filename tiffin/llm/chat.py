"""Chat formatting: conversations as one training text each, with a loss mask, by Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role become one block; blocks are joined:

    [INST]role[/INST]first text<s>second text of the same role</s>

Control strings inside roles and texts get a backslash behind their first character, and one more where they already have some, so the
text between two control strings never holds one, and taking one backslash away restores it. A control string begins with a character
that it holds nowhere else, so none can arise where two parts meet. Blocks, roles and texts are read back by splitting.

``loss_mask`` has one entry per block: null, or the span of code points, counted from the start of the block, that holds the block's
assistant texts; the ``<s>`` between them bears no loss.

Turns go by turn number, null first, equal ones by role and text. Null roles and texts count as empty, a null conversation is one of its
own, repeated rows are turns of their own. An empty table gives no rows. Only the four named columns are read; others can't clash. A
conversation is one value of the result, so it has to fit one row (Spark's limit is 2 GB); every expression takes time in proportion to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings.
TURN, BODY, NEXT, END = "[INST]", "[/INST]", "<s>", "</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    square = F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")
    return F.regexp_replace(square, r"<(\\*)(/?s>)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    square = F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")
    return F.regexp_replace(square, r"<\\(\\*)(/?s>)", r"<$1$2")


def _cut(text: Column, control: str) -> Column:
    return F.split(text, control.replace("[", r"\[").replace("]", r"\]"), -1)


def _blocks(turns: Column) -> Column:
    """Runs of turns of one role: where a run starts, its turns up to the next start are one slice."""
    count = F.size(turns)
    role = lambda i: F.get(turns, i)["role"]
    starts = F.filter(F.sequence(F.lit(0), count - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), count)
        texts = F.transform(F.slice(turns, start + 1, end - start), lambda t: escape(t["text"]))
        head = F.concat(F.lit(TURN), escape(role(start)), F.lit(BODY))
        return F.struct(role(start).alias("role"), head.alias("head"), F.array_join(texts, NEXT).alias("body"))

    return F.transform(starts, block)


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_mask``."""
    empty = F.lit("")
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))
    turns = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    # Kept as an array of its own, or every use of a block would build all blocks again.
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    whole = F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(END)))
    start = lambda b: F.length(b["head"])
    span = lambda b: F.struct(start(b).alias("start"), (start(b) + F.length(b["body"])).alias("end"))
    mask = F.transform("blocks", lambda b: F.when(b["role"] == LOSS_ROLE, span(b)))
    return blocks.select("conv_id", F.array_join(whole, "").alias("formatted"), mask.alias("loss_mask"))


def _read_blocks(formatted: Column) -> Column:
    parts = _cut(formatted, END)
    return F.slice(parts, 1, F.size(parts) - 1)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: structs of role and text."""

    def turns(block: Column) -> Column:
        sides = _cut(F.substr(block, F.lit(len(TURN) + 1)), BODY)
        role = unescape(F.get(sides, F.lit(0)))
        return F.transform(_cut(F.get(sides, F.lit(1)), NEXT), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(_read_blocks(formatted), turns))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, in order."""

    def texts(block: Column, span: Column) -> Column:
        body = F.substr(block, span["start"] + 1, span["end"] - span["start"])
        return F.when(span.isNull(), F.array().cast("array<string>")).otherwise(F.transform(_cut(body, NEXT), unescape))

    return F.flatten(F.zip_with(_read_blocks(formatted), mask, texts))
