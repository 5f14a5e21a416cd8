"""Chat formatting by prefix-target expansion: one training example for each assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A turn is written as HEAD role ": " text END. Inside texts and roles a backslash
# breaks both marks and is itself doubled.
HEAD, END = "### ", "</turn>\n"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("</turn>", "<\\/turn>"), ("### ", "#\\## ")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def expand(turns: DataFrame) -> DataFrame:
    """Examples of conversations (conv_id, turn, role, text).

    Each assistant turn becomes one example: `text` holds all turns up to it, and
    the `loss_length` code points from `loss_start` are its escaped reply, all that is
    trained on. Turns after the last reply, and conversations without one, make one
    example more with an empty loss span, so that no turn is lost. Returns conv_id,
    example (1, 2, ...), last (whether it holds the whole conversation), text,
    loss_start, loss_length.

    Null roles and texts count as empty; turns are sorted by turn (null first), then
    role, then text, so ties have one order and repeated rows all stay. A null
    conv_id is one conversation. No rows: no rows. Other columns are not read. An
    example is one row that holds its whole context, so its conversation must fit in
    a task; the examples of a conversation are made one after another.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(F.lit(HEAD), _role(t.role), F.lit(": "), escape(t.text), F.lit(END)))
    replies = F.transform("turns", lambda t: F.when(t.role == TARGET_ROLE, F.length(escape(t.text))).otherwise(-1))
    ends = F.filter(
        F.sequence(F.lit(1), F.size("replies")),
        lambda i: (F.element_at("replies", i) >= 0) | (i == F.size("replies")),
    )
    text = F.array_join(F.slice("pieces", F.lit(1), F.col("end")), "")
    reply = F.element_at("replies", F.col("end"))
    return (
        talks.select("conv_id", pieces.alias("pieces"), replies.alias("replies"))
        .select("conv_id", "pieces", "replies", F.posexplode(ends).alias("place", "end"))
        .select(
            "conv_id",
            (F.col("place") + 1).alias("example"),
            (F.col("end") == F.size("pieces")).alias("last"),
            text.alias("text"),
            F.greatest(reply, F.lit(0)).alias("loss_length"),
        )
        .withColumn("loss_start", F.length("text") - len(END) - F.col("loss_length"))
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Conversations as the formatted examples hold them: conv_id, turns (role, text), replies, formatted_chars.

    Turns are parsed from the example that holds the whole conversation, replies from
    the loss spans of all its examples in order.
    """
    spans = examples.select(
        "conv_id",
        F.when(F.col("last"), F.col("text")).alias("whole"),
        F.struct(
            "example", unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_length"))).alias("reply")
        ).alias("reply"),
        F.length("text").cast("long").alias("chars"),
    )
    gathered = spans.groupBy("conv_id").agg(
        F.collect_list("whole").alias("whole"),
        F.sort_array(F.collect_list("reply")).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    written = F.filter(F.split(F.element_at("whole", 1), END), lambda p: p != "")
    part = r"(?s)^### ([^\\:]*+(?:\\.[^\\:]*+)*+): (.*)$"
    turns = F.transform(
        written,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, part, 1)).alias("role"), unescape(F.regexp_extract(p, part, 2)).alias("text")
        ),
    )
    return gathered.select(
        "conv_id", turns.alias("turns"), F.col("replies.reply").alias("replies"), "formatted_chars"
    )
