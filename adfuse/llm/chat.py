"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, and its reply as the only text under the loss mask.  A conversation
that does not end with a reply gets one more example without loss, so no turn
is lost.

Template: ``<turn ROLE>TEXT</turn>`` and a newline per turn.  Inside roles and
texts the three characters that could imitate it are written as two-letter
escapes, so an escaped string holds neither ``<`` nor ``>`` and reading back is
a plain split:

    \\  ->  \\e        <  ->  \\l        >  ->  \\g

An example repeats its whole context; that is the method.  A conversation is
one row here, as each of its examples has to be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfuse.llm.tables import pick, table

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<turn ", ">", "</turn>\n"
REPLY = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    out = F.replace(out, F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\g"), F.lit(">"))
    return F.replace(out, F.lit("\\e"), F.lit("\\"))


def format_chat(conversations: DataFrame) -> DataFrame:
    """One formatted example per assistant turn of (conv_id, turn, role, text).

    Returns conv_id, example (0, 1, ... in the order of the turns), text,
    loss_start and loss_end (code points of the reply inside text; equal in an
    example without loss).  A null role or text counts as empty, a null turn
    comes first, equal turn numbers are ordered by role and text, repeated
    rows stay, rows without conv_id form one conversation, and an empty table
    gives no rows.
    """
    rows = pick(conversations, ("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = whole.select(
        "conv_id",
        "turns",
        F.transform(
            "turns",
            lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE), escape(t["text"]), F.lit(CLOSE)),
        ).alias("parts"),
    )
    # Examples end at every reply, and at the last turn.
    ends = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (F.get(F.col("turns"), i - 1)["role"] == REPLY) | (i == F.size("turns")),
    )
    examples = parts.select("conv_id", "turns", "parts", F.posexplode(ends).alias("example", "end"))
    last = F.get(F.col("turns"), F.col("end") - 1)
    reply = F.when(last["role"] == REPLY, F.char_length(escape(last["text"]))).otherwise(0)
    text = F.array_join(F.slice("parts", F.lit(1), F.col("end")), "")
    stop = F.char_length("text") - len(CLOSE)
    return examples.select("conv_id", "example", text.alias("text"), reply.alias("_reply")).select(
        "conv_id",
        "example",
        "text",
        (stop - F.col("_reply")).alias("loss_start"),
        stop.alias("loss_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Turns and loss text of every conversation, from the formatted examples alone.

    The last example holds all turns; each example adds its own reply.
    """
    read = F.struct(
        "example",
        "text",
        unescape(
            F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
        ).alias("loss"),
    )
    per_conv = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "text"))["text"].alias("text"),
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("example", read["loss"].alias("loss")))), lambda e: e["loss"]
            ),
            "",
        ).alias("loss"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    pieces = F.split(F.col("text"), CLOSE)  # the piece after the last end mark is empty
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescape(F.substr(F.substring_index(p, MIDDLE, 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substring_index(p, MIDDLE, -1)).alias("text"),
        ),
    )
    return per_conv.select("conv_id", turns.alias("turns"), "loss", "formatted_chars")


#: The conversation that imitates control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op6_chat_format(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, REPLY, TRICKY)], "conv_id bigint, turn bigint, role string, text string"
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(format_chat(rows.unionByName(tricky))).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
