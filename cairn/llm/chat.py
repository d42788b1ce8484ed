"""Chat formatting by relational expressions only.

A conversation becomes ``<s>role[TEXT]text[TURN]text</s>`` blocks, one per run of turns of one role.
Inside texts and roles every ``<`` and ``[`` gets a backslash after it, so that no control string of this
or a similar template can stand there; taking one off after each of them is the exact reverse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, TEXT, TURN, END = "<s>", "[TEXT]", "[TURN]", "</s>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, segments, formatted) from ``turns(conv_id, turn, role, text)``.

    Turn structs are collected and sorted, runs of one role are merged, and everything is
    concatenated. segments is an array of (text, loss) whose texts make up formatted: the loss mask is
    true on exactly the escaped texts of the assistant's turns.

    Null texts and roles count as empty. Turns with equal numbers are ordered by role, then text;
    repeated rows are turns of their own; null turn numbers come last. A row without a conv_id is a conversation
    of its own with a null id. An empty table gives no rows. Other columns are ignored.
    """
    clean = turns.select(F.col("conv_id").cast("long"), F.struct(F.col("turn").isNull().alias("last"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    grouped = clean.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    chats = grouped.unionByName(clean.where("conv_id IS NULL").select("conv_id", F.array("t").alias("turns"))).withColumn("n_turns", F.size("turns").cast("long"))
    # No lambda refers to an array outside itself: the optimizer would build that array again for every element.
    roles = F.transform(F.slice("turns", 1, F.size("turns") - 1), lambda t: t["role"])
    zipped = F.arrays_zip(F.col("turns").alias("t"), F.concat(F.array(F.lit(None).cast("string")), roles).alias("before"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def turn_segments(z: Column, k: Column) -> Column:
        opened = F.concat(F.when(k > 0, END).otherwise(""), F.lit(BEGIN), escape(z["t"]["role"]), F.lit(TEXT))
        head = F.when(z["before"] == z["t"]["role"], TURN).otherwise(opened)
        return F.array(segment(head, F.lit(False)), segment(escape(z["t"]["text"]), z["t"]["role"] == LOSS_ROLE))

    closed = F.array(segment(F.lit(END), F.lit(False)))
    segments = chats.withColumn("zipped", zipped).select("conv_id", "n_turns", F.concat(F.flatten(F.transform("zipped", turn_segments)), closed).alias("segments"))
    return segments.select("conv_id", "n_turns", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    quoted = lambda s: "\\Q" + s + "\\E"
    parts = F.split(formatted, quoted(END))
    blocks = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda b: F.split(F.substr(b, F.lit(len(BEGIN) + 1)), quoted(TEXT)))
    return F.flatten(F.transform(blocks, lambda b: F.transform(F.split(F.element_at(b, 2), quoted(TURN)), lambda t: F.struct(unescape(F.element_at(b, 1)).alias("role"), unescape(t).alias("text")))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
