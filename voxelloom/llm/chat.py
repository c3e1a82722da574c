"""Chat formatting with Spark expressions only: sorted turn structs, merged roles, reversible escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template: a head names the role of the turns below it; each turn's text is followed by CLOSE.
#: "\" quotes the character after it, so that neither mark can occur in an escaped text. A "\" of the text itself becomes "\b",
#: so that no escaped text ends in "\": a mark behind one is the template's own.
HEAD, CLOSE = "### ", "</turn>\n"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.replace(text, F.lit("### "), F.lit("\\### "))
    return F.replace(text, F.lit("</turn>"), F.lit("\\</turn>"))


def unescaped(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, r"\\([#<:])", "$1"), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":\n"), F.lit("\\:\n"))


def format_chat(df: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conv_id: formatted (the whole text) and mask (start and length, in its UTF-8 bytes, of each part that is trained on).

    Turns are sorted by turn (null first), then role and text, so repeated rows stay and order is fixed. Adjacent turns
    of one role share a head. Null roles and texts are empty. Null conv_ids form one conversation. The loss
    mask covers each text of the trained role, without its CLOSE. An empty table gives none. Other columns
    are ignored. A conversation must fit a row; its turns are what is gathered, and it is the result's unit.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = df.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    first = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True))
    head = F.when(first, F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit(":\n"))).otherwise(F.lit(""))
    turns = turns.withColumns({"head": head, "body": escaped(F.col("text"))})
    # where the body starts, and with it the order of the turns
    end = F.sum(F.octet_length("head") + F.octet_length("body") + len(CLOSE)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    turns = turns.withColumn("start", end - len(CLOSE) - F.octet_length("body"))
    item = F.struct("start", F.octet_length("body").cast("bigint").alias("length"), (F.col("role") == trained).alias("loss"), "head", "body")
    per = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("ts"))
    whole = F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    mask = F.transform(F.filter("ts", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return per.select("conv_id", whole.alias("formatted"), mask.alias("mask"))


def masked(formatted: Column, mask: Column) -> Column:
    """The text of formatted under the mask, unescaped: its parts in order, with nothing between."""
    data = formatted.cast("binary")
    part = lambda m: F.substring(data, m["start"].cast("int") + 1, m["length"].cast("int"))
    return F.array_join(F.transform(mask, lambda m: unescaped(part(m).cast("string"))), "")


def parsed(formatted: Column) -> Column:
    """The array of (role, text) turns that a formatted text holds."""
    blocks = F.filter(F.split(formatted, r"(?<!\\)(?=### )"), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        head = F.regexp_extract(block, r"(?s)^### ((?:[^\\:]|\\.|:(?!\n))*):\n", 1)
        body = F.substring(block, F.length(head) + len(HEAD) + 3, F.length(block))
        texts = F.split(body, r"(?<!\\)</turn>\n")
        return F.transform(F.slice(texts, 1, F.size(texts) - 1), lambda t: F.struct(unescaped(head).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digests(df: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations: turns from the text, trained text from the text under the mask.

    Nulls, repeated rows, ties, empty tables and other columns are as in format_chat.
    """
    out = format_chat(df)
    out = out.withColumns({"turns": parsed(F.col("formatted")), "lost": masked(F.col("formatted"), F.col("mask"))})
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("lost").cast("long").alias("loss_chars"),
        F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def with_adversary(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts hold the template's own strings."""
    spark = conversations.sparkSession
    said = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for t, r in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).unionByName(more)
