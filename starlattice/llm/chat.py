"""Operator 9, chat formatting by prefix-target expansion.

A conversation becomes one text, turn after turn: ``### Role: text</turn>`` and a line feed. Control
strings inside roles and texts are escaped reversibly (``\\`` ``<`` ``#`` and, in roles, ``:`` become
``\\b`` ``\\l`` ``\\h`` ``\\c``), so that no text can hold a mark of the template.

Every assistant turn is an example of its own: all preceding turns, and the head of its own, are its
context, and only its reply is trainable. An example holds its context as the length of a prefix of the
conversation's text, and its target as a range that follows it. Written out, the contexts of a
conversation take the square of its turns, which for one with a third of all rows no cluster holds;
``written_examples`` writes them out for those who want that. ``targets`` expands to one row per example and
reads each target from the text by its range alone; ``read_back`` takes the loss from those rows. The text is cut once
into parts of ``PART`` characters, so that a range is read without counting from the text's start.

Defined results: null text and null role count as empty; null turns come first, equal turns go by
role and text, and repeated rows are turns of their own. Rows without a conv_id are one conversation. A
conversation without assistant turns has no examples, and its loss is empty. An empty table gives an
empty table. Only conv_id, turn, role and text are read.

DataFrame functions only. The digest of a conversation is one value over all its turns, so a conversation's
turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINABLE = "assistant"
END = "</turn>\n"
PART = 1000
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(turns: DataFrame, trainable: str = TRAINABLE) -> DataFrame:
    """(conv_id, formatted, examples): one example per assistant turn, (turns, context, target_end). Its
    context is the first ``context`` characters (code points), which hold ``turns`` whole turns and the
    head of its own; its target goes from there to ``target_end``."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = (turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .withColumn("head", F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": ")))
            .withColumn("body", escape(F.col("text")))
            .withColumn("piece", F.concat("head", "body", F.lit(END))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    start = F.coalesce(F.sum(F.char_length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    context = F.col("start") + F.char_length("head")
    example = F.when(F.col("role") == trainable, F.struct(
        (F.col("no") - 1).alias("turns"), context.alias("context"),
        (context + F.char_length("body")).alias("target_end")))
    return (rows.withColumn("no", F.row_number().over(order)).withColumn("start", start)
            .groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("no", "piece"))).alias("pieces"),
                 F.array_sort(F.collect_list(example)).alias("examples"))
            .select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "examples"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, turns, context, target_end."""
    return (formatted.select("conv_id", F.posexplode("examples").alias("example", "e"))
            .select("conv_id", "example", "e.turns", "e.context", "e.target_end"))


def written_examples(formatted: DataFrame) -> DataFrame:
    """One row per example with its texts: conv_id, example, prompt, target."""
    return (formatted.select("conv_id", "formatted", F.posexplode("examples").alias("example", "e"))
            .select("conv_id", "example", F.expr("substring(formatted, 1, e.context)").alias("prompt"),
                    F.expr("substring(formatted, e.context + 1, e.target_end - e.context)").alias("target")))


def targets(formatted: DataFrame, *keep: str) -> DataFrame:
    """One row per example: conv_id, keep, example, turns, context, target_end and target, the characters of the
    range; a conversation without examples gives one row whose example is null."""
    number = lambda place: F.floor(place / PART)

    def read(parts: Column, e: Column) -> Column:
        met = F.transform(F.sequence(number(e["context"]), number(e["target_end"])), lambda k: F.get(parts, k.cast("int")))
        return F.substr(F.array_join(met, ""), (e["context"] % PART + 1).cast("int"), (e["target_end"] - e["context"]).cast("int"))

    # the text's parts are bound to a name, so that they are made once and not per example
    parts = F.array(F.regexp_extract_all("formatted", F.lit("(?s).{1,%d}" % PART), F.lit(0)))
    read_all = F.element_at(F.transform(parts, lambda p: F.transform("examples", lambda e: e.withField("target", read(p, e)))), 1)
    return (formatted.select("conv_id", *keep, F.posexplode_outer(read_all).alias("example", "e"))
            .select("conv_id", *keep, "example", "e.turns", "e.context", "e.target_end", "e.target"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts hold: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars."""
    pieces = F.split("formatted", END, -1)
    head = lambda p: F.substring_index(p, ": ", 1)
    role = lambda p: unescape(F.substr(head(p), F.lit(len("### ") + 1)), ROLE_ESCAPES)
    text = lambda p: unescape(F.substr(p, F.char_length(head(p)) + 3))
    rows = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), "formatted", "examples",
                            F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("pieces"))
    turns = F.array_join(F.transform("pieces", lambda p: F.concat(role(p), F.lit("\n"), text(p), F.lit("\n"))), "")
    whole = ["n_turns", "turns_sha256", "formatted_chars"]
    rows = rows.select("conv_id", F.size("pieces").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       "formatted_chars", "formatted", "examples")
    # one row per example from here on; the loss is what their target ranges hold
    told = F.when(F.col("example").isNotNull(), F.struct("example", unescape(F.col("target")).alias("target")))
    loss = F.array_join(F.transform(F.array_sort(F.collect_list(told)), lambda t: t["target"]), "")
    return (targets(rows, *whole).groupBy("conv_id", *whole).agg(loss.alias("loss"))
            .select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
