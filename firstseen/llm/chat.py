"""Chat formatting with a grammar round trip, in built-in functions only.

    conversation := turn*
    turn         := "\\n" ("### " | "##\\\\ ") role ": " text "</turn>"

Texts are first set as they are. The parser cuts at ``</turn>``, takes the role
up to the first ``": "`` and the rest as text. A turn whose text alone does not
parse back to itself is set again with the second marker and escaped content:
a backslash becomes ``\\b``, ``</turn>`` becomes ``\\t`` and ``": "`` of a role
``\\c``, so every backslash has one of these letters behind it and reading is
unambiguous. Whole conversations are parsed and compared at the end; one that
still differed would fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
PLAIN, ESCAPED, AFTER_ROLE, END = "\n### ", "\n##\\ ", ": ", "</turn>"
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit(END), F.lit("\\t")), F.lit(AFTER_ROLE), F.lit("\\c"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\c"), F.lit(AFTER_ROLE)), F.lit("\\t"), F.lit(END))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def render(role: Column, text: Column, escaped: bool = False) -> Column:
    if escaped:
        role, text = escape(role), escape(text)
    return F.concat(F.lit(ESCAPED if escaped else PLAIN), role, F.lit(AFTER_ROLE), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    pieces = F.split(formatted, END)

    def turn(piece: Column) -> Column:
        escaped = F.startswith(piece, F.lit(ESCAPED))
        content = F.substr(piece, F.lit(len(PLAIN) + 1))
        colon = F.locate(AFTER_ROLE, content)
        role, text = F.substr(content, F.lit(1), colon - 1), F.substr(content, colon + len(AFTER_ROLE))
        return F.struct(
            F.when(escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
        )

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    Turns go by ``turn``, ties by role, then text; rows that repeat stay. A null
    text or role is empty; a null turn comes first; rows without conv_id form one
    conversation. ``loss_spans`` holds, in order, where the texts of assistant
    turns stand: code points before, and how many. An empty table gives no row.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    plain = render(F.col("role"), F.col("text"))
    fits = parse(plain) == source
    rows = rows.withColumn("escaped", ~fits).withColumn(
        "piece", F.when(F.col("escaped"), render(F.col("role"), F.col("text"), True)).otherwise(plain)
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.length("piece").cast("bigint")
    before = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - length
    content = F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text"))
    start = before + length - F.length(content) - len(END)
    placed = rows.withColumn("before", before).withColumn(
        "loss", F.when(F.col("role") == LEARNT_ROLE, F.struct(start.alias("start"), F.length(content).alias("length")))
    )
    turns = F.array_sort(F.collect_list(F.struct("before", "piece", "role", "text", "loss")))
    grouped = placed.groupBy("conv_id").agg(turns.alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    same = parse(formatted) == F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select(
        "conv_id",
        F.when(same, formatted).otherwise(F.raise_error(F.lit("a conversation does not parse back"))).alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """What stands under the loss mask, unescaped, joined in order.

    Whether a text was escaped is told by the marker of its turn, so the spans
    are cut from the formatted text and matched with the parsed turns.
    """
    texts = F.transform(spans, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    learnt = F.filter(parse(formatted), lambda t: t["role"] == LEARNT_ROLE)
    return F.array_join(
        F.zip_with(texts, learnt, lambda cut, turn: F.when(cut == turn["text"], cut).otherwise(unescape(cut))), ""
    )


def digests(chats: DataFrame) -> DataFrame:
    """Counts and hashes read back from formatted conversations."""
    turns = parse(F.col("formatted"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = masked_text(F.col("formatted"), F.col("loss_spans"))
    return chats.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
