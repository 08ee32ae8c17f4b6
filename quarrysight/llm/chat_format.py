"""Chat formatting with typed content parts (built-in expressions only).

A turn's content is an array of parts (type, text, ref, units). A visitor over
the array turns text into escaped text and every image, audio and document part
into a placeholder, in order, and records the attachment with the number of
tokens it expands to. The format of a conversation is

    <|turn|>role \\n content <|end|>   for each turn

and its loss mask is a list of character spans: the contents of the trained
role. Inside texts and roles a backslash becomes ``\\1``, a new line of a role
``\\2``, and control strings are broken by ``\\0`` after their first character;
``unescape`` undoes this exactly.

A conversation is one training example and so one row: its turns are ordered by
a window on conv_id and meet in that row. Defined cases: null text, role or part
list is empty; turns with equal numbers go by role and content; null conv_id is a
conversation of its own; unknown part types get the placeholder ``<|part|>`` of 0
tokens; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: the template
TURN, END = "<|turn|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER_PLACEHOLDER = "<|part|>"
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 500}  # a tile, a second, a page
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")  # never left whole inside a text

PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\1"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\0" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    """Each backslash of an escaped text starts a code, so plain replacement
    is exact if ``\\1`` comes last."""
    out = F.replace(F.replace(text, F.lit("\\0"), F.lit("")), F.lit("\\2"), F.lit("\n"))
    return F.replace(out, F.lit("\\1"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as the only part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("units")))


def _visit(part: Column) -> Column:
    kind = part["type"]
    mark, tokens = F.lit(OTHER_PLACEHOLDER), F.lit(0)
    for k, p in PLACEHOLDERS.items():
        mark = F.when(kind == k, p).otherwise(mark)
        tokens = F.when(kind == k, F.coalesce(part["units"], F.lit(1)) * TOKENS_PER_UNIT[k]).otherwise(tokens)
    is_text = F.coalesce(kind, F.lit("text")) == "text"
    return F.struct(
        F.when(is_text, escape(part["text"])).otherwise(mark).alias("out"),
        F.when(~is_text, F.struct(kind.alias("type"), part["ref"].alias("ref"),
                                  tokens.cast("long").alias("tokens"))).alias("attachment"))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``turns`` (conv_id, turn, role, parts) to one row per conversation:
    conv_id, formatted, loss (array of start, length in code points),
    attachments (array of turn, type, ref, tokens, in order) and expanded_tokens."""
    seen = F.transform(F.coalesce("parts", F.array().cast(PARTS)), _visit)
    flat = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), seen.alias("_seen")
    ).select(
        "conv_id", "turn", "role",
        F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\2")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("_seen", lambda x: x["out"]), "").alias("body"),
        F.filter(F.transform("_seen", lambda x: x["attachment"]), lambda x: x.isNotNull()).alias("files"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.length("head") + F.length("body") + len(END)
    placed = flat.withColumn("_start", F.coalesce(
        F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    row = F.struct(
        "_start", "turn", F.concat("head", "body", F.lit(END)).alias("piece"),
        F.struct((F.col("_start") + F.length("head")).cast("long").alias("start"),
                 F.length("body").cast("long").alias("length")).alias("span"),
        (F.col("role") == trained_role).alias("trained"), "files")
    rows = F.array_sort(F.collect_list(row))
    out = placed.groupBy("conv_id").agg(rows.alias("rows"))
    files = F.flatten(F.transform("rows", lambda r: F.transform(r["files"], lambda f: F.struct(
        r["turn"].alias("turn"), f["type"].alias("type"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))))
    return out.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.transform(F.filter("rows", lambda r: r["trained"]), lambda r: r["span"]).alias("loss"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda s, f: s + f["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, content), as
    they were before escaping; placeholders stand for attachments."""
    pieces = F.split(formatted, r"<\|turn\|>")
    return F.transform(
        F.filter(pieces, lambda p, i: i > 0),
        lambda p: F.struct(
            unescape(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring_index(F.regexp_replace(p, r"(?s)^[^\n]*\n", ""), END, 1)).alias("content")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
