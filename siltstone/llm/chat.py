"""Chat formatting with typed content parts, on DataFrame functions alone.

Each message is a list of typed parts (text, image, audio, document). A visitor flattens them in
order: text is escaped, every other part becomes a numbered placeholder, and its reference and the
number of tokens it expands to are recorded. Turns are marked by control strings. All control
strings begin with ``<`` or ``[``, and inside texts and roles these two are always escaped, so no
text can forge a mark and the escape can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import col

#: The template.
START, BODY, END = "<|turn|>", "<|says|>", "<|end|>\n"
#: Tokens that a part expands to if it doesn't say so itself.
TOKENS = {"image": 256, "audio": 150, "document": 1024}
PARTS = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\``, ``<`` becomes ``\l`` and ``[`` becomes ``\b``."""
    for plain, safe in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    """Undoes ``escape``: what stands between escaped backslashes holds only the other two escapes."""

    def piece(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def placeholder(kind: Column, number: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit(":"), number.cast("string"), F.lit("|>"))


def text_parts(text: Column) -> Column:
    """A plain text as a message of one part; null counts as the empty text."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("tokens")))


def flatten(parts: Column) -> Column:
    """The message's text: text parts escaped, the others as placeholders numbered from 0 within the message."""
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(F.coalesce(p["type"], F.lit("text")) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder(escape(p["type"]), i))), "")


def attachments(parts: Column) -> Column:
    """Reference and expanded token count of every part that isn't text, in order."""
    marked = F.transform(parts, lambda p, i: F.struct(i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    others = F.filter(marked, lambda p: F.coalesce(p["type"], F.lit("text")) != "text")

    def default(kind: Column) -> Column:
        tokens = F.lit(0)
        for name, n in TOKENS.items():
            tokens = F.when(kind == name, F.lit(n)).otherwise(tokens)
        return tokens

    return F.transform(others, lambda p: F.struct(p["part"], p["type"], p["ref"], F.coalesce(p["tokens"], default(p["type"]).cast("bigint")).alias("tokens")))


def format_chat(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, train_on: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in code points of the
    formatted text, for the content of each turn of ``train_on``), attachments, attached_tokens.

    Rows are ordered by turn (null first), ties by role and text. Null texts and roles count as empty;
    rows with a null conversation are one conversation; repeated rows are turns of their own; a table
    without rows gives none. Further columns don't matter and are not kept.
    """
    message = F.coalesce(col(parts).cast(PARTS), text_parts(col(text))) if parts else text_parts(col(text))
    rows = df.select(col(conversation).alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), message.alias("parts"))
    rows = rows.select("conv_id", "turn", "role", flatten(F.col("parts")).alias("content"), attachments(F.col("parts")).alias("attached"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(BODY))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    size = F.length(head) + F.length("content") + F.length(F.lit(END))
    rows = rows.select(
        "conv_id", "turn", F.row_number().over(order).alias("k"), F.concat(head, "content", F.lit(END)).alias("piece"), "attached",
        F.when(F.col("role") == train_on, F.struct((F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.length(head)).cast("bigint").alias("start"), F.length("content").cast("bigint").alias("length"))).alias("span"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("k", "piece", "span", "attached"))).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join("turns.piece", "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct((t["k"] - 1).alias("turn"), a["part"], a["type"], a["ref"], a["tokens"])))).alias("attachments"),
    ).withColumn("attached_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, texts unescaped, placeholders left as they are."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    cut = F.transform(pieces, lambda p: F.split(F.left(p, F.length(p) - len(END)), r"<\|says\|>", 2))
    return F.transform(cut, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
