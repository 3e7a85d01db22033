"""Fill-in-the-middle examples: a delimiter is put behind every unit of a text, and parts are cut at the n-th delimiter.

The delimiter is one control character. Where a text has it already, it is escaped first, so that every delimiter that
is found later is one that was put there; escapes hold no white space, so they never change where units begin and end.
All of it is native expressions over one row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import col, free_name

DELIMITER, ESCAPE = "\x01", "\x02"
#: A unit is a word with the white space before it; what is left at the end is one unit.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
TAGS = ("<P>", "<S>", "<M>")


def escaped(text: Column) -> Column:
    """``text`` without delimiters, from which ``unescaped`` gives it back."""
    return F.replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "e")), F.lit(DELIMITER), F.lit(ESCAPE + "d"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(ESCAPE + "d"), F.lit(DELIMITER)), F.lit(ESCAPE + "e"), F.lit(ESCAPE))


def marked(text: Column, unit: str = UNIT) -> Column:
    """``text`` escaped, with a delimiter behind each unit."""
    return F.regexp_replace(escaped(text), unit, "$0" + DELIMITER)


def count_units(marked_text: Column) -> Column:
    return F.length(marked_text) - F.length(F.replace(marked_text, F.lit(DELIMITER), F.lit("")))


def cut_at(marked_text: Column, count: Column) -> Column:
    """The first ``count`` units, or for a negative count what follows the delimiter of that rank from the right."""
    return F.call_function("substring_index", marked_text, F.lit(DELIMITER), count)


def plain(part: Column) -> Column:
    return unescaped(F.replace(part, F.lit(DELIMITER), F.lit("")))


def draws(id_column: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that depend on seed and id alone; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def assemble(form: Column, text: Column, prefix: Column, middle: Column, suffix: Column, tags: tuple[str, str, str] = TAGS) -> Column:
    p, s, m = (F.lit(t) for t in tags)
    return F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(form == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)


def restored(output: Column, form: Column, tags: tuple[str, str, str] = TAGS) -> Column:
    """The text that ``output`` was made of. Texts with a tag are always plain, so the first tag of a kind is the real one."""
    p, s, m = tags
    before = lambda text, tag: F.substring_index(text, tag, 1)
    after = lambda text, tag: F.substring(text, F.length(before(text, tag)) + len(tag) + 1, F.length(text))
    psm, spm = after(output, p), after(output, s)
    suffix_middle, prefix_middle = after(psm, s), after(spm, p)
    return (
        F.when(form == "psm", F.concat(before(psm, s), after(suffix_middle, m), before(suffix_middle, m)))
        .when(form == "spm", F.concat(before(prefix_middle, m), after(prefix_middle, m), before(spm, p)))
        .otherwise(output)
    )


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80, tags: tuple[str, str, str] = TAGS, unit: str = UNIT) -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix, middle, suffix and output.

    ``rate`` of 100 texts are cut at two drawn units, ``spm_rate`` of 100 of those with the suffix first. A null text is
    an empty one; empty texts and texts that contain a tag stay plain, with null parts. Long texts are cut whole, repeated
    rows give repeated rows, an empty table an empty one. Columns of these names are replaced, all others are kept.
    """
    added = ("n", "form", "prefix", "middle", "suffix", "output")
    if id_column in added or text in added:
        raise ValueError("the id and the text need names of their own")
    kept = [c for c in docs.columns if c.lower() not in added]
    body, draw, units = (free_name(docs, c) for c in ("body", "draw", "units"))
    rows = docs.select(*map(col, kept), F.coalesce(col(text), F.lit("")).alias(body))
    rows = rows.select("*", F.array(*draws(col(id_column), seed)).alias(draw), marked(col(body), unit).alias(units))
    rows = rows.withColumn("n", count_units(col(units)).cast("long"))
    h = [F.get(col(draw), F.lit(k)) for k in range(4)]
    tagged = F.lit(False)
    for tag in tags:
        tagged = tagged | F.contains(col(body), F.lit(tag))
    stays = (col(body) == "") | tagged | (h[2] % 100 >= rate)
    rows = rows.withColumn("form", F.when(stays, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm"))
    first, second = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    low, high = F.least(first, second).cast("int"), F.greatest(first, second).cast("int")
    cut = lambda part: F.when(F.col("form") != "plain", plain(part))
    rows = rows.withColumns({
        "prefix": cut(cut_at(col(units), low)),
        "middle": cut(cut_at(cut_at(col(units), high), low - high)),
        "suffix": cut(cut_at(col(units), high - F.col("n").cast("int") - 1)),
    })
    output = assemble(F.col("form"), col(body), F.col("prefix"), F.col("middle"), F.col("suffix"), tags)
    return rows.withColumn("output", output).select(*map(col, kept), *added)
