"""Fill-in-the-middle: cut every text at two token boundaries and put its middle last.

The number of tokens n comes from regexp_count. The cuts a <= b follow from a hash of the document's id, and a pattern
made for the row, (unit{a})(unit{b-a})(rest), captures prefix, middle and suffix in one match, which regexp_replace
writes out in the new order. The unit's repetitions are possessive: the matcher then steps through them in a loop, so
that neither its stack nor its backtracking grows with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The token of the contract, and the three marks.
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The same token for the matcher: a run of white space never has to be given back.
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"


def fim_transform(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """doc_id, n (tokens), form (plain, psm, spm), output, prefix_chars and middle_chars (null if plain) of each row.

    percent of the texts are cut, spm_percent of those as suffix-prefix-middle, the rest as prefix-suffix-middle. The
    choice depends on seed and doc_id only, so it is the same for repeated rows, on every run and for any partitioning.
    A null text is empty; an empty text, and one that holds a mark, stays plain. A null doc_id counts as ''. Texts are
    cut whole, of any length up to what a string of Spark holds. An empty table gives no rows; other columns of docs
    are ignored. One narrow pass without a shuffle; fim_restore undoes it.
    """
    h = lambda k: F.conv(F.substring("_hex", 8 * k - 7, 8), 16, 10).cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256).alias("_hex"))
    rows = rows.select("doc_id", "_text", h(1).alias("_h1"), h(2).alias("_h2"), h(3).alias("_h3"), h(4).alias("_h4"), F.regexp_count("_text", F.lit(UNIT)).cast("long").alias("n"))
    marked = F.greatest(*(F.instr("_text", m) for m in (PREFIX, SUFFIX, MIDDLE))) > 0
    plain = (F.col("n") == 0) | marked | (F.col("_h3") % 100 >= percent)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("_h4") % 100 < spm_percent, "spm").otherwise("psm"))
    cuts = [F.col(x) % (F.col("n") + 1) for x in ("_h1", "_h2")]
    rows = rows.withColumns({"_a": F.least(*cuts), "_b": F.greatest(*cuts)})
    pattern = F.format_string("(?s)^(%1$s{%2$d}+)(%1$s{%3$d}+)(.*+)$", F.lit(UNIT), F.col("_a"), F.col("_b") - F.col("_a"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", pattern, order)))
    prefix, middle, _ = parts(F.col("output"), F.col("form"))
    cut = lambda piece: F.when(F.col("form") != "plain", F.length(piece).cast("long"))
    return rows.select("doc_id", "n", "form", "output", cut(prefix).alias("prefix_chars"), cut(middle).alias("middle_chars"))


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix in an output of either cut form. The first of each mark is the one that was put in."""
    between = lambda a, b: F.substring_index(F.substring(output, F.locate(a, output) + F.lit(len(a)), F.length(output)), b, 1)
    last = F.substring(output, F.locate(MIDDLE, output) + F.lit(len(MIDDLE)), F.length(output))
    spm = form == "spm"
    return F.when(spm, between(PREFIX, MIDDLE)).otherwise(between(PREFIX, SUFFIX)), last, F.when(spm, between(SUFFIX, PREFIX)).otherwise(between(SUFFIX, MIDDLE))


def fim_restore(output: Column, form: Column) -> Column:
    """The text that an output was made from, read from output and form alone."""
    prefix, middle, suffix = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
