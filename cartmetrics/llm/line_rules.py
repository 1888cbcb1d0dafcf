"""Quality rules from line frequencies across documents, with built-in functions only.

Per text: counts of words, symbols, repeated lines and words in repeated windows. Across texts:
normalised lines are hashed and counted by distinct documents of a host; lines above the limits are
taken out, and documents of which too little is left are rejected. Copies and near copies of a document
count as one representative, so that they don't condemn each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.llm.common import SPACE, words_of

WINDOW = 8
MIN_WORDS = 20
#: Of the words, in percent: the most that may stand in repeated windows, the least that lines must leave.
MAX_REPEATED, MIN_LEFT = 30, 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that stand in windows of WINDOW words found twice or more, the first time included."""
    last = F.size(words) - WINDOW
    hashes = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
        step = F.aggregate(places, start, lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["at"])).alias("n")))
        return step["n"]

    def places(found: Column) -> Column:
        pairs = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda a, x, j: (F.get(a, j - 1)["h"] == x["h"]) | (F.get(a, j + 1)["h"] == x["h"])
        return let(pairs, lambda a: F.array_sort(F.transform(F.filter(a, lambda x, j: F.coalesce(twice(a, x, j), F.lit(False))), lambda x: x["i"])))

    some = lambda found: F.when(F.size(F.array_distinct(found)) < F.size(found), covered(places(found))).otherwise(0)
    return F.when(last > 0, let(hashes, some)).otherwise(0).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """Adds the base counts and base_failed to docs (text); null counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE + "+", "")) > 0)
    counted = docs.select(
        "*",
        let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))).alias("_w"),
        (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    out = counted.withColumns({"n_words": F.col("_w.n"), "n_repeat_words": F.col("_w.r")}).drop("_w")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def line_rules(docs: DataFrame, host: str = "source", percent: float = 2.0, least: int = 3) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_words_left
    for each row of docs (doc_id, text and the host column).

    A line is boilerplate of its host when more than `percent` of the host's distinct texts hold it, and at least
    `least` (two documents may quote each other). Lines are compared in lower case with single spaces. A document is
    rejected if the base rule fails, or if without such lines fewer than MIN_WORDS words or MIN_LEFT percent of its
    words are left.

    Copies of a text count once. Near copies must not condemn each other: a text counts on its own only if at least
    MIN_LEFT percent of its words stand in lines below the limit; texts made of shared lines count once for all those
    with the same first of these lines, by number. So a banner goes as soon as enough pages with content of their own
    have it, and with it the pages that consist of it.

    Null and empty texts: counts 0, base_failed true. Null hosts are one host. Repeated rows get the
    same verdict each; rows with the same doc_id are judged by their own text. An empty table gives no rows. A text is
    split within one task, whatever its length. Other columns are ignored.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    rows = rows.withColumn("print", F.coalesce(F.unhex(F.md5(F.coalesce("text", F.lit("")))), F.lit(b"")))
    split = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.lower(F.trim(F.regexp_replace(x, SPACE + "+", " ")))), lambda x: x != "")
    number = lambda x: F.conv(F.substring(F.md5(x), 1, 15), 16, 10).cast("long")
    cells = F.transform(split, lambda x: F.struct(number(x).alias("line"), F.size(F.split(x, " ")).alias("words")))
    texts = rows.select("host", "print", cells.alias("c")).where(F.size("c") > 0).groupBy("host", "print").agg(F.first("c").alias("c"))
    hosts = texts.groupBy("host").agg(F.count("c").alias("texts"))  # c, not *: so Spark reads the texts that it has

    def above(counted: DataFrame) -> DataFrame:
        """Lines (host, line, n) over both limits."""
        return counted.where(F.col("n") >= least).join(hosts, "host").where(100 * F.col("n") > percent * F.col("texts")).select("host", "line")

    held = texts.select("host", F.explode(F.array_distinct(F.transform("c", lambda x: x["line"]))).alias("line"))
    shared = above(held.groupBy("host", "line").agg(F.count("*").alias("n")))
    # All lines of all texts meet the few shared ones, always in the same way: left to itself, Spark moves them or not by which
    # stage ends first, at twice the disk. Only the hits move on, and come to their texts, which stay where they are.
    lines = texts.select("host", "print", F.explode("c").alias("c")).select("host", "print", "c.line", "c.words")
    taken = lines.join(shared.hint("merge"), ["host", "line"])
    hits = taken.groupBy("host", "print").agg(F.sum("words").alias("words"), F.collect_set("line").alias("lines"))
    sums = texts.join(hits, ["host", "print"]).select(
        "host", "lines", F.aggregate("c", F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("all"), "words",
        F.array_min(F.array_except(F.transform("c", lambda x: x["line"]), "lines")).alias("first_own"), F.array_min("lines").alias("first_shared"),
    )
    stands = 100 * (F.col("all") - F.col("words")) >= MIN_LEFT * F.col("all")
    witness = F.struct(stands.alias("own"), F.when(stands, F.col("first_own")).otherwise(F.col("first_shared")).alias("line"))
    seen = sums.select("host", witness.alias("witness"), F.explode("lines").alias("line"))
    boilerplate = above(seen.groupBy("host", "line", "witness").agg(F.lit(1)).groupBy("host", "line").agg(F.count("*").alias("n")))
    removed = taken.join(boilerplate, ["host", "line"]).groupBy("host", "print").agg(F.sum("words").alias("removed"))
    counts = text_counts(rows).drop("text")
    joined = counts.join(removed, ["host", "print"], "left").withColumn("n_words_left", F.col("n_words") - F.coalesce("removed", F.lit(0)))
    enough = (F.col("n_words_left") >= MIN_WORDS) & (100 * F.col("n_words_left") >= MIN_LEFT * F.col("n_words"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return joined.select(*names, (~F.col("base_failed") & enough).alias("kept"), "n_words_left")
