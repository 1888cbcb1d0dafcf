"""Mixing sources to target weights: hierarchical token budgets, with built-in functions only.

The budget flows down a tree (domain, language, source). Among siblings it follows their weights up
to what each subtree can give (its tokens times the most epochs); what a short one can't use goes to
its siblings first, and only what all of them together can't use goes to the siblings of their parent.
Each leaf then gives whole epochs and a prefix of one more, in an order seeded by epoch and document.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartmetrics.llm.common import cut

#: Leading hex digits of the order key by which a leaf's tokens are summed before single rows are looked at.
BUCKET_DIGITS = 4


def count_words(text: Column) -> Column:
    """Number of words of a text (null: 0). Each word is replaced by one character: regexp_count would hold all words of
    a text as strings of their own."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], float]) -> Column:
    """Weight of the node in the columns `path`; 1 where none is stated."""
    out = F.lit(1.0)
    for key, value in weights.items():
        if len(key) == len(path):
            same = F.lit(True)
            for name, part in zip(path, key, strict=True):
                same = same & (F.col(name) == part)
            out = F.when(same, F.lit(float(value))).otherwise(out)
    return out


def leaf_budgets(leaves: DataFrame, path: Sequence[str], weights: Mapping[tuple[str, ...], float], share: float, max_epochs: int) -> DataFrame:
    """Adds `budget` (whole tokens) to leaves (path columns, tokens)."""
    leaves = leaves.withColumn("cap", (F.col("tokens") * max_epochs).cast("double"))
    top = leaves.agg(F.least(F.sum("tokens") * F.lit(float(share)), F.sum("cap")).alias("given"))
    given = None
    for depth in range(1, len(path) + 1):
        names, parent = list(path[:depth]), list(path[: depth - 1])
        nodes = leaves.groupBy(*names).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(names, weights))
        nodes = nodes.withColumn("given", top.scalar()) if given is None else nodes.join(given, parent)
        siblings = Window.partitionBy(*(parent or [F.lit(0)]))
        before = siblings.orderBy(F.coalesce(F.col("cap") / F.nullif(F.col("w"), F.lit(0.0)), F.lit(float("inf"))), *names).rowsBetween(Window.unboundedPreceding, -1)
        left = F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        weight = F.sum("w").over(siblings) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
        # Nodes by rising capacity per weight: the level rises while they fill up, and falls after.
        nodes = nodes.withColumn("level", left / F.when(weight > 1e-12, weight))
        nodes = nodes.withColumn("level", F.max("level").over(siblings))
        given = nodes.select(*names, F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.lit(0.0))).alias("given"))
    return leaves.join(given, list(path)).withColumn("budget", F.floor(F.round("given", 6)).cast("long")).drop("given", "cap")


def leaf_cuts(docs: DataFrame, path: Sequence[str], weights: Mapping[tuple[str, ...], float], share: float, max_epochs: int, seed: int) -> DataFrame:
    """Per leaf: its budget, how many epochs it gives whole, and the last order key that it gives of the next."""
    path = list(path)
    leaves = cut(leaf_budgets(docs.groupBy(*path).agg(F.sum("n_tokens").alias("tokens")), path, weights, share, max_epochs))
    per = F.when(F.col("tokens") > 0, F.col("tokens"))
    leaves = leaves.withColumn("epochs", F.coalesce(F.floor(F.col("budget") / per), F.lit(0)).cast("long"))
    leaves = leaves.withColumn("rest", F.coalesce(F.col("budget") - F.col("epochs") * F.col("tokens"), F.lit(0)))
    keyed = docs.join(leaves.select(*path, "epochs", "rest"), path)
    keyed = keyed.select(*path, "rest", "n_tokens", order_key(seed, F.col("epochs"), F.col("doc_id")).alias("key")).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*path, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*path).orderBy("bucket"))
    edge = sums.withColumn("upto", upto).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
    edge = edge.groupBy(*path).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("start"))).alias("e")).select(*path, F.col("e.bucket").alias("bucket"), F.col("e.start").alias("start"))
    # Only the bucket that holds the end of the prefix is looked at row by row.
    inside = keyed.join(edge, [*path, "bucket"]).withColumn("upto", F.col("start") + F.sum("n_tokens").over(Window.partitionBy(*path, "bucket").orderBy("key")))
    last = inside.groupBy(*path).agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))).alias("key"), F.min("bucket").alias("bucket"))
    cuts = leaves.join(last, path, "left").select(*path, "tokens", "budget", "epochs", F.coalesce("key", "bucket").alias("last_key"))
    return cut(cuts)


def mix_sources(
    docs: DataFrame, path: Sequence[str], weights: Mapping[tuple[str, ...], float], share: float = 1.0, max_epochs: int = 4, seed: int = 0, tokens: Column | None = None
) -> DataFrame:
    """docs (all columns, doc_id and the path columns among them) once per epoch that takes the row, with
    columns epoch, n_tokens and budget (of the leaf) added; columns of these names are replaced.

    path: columns from the root to the leaves. weights: weight of a node by its path's values, 1 unless
    stated, 0 excludes it. The whole budget is `share` of all tokens, at most `max_epochs` times them.
    n_tokens: `tokens`, or the number of words of the whole text. A leaf gives whole epochs while its
    budget lasts, then the documents of the next one in seeded order as long as their sum fits. Rows with
    the same doc_id are taken together.

    Null path values count as empty strings and null or empty texts as 0 tokens; a leaf without tokens
    gives nothing. Repeated rows are taken each. An empty table gives an empty result.
    """
    path = list(path)
    count = count_words(F.col("text")) if tokens is None else tokens
    own = [c for c in docs.columns if c not in ("epoch", "n_tokens", "budget")]
    keys = [f"_leaf{i}" for i in range(len(path))]
    # The row travels as one value, so that no column of docs can meet a column of the steps.
    leaf = {k: F.coalesce(F.col(p).cast("string"), F.lit("")).alias(k) for k, p in zip(keys, path, strict=True)}
    rows = docs.select("doc_id", count.alias("n_tokens"), *leaf.values(), F.struct(*own).alias("row"))
    named = {tuple(k): v for k, v in weights.items()}
    # The texts are counted once for all that is summed up from the counts.
    cuts = leaf_cuts(cut(rows.select("doc_id", "n_tokens", *keys)), keys, named, share, max_epochs, seed)
    met = rows.join(cuts.withColumnRenamed("epochs", "_epochs").withColumnRenamed("last_key", "_last").drop("tokens"), keys)
    partial = F.coalesce(order_key(seed, F.col("_epochs"), F.col("doc_id")) <= F.col("_last"), F.lit(False))
    times = F.col("_epochs") + partial.cast("long")
    taken = met.where(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    return taken.select("row.*", "epoch", "n_tokens", "budget")
