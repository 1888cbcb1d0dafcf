"""Top values and set comparisons of label columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import norm_key, safe_divide


def top_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent values with their percentage of all rows; ties go by value."""
    counts = df.groupBy(col).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    top = counts.orderBy(F.desc("n_rows"), F.asc_nulls_first(col)).limit(n)
    return top.select(col, "n_rows", (F.col("n_rows") * 100.0 / total).alias("pct_rows"))


def best_column_select(scores: DataFrame, source: str, column: str, score: str) -> DataFrame:
    """Highest-scoring column per source; ties go to the first name."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(column).alias("c"), F.col(score).alias("best")))
    out = scores.filter(F.col(score).isNotNull()).groupBy(source).agg(best.alias("_b"))
    return out.select(source, F.col("_b.best").alias("best_score"), F.col("_b.c").alias("best_column"))


def ordered_output(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*keys)


def distinct_values(df: DataFrame, col: str, out: str = "value") -> DataFrame:
    return df.select(norm_key(F.col(col)).alias(out)).filter(F.col(out).isNotNull()).distinct()


def _membership(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    a = distinct_values(left, left_col).withColumn("_in_left", F.lit(True))
    b = distinct_values(right, right_col).withColumn("_in_right", F.lit(True))
    return a.join(b, "value", "full")


def overlap_membership(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Every value once, labelled with the side or sides that hold it."""
    label = (
        F.when(F.col("_in_left") & F.col("_in_right"), "IN_BOTH")
        .when(F.col("_in_left"), "LEFT_ONLY")
        .otherwise("RIGHT_ONLY")
    )
    return _membership(left, right, left_col, right_col).select("value", label.alias("membership"))


def _overlap_counts(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    both = F.col("_in_left") & F.col("_in_right")
    return _membership(left, right, left_col, right_col).agg(
        F.count_if(both).alias("in_both"),
        F.count_if(F.col("_in_right").isNull()).alias("left_only"),
        F.count_if(F.col("_in_left").isNull()).alias("right_only"),
    )


def value_overlap(left: DataFrame, right: DataFrame, left_col: str, right_col: str, minimum_pct: float = 70.0) -> DataFrame:
    """Share of the left values found on the right, against a threshold."""
    out = _overlap_counts(left, right, left_col, right_col)
    pct = safe_divide(F.col("in_both") * 100.0, F.col("in_both") + F.col("left_only"))
    return out.withColumns(
        {"match_pct": pct, "status": F.when(pct < minimum_pct, "WARN").otherwise("PASS")}
    )


def jaccard_overlap(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Intersection over union in percent, and an alignment score that also grows with its size."""
    out = _overlap_counts(left, right, left_col, right_col)
    pct = F.round(
        F.coalesce(
            safe_divide(F.col("in_both") * 100.0, F.col("in_both") + F.col("left_only") + F.col("right_only")), F.lit(0.0)
        ),
        2,
    )
    return out.withColumns(
        {"overlap_pct": pct, "alignment_score": F.round(F.log1p("in_both") * pct / 100.0, 4)}
    )


def presence_seed(left: DataFrame, right: DataFrame, left_col: str, right_col: str, left_name: str, right_name: str) -> DataFrame:
    """Values of both sides with the source that contributes them and whether the other has them."""
    return _membership(left, right, left_col, right_col).select(
        "value",
        F.when(F.col("_in_left"), left_name).otherwise(right_name).alias("source"),
        (F.col("_in_left") & F.col("_in_right")).isNotNull().alias("in_other_source"),
    )


def pairwise_overlap_matrix(sets: Mapping[str, DataFrame]) -> DataFrame:
    """Number of shared values of every pair of sets, and of all sets together.

    Each value becomes one row with a true/false flag per set; the pair counts are conditional
    counts over these rows. Nothing is paired up, whatever the size of the sets.
    """
    tagged = [df.select(F.col("value"), F.lit(name).alias("_set")) for name, df in sets.items()]
    names = list(sets)
    flags = [F.max(F.col("_set") == n).alias(f"_{i}") for i, n in enumerate(names)]
    per_value = reduce(lambda a, b: a.unionByName(b), tagged).groupBy("value").agg(*flags)

    def shared(members: Sequence[int]) -> Column:
        return F.count_if(reduce(lambda a, b: a & b, [F.col(f"_{i}") for i in members]))

    pairs = {f"{names[i]}|{names[j]}": [i, j] for i in range(len(names)) for j in range(i + 1, len(names))}
    pairs["ALL"] = list(range(len(names)))
    wide = per_value.agg(*[shared(m).alias(f"p{k}") for k, m in enumerate(pairs.values())])
    rows = [F.struct(F.lit(p).alias("pair"), F.col(f"p{k}").alias("shared_values")) for k, p in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))
