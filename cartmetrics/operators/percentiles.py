"""Exact percentiles of a column of any size.

Equal values are counted once. The counts are cut into ordered bins, whose cumulated sums tell the bin of each wanted
rank; only the values of such a bin are cut again, by the bin's own range, and the last small bins are read in order.
No task gets more than the counts of the bins, or the values of one last bin. Bins follow from the values alone, so
parts of the plan that Spark computes twice agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bins of one round, and rounds after the first one. The first round's bins are even in the logarithm (46 to a factor
#: of e); each further one splits a bin evenly, which leaves some ten thousand doubles in a bin after the second.
BINS, ROUNDS = 65_536, 2


def _log_bin(v: Column) -> Column:
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * 46).cast("int")


def _even_bin(v: Column) -> Column:
    part = (v - F.col("_low")) / (F.col("_high") - F.col("_low")) * (BINS - 1)
    return F.when(F.col("_high") > F.col("_low"), F.floor(part)).otherwise(0).cast("int")


def percentiles(df: DataFrame, column: str | Column, points: Sequence[float]) -> DataFrame:
    """One row with columns p0, p1, ...: the exact percentiles at points (0 to 1), interpolated between neighbours.

    NULL, NaN and infinite values do not count; without any value the percentiles are NULL.
    """
    v = (F.col(column) if isinstance(column, str) else column).cast("double")
    finite = df.select(v.alias("v")).filter(~F.isnan("v") & (F.abs("v") < float("inf")))
    values = finite.groupBy("v").agg(F.count("*").alias("n")).withColumn("_bin", _log_bin(F.col("v")))

    def stats(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("v").alias("_low"), F.max("v").alias("_high"))

    # Ranks are counted from 0; `upto` is the number of rows up to and with a bin.
    bins = stats(values, "_bin")
    bins = bins.withColumns({"upto": F.sum("n").over(W.orderBy("_bin")), "total": F.sum("n").over(W.partitionBy(F.lit(1)))})
    at = [F.lit(float(p)) * (F.col("total") - 1) for p in points]
    ranks = [F.struct(F.lit(2 * i + k).alias("id"), (F.floor(x) if k == 0 else F.ceil(x)).alias("rank")) for i, x in enumerate(at) for k in (0, 1)]

    def holding(rows: DataFrame, wanted: Column, *kept: str) -> DataFrame:
        """The wanted ranks that lie in each bin, counted from its start."""
        before = F.col("upto") - F.col("n")
        inside = F.filter(wanted, lambda x: (x["rank"] >= before) & (x["rank"] < F.col("upto")))
        out = rows.select(*kept, "_low", "_high", before.alias("_before"), F.explode(inside).alias("x"))
        return out.select(*kept, "_low", "_high", F.col("x")["id"].alias("id"), (F.col("x")["rank"] - F.col("_before")).alias("rank"))

    found = holding(bins, F.array(*ranks), "_bin")
    inside = F.col("v").between(F.col("_low"), F.col("_high"))
    for _ in range(ROUNDS):
        near = values.join(found, "_bin").filter(inside)
        parts = stats(near.withColumn("_part", _even_bin(F.col("v"))), "id", "rank", "_bin", "_part")
        parts = parts.withColumn("upto", F.sum("n").over(W.partitionBy("id").orderBy("_part")))
        found = holding(parts, F.array(F.struct("id", "rank")), "_bin")
    near = values.join(found, "_bin").filter(inside)
    near = near.withColumn("upto", F.sum("n").over(W.partitionBy("id").orderBy("v")))
    hit = near.filter((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
    total = bins.agg(F.max("total").alias("total"))
    picked = hit.agg(*[F.max(F.when(F.col("id") == i, F.col("v"))).alias(f"v{i}") for i in range(2 * len(points))])
    out = picked.withColumn("total", total.scalar())
    part = lambda i: at[i] - F.floor(at[i])
    return out.select(*[(F.col(f"v{2 * i}") * (1 - part(i)) + F.col(f"v{2 * i + 1}") * part(i)).alias(f"p{i}") for i in range(len(points))])
