"""Model fits by grid search and least squares, one key at a time but spread over the cluster.

Series are weekly arrays (as long as the calendar), folded without exploding them; the regression is solved from the
moments of each key in column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import hill_response, safe_divide
from cartmetrics.operators.series import decayed, weekly_arrays


def winsorize(df: DataFrame, keys: Sequence[str], col: str, p: float = 0.99) -> DataFrame:
    """Values above the p-percentile of their key are set to it.

    Input is a series with one row per key and week, so the exact percentile of a key holds as many
    values as there are weeks.
    """
    caps = df.groupBy(*keys).agg(F.percentile(col, F.lit(p)).alias("_cap"))
    out = df.join(caps, list(keys), "left")
    return out.withColumn(f"{col}_capped", F.least(F.col(col), F.col("_cap"))).drop("_cap")


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation, NULL when one side does not vary."""
    return safe_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def decay_grid(low: float = 0.1, high: float = 0.9, step: float = 0.1) -> list[float]:
    return [round(low + i * step, 6) for i in range(int(round((high - low) / step)) + 1)]


def adstock_decay_fit(
    df: DataFrame, keys: Sequence[str], week: str, spend: str, units: str, grid: Sequence[float] | None = None
) -> DataFrame:
    """Decay of the grid whose adstock correlates best with units, per key.

    One fold over the weekly array of a key carries, for all decays at once, the running adstock and its sums, squares
    and products with the units, from which the correlations follow: nothing is exploded or kept per week. Equal
    correlations (to nine digits) go to the smaller decay; series that do not vary have none.
    """
    grid = [float(g) for g in grid or decay_grid()]
    arrays = weekly_arrays(df, keys, week, x=spend, units=units)
    zeros = F.array(*[F.lit(0.0)] * len(grid))
    empty = F.struct(
        F.lit(None).cast("int").alias("t"), F.lit(0).alias("n"), F.lit(0.0).alias("y"), F.lit(0.0).alias("yy"),
        zeros.alias("a"), zeros.alias("s"), zeros.alias("ss"), zeros.alias("sy"),
    )

    def step(acc: Column, row: Column) -> Column:
        gap = F.coalesce(row["t"] - acc["t"], F.lit(0))
        stock = F.transform(F.array(*[F.lit(g) for g in grid]), lambda g, i: row["x"] + F.pow(g, gap) * F.get(acc["a"], i))
        y = row["units"]
        return F.struct(
            row["t"].alias("t"), (acc["n"] + 1).alias("n"), (acc["y"] + y).alias("y"), (acc["yy"] + y * y).alias("yy"),
            stock.alias("a"),
            F.zip_with(acc["s"], stock, lambda s, a: s + a).alias("s"),
            F.zip_with(acc["ss"], stock, lambda s, a: s + a * a).alias("ss"),
            F.zip_with(acc["sy"], stock, lambda s, a: s + a * y).alias("sy"),
        )

    varies = lambda spread, total: F.when(spread > total * 1e-12, spread)

    def scores(m: Column) -> Column:
        """Correlations from the sums, with the smaller of equal decays last in order."""
        n, y = m["n"], varies(m["n"] * m["yy"] - m["y"] * m["y"], m["n"] * m["yy"])

        def score(g: Column, i: Column) -> Column:
            s, ss = F.get(m["s"], i), F.get(m["ss"], i)
            r = (n * F.get(m["sy"], i) - s * m["y"]) / F.sqrt(varies(n * ss - s * s, n * ss) * y)
            return F.struct(F.round(r, 9).alias("r"), (-g).alias("d"))

        return F.transform(F.array(*[F.lit(g) for g in grid]), score)

    best = F.array_max(F.filter(F.aggregate("series", empty, step, scores), lambda x: x["r"].isNotNull()))
    # The generator keeps the fold from being computed once per use of its result.
    out = arrays.select(*keys, F.explode(F.array_compact(F.array(best))).alias("_b"))
    return out.select(*keys, (-F.col("_b.d")).alias("decay_rate"), F.col("_b.r").alias("correlation"))


def hill_fit(
    df: DataFrame, keys: Sequence[str], x: str, y: str,
    k_multipliers: Sequence[float] = (0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0),
    alphas: Sequence[float] = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0),
) -> DataFrame:
    """Half-saturation point and steepness with the least squared error of y = b * hill(x), per key.

    For every grid point the best scale b and its error follow from three sums, so the fit is one
    aggregate over rows x grid with map-side combining.
    """
    means = df.groupBy(*keys).agg(F.avg(x).alias("_mean"))
    grid = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(a)).alias("alpha")) for m in k_multipliers for a in alphas])
    points = df.join(means, list(keys)).filter(F.col("_mean") > 0)
    points = points.select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y"), "_mean", F.inline(grid))
    h = hill_response(F.col("_x"), F.col("m") * F.col("_mean"), F.col("alpha"))
    sums = points.withColumn("_h", h).groupBy(*keys, "_mean", "m", "alpha").agg(
        F.sum(F.col("_h") * F.col("_y")).alias("hy"), F.sum(F.col("_h") * F.col("_h")).alias("hh"),
        F.sum(F.col("_y") * F.col("_y")).alias("yy"), F.count("*").alias("n"),
    )
    scale = safe_divide(F.col("hy"), F.col("hh"))
    sse = F.col("yy") - scale * F.col("hy")
    # Errors are compared relative to the total, rounded, so that equal fits tie the same way everywhere.
    rel = F.round(safe_divide(sse, F.col("yy")), 9)
    best = F.min(F.struct(rel.alias("e"), F.col("m").alias("m"), F.col("alpha").alias("a"), scale.alias("b"), F.col("n").alias("n")))
    return sums.groupBy(*keys, "_mean").agg(best.alias("_b")).select(
        *keys, (F.col("_b.m") * F.col("_mean")).alias("hill_k"), F.col("_b.a").alias("hill_alpha"),
        F.col("_b.b").alias("scale"), F.col("_b.e").alias("relative_error"), F.col("_b.n").alias("n_points"),
    )


#: A feature whose variance is, by this share, explained by the features before it counts as dependent on them.
DEPENDENT = 1e-9


def mmm_regression(df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Least-squares coefficients per key, with intercept: n_rows, matrix_rank, <name>_coef, r2.

    Spark aggregates means and covariances per key and eliminates one feature after the other from them (the sweep
    operator), all in column expressions. Rows with a NULL are left out. A feature that is constant or depends on the
    ones before it, as in a key with few rows, gets the coefficient 0 and does not count in matrix_rank. r2 is NULL if
    the target does not vary.
    """
    names = [*features, target]
    complete = df.dropna(subset=names).select(*keys, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    p = len(features)
    cell = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
    moments = [F.covar_pop(f"x{i}", f"x{j}").alias(cell(i, j)) for i in range(p + 1) for j in range(i, p + 1)]
    out = complete.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(p + 1)], *moments)
    # a{i}_{j}: row i of the swept matrix, the target as its last column; the last row ends as what is left unexplained
    start = {f"a{i}_{j}": F.col(cell(i, j)) for i in range(p + 1) for j in range(p + 1)}
    out = out.select(*keys, "n_rows", *[f"m{i}" for i in range(p + 1)], *[c.alias(n) for n, c in start.items()], *[F.col(cell(i, i)).alias(f"v{i}") for i in range(p + 1)])
    for k in range(p):
        pivot = F.when((F.col(f"v{k}") > 0) & (F.col(f"a{k}_{k}") > F.col(f"v{k}") * DEPENDENT), F.col(f"a{k}_{k}"))
        out = out.withColumn(f"p{k}", pivot)
        free, a = F.col(f"p{k}"), lambda i, j: F.col(f"a{i}_{j}")
        swept = {}
        for i in range(p + 1):
            for j in range(p + 1):
                if i == k:
                    new = F.lit(1.0) / free if j == k else a(k, j) / free
                else:
                    new = -a(i, k) / free if j == k else a(i, j) - a(i, k) * a(k, j) / free
                swept[f"a{i}_{j}"] = F.when(free.isNull(), a(i, j)).otherwise(new)
        out = out.withColumns(swept)
    coef = {i: F.when(F.col(f"p{i}").isNull(), 0.0).otherwise(F.col(f"a{i}_{p}")) for i in range(p)}
    intercept = reduce(lambda x, i: x - coef[i] * F.col(f"m{i}"), range(p), F.col(f"m{p}"))
    rank = reduce(lambda x, i: x + F.col(f"p{i}").isNotNull().cast("int"), range(p), F.lit(1))
    return out.select(
        *keys, "n_rows", rank.alias("matrix_rank"), intercept.alias("intercept_coef"),
        *[coef[i].alias(f"{n}_coef") for i, n in enumerate(features)],
        F.when(F.col(f"v{p}") > 0, 1 - F.col(f"a{p}_{p}") / F.col(f"v{p}")).alias("r2"),
    )
