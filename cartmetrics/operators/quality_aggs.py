"""Aggregates that describe keys, labels and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cartmetrics.functions.scalars import safe_divide
from cartmetrics.operators.percentiles import percentiles


def pct(part: Column, whole: Column) -> Column:
    return safe_divide(part * 100.0, whole)


def key_coverage_by_level(df: DataFrame, level: str, code: str) -> DataFrame:
    """Rows, distinct codes and missing codes per hierarchy level."""
    missing = F.count_if(F.col(code).isNull())
    return df.groupBy(level).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(code).alias("distinct_codes"),
        missing.alias("null_codes"),
        pct(missing, F.count("*")).alias("null_pct"),
    )


def dictionary_stats(dictionary: DataFrame, old: str = "old_cus_idt", new: str = "new_cus_idt") -> DataFrame:
    return dictionary.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(old).alias("distinct_old"),
        F.count_distinct(new).alias("distinct_new"),
        F.count_if(F.col(old) == F.col(new)).alias("no_change_rows"),
    )


def brand_label_products(df: DataFrame, raw: str, std: str, product: str) -> DataFrame:
    return df.groupBy(raw, std).agg(F.count_distinct(product).alias("distinct_products"))


def mapped_passthrough_counts(df: DataFrame, raw: str, std: str) -> DataFrame:
    """How many raw labels were mapped to another name and how many passed through unchanged.

    Labels are counted once each with their row weight, so the distinct counts run on the label
    list and not on the facts.
    """
    per_label = df.groupBy(raw, std).agg(F.count("*").alias("_n"))
    changed = F.col(raw).isNotNull() & (F.upper(F.trim(F.col(raw))) != F.col(std))
    return per_label.agg(
        F.count_distinct(raw).alias("distinct_labels"),
        F.count_distinct(F.when(changed, F.col(raw))).alias("mapped_labels"),
        F.count_distinct(F.when(~changed, F.col(raw))).alias("passthrough_labels"),
        pct(F.sum(F.when(F.col(raw).isNull(), F.col("_n")).otherwise(0)), F.sum("_n")).alias("null_pct"),
    )


def mix_variation_profile(df: DataFrame, keys: Sequence[str], spend: str, minimum: float = 0.20) -> DataFrame:
    """Coefficient of variation of spend per key; too little variation hides saturation."""
    out = df.groupBy(*keys).agg(
        F.stddev(spend).alias("spend_stddev"), F.avg(spend).alias("spend_mean")
    )
    cv = safe_divide(F.col("spend_stddev"), F.col("spend_mean"))
    return out.withColumns({"coeff_variation": cv, "saturation_not_observable": cv < minimum})


def score_distribution(df: DataFrame, score: str, minimum_iqr: float = 15.0) -> DataFrame:
    """Exact percentiles and spread of a score. A narrow spread means the weights do not separate.

    The percentiles are those of the scores as they are, see ``percentiles`` for how they stay bounded.
    """
    points = {"p10": 0.10, "p25": 0.25, "p75": 0.75, "p90": 0.90}
    found = percentiles(df, score, list(points.values()))
    whole = found.select(F.struct(*[F.col(f"p{i}").alias(n) for i, n in enumerate(points)])).scalar()
    out = df.agg(F.avg(score).alias("mean"), F.stddev(score).alias("stddev"), F.min(score).alias("min"), F.max(score).alias("max"))
    out = out.withColumn("_p", whole).select(*[F.col("_p")[n].alias(n) for n in points], "mean", "stddev", "min", "max")
    iqr = F.col("p75") - F.col("p25")
    return out.withColumns({"iqr": iqr, "needs_recalibration": iqr < minimum_iqr})


def wape(
    df: DataFrame, by: Sequence[str], forecast: str = "forecasted_units", actual: str = "actual_units", more: Sequence[Column] = (),
    where: Column | None = None,
) -> DataFrame:
    """Sum of absolute errors over sum of actuals, NULL without actuals; ``more`` aggregates go along in the same pass.
    ``where``: rows that count; ``more`` aggregates get the others, too."""
    kept = lambda c: c if where is None else F.when(where, c)
    error = F.sum(kept(F.abs(F.col(forecast) - F.col(actual))))
    return df.groupBy(*by).agg(
        safe_divide(error, F.sum(kept(F.col(actual)))).alias("wape_actual"),
        F.count_distinct(kept(F.col("brand_key"))).alias("n_brands_evaluated"),
        F.count(kept(F.lit(1))).alias("n_skus_evaluated"),
        *more,
    )


def forecast_bias(
    df: DataFrame, keys: Sequence[str], order: str, periods: int,
    forecast: str = "forecasted_units", actual: str = "actual_units",
) -> DataFrame:
    """Mean relative error of the trailing periods; periods without actuals do not count."""
    error = F.when(F.col(actual) != 0, (F.col(forecast) - F.col(actual)) / F.col(actual))
    window = W.partitionBy(*keys).orderBy(order).rowsBetween(-(periods - 1), 0)
    return df.withColumn("forecast_bias", F.avg(error).over(window))


def count_if_audit(df: DataFrame, columns: Sequence[str], active: Column | None = None) -> DataFrame:
    """NULL, blank and NULL-among-active counts of several columns in one pass, one row per column."""
    active = active if active is not None else F.lit(True)
    metrics = [F.count("*").alias("_rows")]
    for c in columns:
        empty = F.col(c).isNull()
        metrics += [
            F.count_if(empty).alias(f"{c}__null"),
            F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"{c}__blank"),
            F.count_if(empty & active).alias(f"{c}__active"),
        ]
    wide = df.agg(*metrics)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("total_rows"),
            F.col(f"{c}__null").alias("null_rows"),
            F.col(f"{c}__blank").alias("blank_rows"),
            F.col(f"{c}__active").alias("null_active_rows"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def ean_cardinality(items: DataFrame, ean: str = "sku_ean_cod") -> DataFrame:
    """Bar codes with more than one product.

    Rows are made distinct first; the distinct counts then spread a bar code shared by very many
    rows over its values. Only the activity flags, a closed vocabulary, are collected.
    """
    rows = items.filter(F.col(ean).isNotNull()).select(ean, "mat_idt", "brand", "mat_lcl_dsc", "is_active").distinct()
    flags = F.array_sort(F.collect_set(F.col("is_active").cast("string")))
    return (
        rows.groupBy(ean)
        .agg(
            F.count_distinct("mat_idt").alias("n_products"),
            F.count_distinct(F.when(F.col("is_active"), F.col("mat_idt"))).alias("n_active_products"),
            F.count_distinct("brand").alias("n_brands"),
            F.count_distinct("mat_lcl_dsc").alias("n_descriptions"),
            F.array_join(flags, ",").alias("active_flags"),
        )
        .filter(F.col("n_products") > 1)
    )


def active_conflict(items: DataFrame, ean: str = "sku_ean_cod") -> DataFrame:
    """Bar codes with more than one active product."""
    active = items.filter(F.col(ean).isNotNull() & F.col("is_active"))
    return (
        active.groupBy(ean)
        .agg(F.count_distinct("mat_idt").alias("n_active_products"))
        .filter(F.col("n_active_products") > 1)
    )


def grain_fanout_ratio(df: DataFrame, keys: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Rows per distinct key combination; above the limit a join on the keys would explode."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    ratio = safe_divide(F.sum("_n") * 1.0, F.count("*"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        ratio.alias("rows_per_key"),
        F.when(ratio > limit, "WARN").otherwise("PASS").alias("status"),
    )
