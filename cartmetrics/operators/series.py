"""Time series per key: lags, gaps, rolling means, streaks, growth and adstock.

A window here is partitioned by a brand x channel key and ordered by period, on rows that are already
aggregated to one row per key and period. Its size is the number of periods, whatever the size or
skew of the facts below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import round_score, safe_divide
from cartmetrics.operators.percentiles import percentiles


def _by(keys: Sequence[str], order: str):
    return W.partitionBy(*keys).orderBy(order)


def share_of_total(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with their percentage of all rows. The total is a scalar subquery, so no task
    sees all groups."""
    counts = df.groupBy(col).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct_rows", F.col("n_rows") * 100.0 / total)


def period_lags(
    df: DataFrame, keys: Sequence[str], order: str, lags: Mapping[str, Sequence[int]], require: str | None = None
) -> DataFrame:
    """Lags in rows and differences to them: ``{column: [13, 52]}`` adds ``column_lag_13`` and
    ``column_change_13``. ``require`` names a lag column that must not be NULL."""
    window = _by(keys, order)
    lagged = {f"{c}_lag_{n}": F.lag(c, n).over(window) for c, ns in lags.items() for n in ns}
    out = df.withColumns(lagged)
    out = out.withColumns({f"{c}_change_{n}": F.col(c) - F.col(f"{c}_lag_{n}") for c, ns in lags.items() for n in ns})
    return out.filter(F.col(require).isNotNull()) if require else out


def month_over_month_change(df: DataFrame, keys: Sequence[str], order: str, score: str) -> DataFrame:
    """Mean, exact 90th percentile and maximum of the absolute change to the previous period.

    Changes are rounded to nine digits, which only takes the noise of the subtraction away.
    """
    moved = df.withColumn("_change", F.round(F.abs(F.col(score) - F.lag(score).over(_by(keys, order))), 9))
    moved = moved.filter(F.col("_change").isNotNull())
    out = moved.agg(F.avg("_change").alias("mean_change"), F.max("_change").alias("max_change"), F.count("*").alias("n_changes"))
    p90 = percentiles(moved, "_change", [0.90]).scalar()
    return out.select("mean_change", p90.alias("p90_change"), "max_change", "n_changes")


def temporal_gaps(df: DataFrame, date: str, keys: Sequence[str] = (), minimum: int = 2) -> DataFrame:
    """Weeks whose previous week with data lies more than ``minimum`` weeks back.

    The window runs over distinct weeks: the calendar bounds it, also without keys.
    """
    weeks = df.select(*keys, F.trunc(date, "week").alias("week_start")).filter(F.col("week_start").isNotNull())
    weeks = weeks.distinct()
    previous = F.lag("week_start").over(W.partitionBy(*keys).orderBy("week_start"))
    out = weeks.withColumn("prev_week", previous)
    out = out.withColumn("gap_weeks", (F.datediff("week_start", "prev_week") / 7).cast("int"))
    return out.filter(F.col("gap_weeks") > minimum)


def key_cardinality_window(items: DataFrame, key: str = "sku_ean_cod", active: str = "is_active") -> DataFrame:
    """Each product row with the number of products and active products of its bar code.

    Counts are aggregated per code and joined back instead of run as a window, so a code that a
    third of the rows share is split by the skew join and not sorted in one task. NULL codes join
    nothing and get their own status.
    """
    counts = items.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count("mat_idt").alias("ean_mat_idt_count"),
        F.sum(F.col(active).cast("int")).alias("active_mat_idt_count_for_ean"),
    )
    out = items.join(counts, items[key] == counts["_key"], "left").drop("_key")
    n, a = F.col("ean_mat_idt_count"), F.col("active_mat_idt_count_for_ean")
    status = (
        F.when(n == 1, "UNIQUE_EAN")
        .when((n > 1) & (a == 1), "MULTI_MAT_IDT_INACTIVE_HISTORY")
        .when((n > 1) & (a > 1), "MULTI_MAT_IDT_ACTIVE_CONFLICT")
        .otherwise("NULL_EAN")
    )
    preferred = (status == "UNIQUE_EAN") | ((status == "MULTI_MAT_IDT_INACTIVE_HISTORY") & F.col(active))
    return out.withColumns({"ean_cardinality_status": status, "is_preferred": preferred})


def rolling_score(df: DataFrame, keys: Sequence[str], order: str, score: str, points: int = 4, minimum: int = 2) -> DataFrame:
    """Mean of the last points, NULL until there are enough, rounded to one decimal."""
    window = _by(keys, order).rowsBetween(-(points - 1), 0)
    mean = F.when(F.count(score).over(window) >= minimum, round_score(F.avg(score).over(window)))
    return df.withColumn(f"{score}_{points}w_avg", mean)


def consecutive_alert(
    df: DataFrame, keys: Sequence[str], order: str, score: str, threshold: float = 70.0, periods: int = 2
) -> DataFrame:
    """True when the score exceeded the threshold in this and the preceding periods."""
    window = _by(keys, order).rowsBetween(-(periods - 1), 0)
    high = F.coalesce((F.col(score) > threshold).cast("int"), F.lit(0))
    return df.withColumn("alert_flag", F.sum(high).over(window) == periods)


def consecutive_miss_streak(
    df: DataFrame, keys: Sequence[str], order: str,
    forecast: str = "forecasted_units", actual: str = "actual_units", minimum: int = 3,
) -> DataFrame:
    """Length of the current run of misses in one direction. A hit ends a run.

    A new run starts where the direction differs from the previous row; the running count of starts
    numbers the runs, and the position inside a run is its length so far.
    """
    window = _by(keys, order)
    out = df.withColumn("miss_direction", F.signum(F.col(forecast) - F.col(actual)).cast("int"))
    before = F.lag("miss_direction").over(window)
    start = (before.isNull() | (before != F.col("miss_direction"))).cast("int")
    out = out.withColumn("_start", start).withColumn("_run", F.sum("_start").over(window))
    position = F.row_number().over(W.partitionBy(*keys, "_run").orderBy(order))
    streak = F.when(F.col("miss_direction") != 0, position).otherwise(0)
    return out.withColumns({"miss_streak": streak, "forecast_review": streak >= minimum}).drop("_start", "_run")


def share_change(df: DataFrame, keys: Sequence[str], order: str, share: str, month: str | None = None) -> DataFrame:
    """Share minus the previous row's, NULL and flagged for a new entrant.

    With ``month``, a date column, it is minus the share of the calendar month before: a missing month
    gives NULL and not the change over a longer time."""
    previous = calendar_value(keys, month, share, 1) if month else F.lag(share).over(_by(keys, order))
    first = F.row_number().over(_by(keys, order)) == 1
    return df.withColumns({"share_change_pp": F.col(share) - previous, "new_entrant": first})


def calendar_value(keys: Sequence[str], date: str, value: str, months: int = 12, weeks: int = 0) -> Column:
    """Value of the same key some calendar months (or weeks) earlier, NULL if there is none.

    A range frame of width zero on the period number picks exactly that period, so a gap in the
    series gives NULL and not the value of another period, and no self join is needed.
    """
    if weeks:
        number, back = F.floor(F.datediff(F.col(date), F.lit("1970-01-05").cast("date")) / 7), weeks
    else:
        number, back = F.year(date) * 12 + F.month(date), months
    frame = W.partitionBy(*keys).orderBy(number.cast("int")).rangeBetween(-back, -back)
    return F.max(value).over(frame)


def growth_to_earlier(df: DataFrame, keys: Sequence[str], date: str, value: str, months: int = 12, weeks: int = 0) -> DataFrame:
    """Value over the value at the same calendar point earlier, minus 1. One row per key and period."""
    out = df.withColumn("prior_value", calendar_value(keys, date, value, months, weeks))
    return out.withColumn("growth", safe_divide(F.col(value), F.col("prior_value")) - 1)


#: Weeks that decayed() collects before it puts them away, so that no step copies all weeks before it.
BLOCK = 64


def decayed(series: Column, decay: Column) -> Column:
    """Running a(t) = x(t) + decay * a(t-1) over an array of {t, x}, gaps decaying by their length.

    The fold carries the last value and the weeks of the current block. A full block moves to the list of blocks, so a
    week is copied some BLOCK / 2 times and not once per later week.
    """
    item = "struct<t:int,spend:double,adstock:double>"
    empty = F.struct(
        F.lit(None).cast("int").alias("t"), F.lit(0.0).alias("a"),
        F.array().cast(f"array<{item}>").alias("block"), F.array().cast(f"array<array<{item}>>").alias("blocks"),
    )

    def step(acc: Column, row: Column) -> Column:
        steps = F.coalesce(row["t"] - acc["t"], F.lit(0))
        a = row["x"] + F.pow(decay, steps) * acc["a"]
        full = F.size(acc["block"]) == BLOCK
        new = F.array(F.struct(row["t"].alias("t"), row["x"].alias("spend"), a.alias("adstock")))
        block = F.when(full, new).otherwise(F.concat(acc["block"], new))
        blocks = F.when(full, F.concat(acc["blocks"], F.array(acc["block"]))).otherwise(acc["blocks"])
        return F.struct(row["t"].alias("t"), a.alias("a"), block.alias("block"), blocks.alias("blocks"))

    return F.aggregate(series, empty, step, lambda acc: F.flatten(F.concat(acc["blocks"], F.array(acc["block"]))))


def weekly_arrays(df: DataFrame, keys: Sequence[str], week: str, **values: str) -> DataFrame:
    """One row per key with its weeks as a sorted array of {t = week number, values}.

    Rows are first added up by week, so an array is as long as the calendar and not as the facts.
    """
    origin = F.lit("1970-01-05").cast("date")
    number = F.floor(F.datediff(F.col(week), origin) / 7).cast("int")
    base = df.groupBy(*keys, number.alias("_t")).agg(*[F.sum(c).cast("double").alias(f"_{n}") for n, c in values.items()])
    item = F.struct(F.col("_t").alias("t"), *[F.coalesce(F.col(f"_{n}"), F.lit(0.0)).alias(n) for n in values])
    return base.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("series"))


def week_date(number: Column) -> Column:
    return F.date_add(F.lit("1970-01-05").cast("date"), number * 7)


def adstock(df: DataFrame, keys: Sequence[str], week: str, spend: str, decay: float = 0.5) -> DataFrame:
    """Carry-over of spend per key and week: a(t) = spend(t) + decay * a(t-1)."""
    arrays = weekly_arrays(df, keys, week, x=spend)
    rows = arrays.select(*keys, F.inline(decayed(F.col("series"), F.lit(float(decay)))))
    return rows.select(*keys, week_date(F.col("t")).alias(week), "spend", "adstock")


def lag_rolling_features(
    weekly: DataFrame, keys: Sequence[str], week: str, units: str,
    lags: Sequence[int] = (4, 8, 13), windows: Sequence[int] = (4, 13),
    other_lags: Mapping[str, int] | None = None, promo: str | None = None,
) -> DataFrame:
    """Forecast features per week: unit lags and rolling means, lags of other columns, quarter, age
    since the first week and weeks since the last promotion. Lags follow the calendar."""
    window = _by(keys, "_t")
    number = F.floor(F.datediff(F.col(week), F.lit("1970-01-05").cast("date")) / 7).cast("int")
    out = weekly.withColumn("_t", number)

    def at(col: str, n: int) -> Column:
        """Value exactly n weeks back: the only row of the range frame, or NULL."""
        return F.max(col).over(window.rangeBetween(-n, -n))

    features = {f"{units}_lag{n}w": at(units, n) for n in lags}
    features |= {f"{units}_rolling_mean_{n}w": F.avg(units).over(window.rangeBetween(-(n - 1), 0)) for n in windows}
    features |= {f"{c}_lag{n}w": at(c, n) for c, n in (other_lags or {}).items()}
    features["sku_age_weeks"] = F.col("_t") - F.min("_t").over(W.partitionBy(*keys))
    features["season"] = F.concat(F.lit("Q"), F.quarter(week).cast("string"))
    if promo:
        last = F.max(F.when(F.col(promo), F.col("_t"))).over(window.rangeBetween(W.unboundedPreceding, 0))
        features["weeks_since_promotion"] = F.col("_t") - last
        features["is_promotion_active"] = F.col(promo)
    return out.withColumns(features).drop("_t")
