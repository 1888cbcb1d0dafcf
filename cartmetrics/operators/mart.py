"""Monthly mart: every KPI, score and recommendation at brand x channel x month.

All inputs are aggregates. The windows of the mart share one partitioning (brand, channel); channel totals come from
one window per channel and month.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators.decisions import recommend, render_rationale
from cartmetrics.operators.joins import mapping_left_join
from cartmetrics.operators.series import (
    calendar_value,
    consecutive_miss_streak,
    rolling_score,
    share_change,
)

KEYS = ["brand_key", "channel_key"]
QUARTER_WEEKS, YEAR_WEEKS, YEAR = 13, 52, 12


def with_growth(base: DataFrame) -> DataFrame:
    """Year-on-year growth of the brand and of its channel, and the difference. One row per key and month.

    Every row is also put as the prior value into its month one year later. One sum per key and month and one per
    channel and month then give all four values: base is read once, and no window holds more than a channel's brands.
    """
    rest = [c for c in base.columns if c not in (*KEYS, "fecha_month")]
    kind = {c: base.schema[c].dataType for c in base.columns}
    no = lambda c: F.lit(None).cast(kind[c])
    own = F.struct("fecha_month", *rest, no("revenue").alias("_prior"), F.lit(True).alias("_own"))
    later = F.add_months("fecha_month", YEAR).cast(kind["fecha_month"]).alias("fecha_month")
    prior = F.struct(later, *[no(c).alias(c) for c in rest], F.col("revenue").alias("_prior"), F.lit(False).alias("_own"))
    both = base.select(*KEYS, F.inline(F.array(own, prior)))
    out = both.groupBy(*KEYS, "fecha_month").agg(*[F.max(c).alias(c) for c in (*rest, "_prior", "_own")])
    cell = W.partitionBy("channel_key", "fecha_month")
    category = (S.safe_divide(F.sum("revenue").over(cell), F.sum("_prior").over(cell)) - 1) * 100
    out = out.withColumns({"sell_out_growth": S.safe_divide(F.col("revenue"), F.col("_prior")) - 1, "market_category_growth_pct": category})
    out = out.filter("_own").drop("_own", "_prior")
    adjusted = S.market_adjusted_growth(F.col("sell_out_growth") * 100, F.col("market_category_growth_pct"))
    return out.withColumn("market_adjusted_growth", adjusted)


def mart_facts(base: DataFrame, shipments: DataFrame, spend: DataFrame) -> DataFrame:
    """Sell-out and market rows with shipments, waste and spend of the same month.

    base: brand_key, channel_key, period_key, fecha_month, revenue, units, market columns, forecast_units and
    actual_units; shipments: the keys, fecha_month, sell_in_units, waste_units, waste_cost and waste_risk_score (0-1,
    from the waste model); spend: the keys, fecha_month and investment_spend.
    """
    on = [*KEYS, "fecha_month"]
    out = base.join(shipments, on, "left").join(spend, on, "left")
    c = F.col
    return out.withColumns(
        {
            "sell_out_sell_in_ratio": S.sell_ratio(c("units"), c("sell_in_units"))["ratio"],
            "waste_rate": S.waste_rate(c("waste_units"), c("sell_in_units"))["waste_rate"],
            "waste_adjusted_roi": S.waste_adjusted_roi(c("revenue"), F.coalesce("waste_cost", F.lit(0.0)), c("investment_spend")),
            "forecast_bias": S.safe_divide(c("forecast_units") - c("actual_units"), c("actual_units")),
            "forecast_accuracy_wape": S.safe_divide(F.abs(c("forecast_units") - c("actual_units")), c("actual_units")),
        }
    )


def with_growth_quality(mart: DataFrame) -> DataFrame:
    """Share change, the five component scores, the growth quality score and its 4-period mean."""
    out = share_change(mart, KEYS, "period_key", "value_share", "fecha_month")
    c = F.col
    parts = S.growth_components(
        c("sell_out_growth") * 100, c("share_change_pp"), c("waste_rate") * 100, c("forecast_accuracy_wape"), c("waste_adjusted_roi")
    )
    out = out.withColumns({f"{name}_score": col for name, col in parts.items()})
    score = S.growth_quality_score({name: c(f"{name}_score") for name in parts})
    out = out.withColumns({"growth_quality_score": score["score"], "gqs_confidence_level": score["confidence"]})
    return rolling_score(out, KEYS, "period_key", "growth_quality_score")


def weekly_competitive_risk(panel: DataFrame, week: str = "week_end") -> DataFrame:
    """Competitive risk of every brand, channel and week from the changes over 13 and 52 weeks.

    panel: brand_key, channel_key, the week's date, n_brands, value_share, numeric_distribution, weighted_distribution,
    price_index_vs_category; one row per key and week. Changes look back by the calendar: a range frame of width zero
    picks exactly the week 13 (or 52) weeks before, and a week that is missing gives NULL, not its neighbour. Weeks
    without a share 13 weeks before have ``has_history`` false.
    """
    back = {
        "_share": ("value_share", QUARTER_WEEKS),
        "_price": ("price_index_vs_category", QUARTER_WEEKS),
        "_num": ("numeric_distribution", QUARTER_WEEKS),
        "_wgt": ("weighted_distribution", QUARTER_WEEKS),
        "_year": ("value_share", YEAR_WEEKS),
    }
    out = panel.withColumns({n: calendar_value(KEYS, week, col, weeks=weeks) for n, (col, weeks) in back.items()})
    c = F.col
    change = {n: c(col) - c(n) for n, (col, _) in back.items()}
    price = S.safe_divide(change["_price"] * 100, c("_price"))
    parts = S.risk_components(change["_share"], price, change["_num"], change["_wgt"], change["_year"])
    risk = S.competitive_risk_score(parts, c("n_brands"))
    named = {"competitive_risk_score": risk["score"], "competitive_risk_confidence": risk["confidence"], "has_history": c("_share").isNotNull()}
    return out.withColumns(named).drop(*back)


def with_competitive_risk(mart: DataFrame, panel: DataFrame, week: str = "week_end", max_lag_weeks: int = 8) -> DataFrame:
    """The risk known at the end of each month: that of the last panel week up to then, and its lag in whole weeks.

    Panels come late, so that week may lie in an earlier month; one that is more than max_lag_weeks old does not count.
    Weeks and months of a key are put in one order, and each month takes the last week before it: no join by ranges.
    """
    weeks = weekly_competitive_risk(panel, week)
    known = F.struct("competitive_risk_score", "competitive_risk_confidence", F.col(week).cast("date").alias("week"))
    weeks = weeks.select(*KEYS, F.col(week).cast("date").alias("_at"), known.alias("_risk"))
    months = mart.withColumns({"_at": F.last_day("fecha_month"), "_month": F.lit(True)})
    both = months.unionByName(weeks, allowMissingColumns=True)
    order = W.partitionBy(*KEYS).orderBy("_at", F.col("_month").asc_nulls_first())
    last = F.last("_risk", ignorenulls=True).over(order)
    out = both.withColumn("_last", last).filter("_month")
    lag = F.floor(F.datediff("_at", F.col("_last")["week"]) / 7).cast("int")
    out = out.withColumn("nielsen_lag_weeks", F.when(lag <= max_lag_weeks, lag))
    fresh = lambda n: F.when(F.col("nielsen_lag_weeks").isNotNull(), F.col("_last")[n])
    names = ("competitive_risk_score", "competitive_risk_confidence")
    return out.withColumns({n: fresh(n) for n in names}).drop("_at", "_month", "_risk", "_last")


def with_recommendation(mart: DataFrame) -> DataFrame:
    """Waste risk class, forecast misses and whole weeks of history, then the recommended action."""
    out = consecutive_miss_streak(mart, KEYS, "period_key", "forecast_units", "actual_units")
    first = F.min("fecha_month").over(W.partitionBy(*KEYS).orderBy("period_key"))
    known = F.datediff(F.add_months("fecha_month", 1), first)
    out = out.withColumns(
        {
            "waste_risk_category": S.waste_risk_bucket(F.col("waste_risk_score")),
            "consecutive_forecast_misses": F.coalesce("miss_streak", F.lit(0)),
            "gqs_4w_avg": F.col("growth_quality_score_4w_avg"),
            "weeks_of_history": F.floor(known / 7).cast("int"),
        }
    )
    return recommend(out)


RATIONALE_SLOTS = {
    "brand_name": "brand_name", "gqs_score_4w_avg": "gqs_4w_avg", "roi": "waste_adjusted_roi", "share_change_pp": "share_change_pp",
    "waste_risk_score": "waste_risk_score", "price_index": "price_index_vs_category",
    "consecutive_forecast_misses": "consecutive_forecast_misses", "weeks_of_history": "weeks_of_history",
}


def fiscal_period(month: Column, fiscal_start_month: int = 1) -> Column:
    """FY<year>-P<month>; a fiscal year is named after the calendar year it ends in."""
    fiscal = F.add_months(month, (13 - fiscal_start_month) % 12)
    return F.concat(F.lit("FY"), F.year(fiscal).cast("string"), F.lit("-P"), F.lpad(F.month(fiscal).cast("string"), 2, "0"))


def monthly_mart(
    base: DataFrame, shipments: DataFrame, spend: DataFrame, panel: DataFrame,
    brands: DataFrame | None = None, channels: DataFrame | None = None, templates: Mapping[str, str] | None = None,
    run_id: str | None = None, fiscal_start_month: int = 1,
) -> DataFrame:
    """The mart with keys, names, volumes, ratios, market view, scores, action, rationale, confidence and audit columns.

    panel: the weekly market panel (see weekly_competitive_risk). brands: brand_key, brand_name; channels: channel_key,
    channel_name, channel_type, stores_expected; without them, names are the keys and the rest is NULL. base may have
    region_key (else 0, all regions) and stores, the number of stores with sales, for sell_out_coverage_pct. templates:
    texts by action with the slots of RATIONALE_SLOTS; without them, the rationale is NULL.
    """
    out = mart_facts(with_growth(base), shipments, spend)
    out = with_recommendation(with_competitive_risk(with_growth_quality(out), panel))
    c = F.col
    none = lambda kind: F.lit(None).cast(kind)
    if brands is None:
        out = out.withColumn("brand_name", c("brand_key").cast("string"))
    else:
        out = mapping_left_join(out, brands, "brand_key", "brand_key", ["brand_name"])
    if channels is None:
        out = out.withColumns({"channel_name": c("channel_key").cast("string"), "channel_type": none("string"), "stores_expected": none("long")})
    else:
        out = mapping_left_join(out, channels, "channel_key", "channel_key", ["channel_name", "channel_type", "stores_expected"])
    stores = c("stores") if "stores" in out.columns else none("double")
    coverage = S.safe_divide(stores * 100.0, c("stores_expected"))
    if templates:
        out = render_rationale(out, RATIONALE_SLOTS, templates)
    else:
        out = out.withColumn("rationale", none("string"))
    return out.select(
        S.surrogate_key(c("brand_key"), c("channel_key"), c("fecha_month")).alias("mart_key"),
        "brand_key", "brand_name", "channel_key", "channel_name", "channel_type",
        (c("region_key") if "region_key" in out.columns else F.lit(0)).alias("region_key"), "fecha_month",
        F.date_format("fecha_month", "yyyyMM").cast("int").alias("month_key"),
        F.year("fecha_month").alias("year_number"), F.month("fecha_month").alias("month_number"),
        fiscal_period(c("fecha_month"), fiscal_start_month).alias("fiscal_period"), "period_key",
        "sell_in_units", c("units").alias("sell_out_units"), "waste_units", c("revenue").alias("sell_out_revenue"),
        "waste_cost", "investment_spend", "sell_out_sell_in_ratio", "waste_rate", "waste_adjusted_roi",
        "forecast_units", "forecast_bias", "forecast_accuracy_wape", "value_share", "volume_share", "share_change_pp",
        "market_category_growth_pct", "market_adjusted_growth", "numeric_distribution", "weighted_distribution",
        "price_index_vs_category", "so_growth_score", "share_score", "waste_score", "forecast_score", "roi_score",
        "growth_quality_score", "gqs_confidence_level", F.lit("v1").alias("gqs_version"), "gqs_4w_avg",
        "waste_risk_score", "waste_risk_category", "competitive_risk_score", "competitive_risk_confidence",
        "consecutive_forecast_misses", "weeks_of_history", c("primary_action").alias("recommended_action"),
        "secondary_action", "action_compound", "conflict_flag", c("rationale").alias("recommendation_rationale"),
        F.lit("v1").alias("recommendation_version"), coverage.alias("sell_out_coverage_pct"), "nielsen_lag_weeks",
        S.data_confidence(
            c("sell_in_units").isNotNull(), c("units").isNotNull(), c("investment_spend").isNotNull(), c("value_share").isNotNull()
        ).alias("data_confidence_overall"),
        F.current_timestamp().alias("computed_at"), F.lit(run_id).cast("string").alias("source_pipeline_run_id"),
    )
