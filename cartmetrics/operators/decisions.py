"""Recommended actions, their texts, forecast monitoring and scorecards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import safe_divide
from cartmetrics.sources.readers import config_frame

# --- actions -----------------------------------------------------------------------------------


def recommend_primary(
    gqs: Column, roi: Column, share_change: Column, waste_category: Column, weeks: Column, min_weeks: int = 4
) -> Column:
    """Investment action from the smoothed quality score, ROI and share change. Missing input or a
    short history means WATCH; an unknown share change counts as none."""
    share = F.coalesce(share_change, F.lit(0.0))
    ready = (F.coalesce(weeks, F.lit(0)) >= min_weeks) & gqs.isNotNull() & roi.isNotNull() & waste_category.isNotNull()
    return (
        F.when(~ready, "WATCH")
        .when((gqs >= 75) & (roi >= 1.5) & (share >= 0), "INCREASE")
        .when((gqs >= 60) & (roi >= 1.0), "MAINTAIN")
        .when((roi < 1.0) & (gqs >= 50), "OPTIMIZE")
        .when((gqs < 40) & (roi < 0.8) & (share < -1.0), "REDUCE")
        .otherwise("WATCH")
    )


def recommend(df: DataFrame, min_weeks: int = 4) -> DataFrame:
    """Primary action, stacked secondary actions, the compound label and a conflict flag.

    Columns: gqs_4w_avg, waste_risk_category, waste_adjusted_roi, share_change_pp,
    consecutive_forecast_misses, weeks_of_history and optionally price_index_vs_category.
    """
    c = F.col
    primary = recommend_primary(
        c("gqs_4w_avg"), c("waste_adjusted_roi"), c("share_change_pp"), c("waste_risk_category"), c("weeks_of_history"), min_weeks
    )
    ready = (
        (F.coalesce(c("weeks_of_history"), F.lit(0)) >= min_weeks)
        & c("gqs_4w_avg").isNotNull() & c("waste_adjusted_roi").isNotNull() & c("waste_risk_category").isNotNull()
    )
    price = c("price_index_vs_category") if "price_index_vs_category" in df.columns else F.lit(None).cast("double")
    actions = F.array_compact(
        F.array(
            F.when(ready & (c("waste_risk_category") == "HIGH"), "WASTE_REVIEW"),
            F.when(ready & (c("consecutive_forecast_misses") >= 3), "FORECAST_REVIEW"),
            F.when(ready & (price > 1.15) & (c("share_change_pp") < -0.5), "PRICE_REVIEW"),
        )
    )
    out = df.withColumns({"primary_action": primary, "_actions": actions})
    secondary = F.when(F.size("_actions") > 0, F.array_join("_actions", " + "))
    conflict = F.array_contains("_actions", "WASTE_REVIEW") & c("primary_action").isin("INCREASE", "MAINTAIN")
    return out.withColumns(
        {
            "secondary_action": secondary,
            "action_compound": F.concat_ws(" + ", "primary_action", secondary),
            "conflict_flag": conflict,
        }
    ).drop("_actions")


def render_rationale(
    df: DataFrame, values: Mapping[str, str], templates: Mapping[str, str], action: str = "action_compound"
) -> DataFrame:
    """Fill the text of each row's action. ``values`` maps slot names to columns, ``templates`` actions
    to texts: {name} prints one decimal for numbers, {name:.0%} a percentage, {name:.2f} two decimals.

    Slots are replaced one by one by column expressions on the joined template. A compound action
    without its own text uses the text of its primary action. A text needs two numbers and no
    unfilled slot to be valid.
    """
    frame = config_frame(df.sparkSession, list(templates.items()), "_action string, _template string")
    primary = F.split_part(F.col(action), F.lit(" + "), F.lit(1))
    known = F.col(action).isin(*templates)
    out = df.withColumn("_wanted", F.when(known, F.col(action)).otherwise(primary))
    out = out.join(frame, F.col("_wanted") == F.col("_action"), "left")

    def fill(text: Column, slot: str, name: str) -> Column:
        """Replace the forms of one slot; a NULL value leaves the slot as it is."""
        dtype = df.schema[name].dataType.typeName()
        forms = {f"{{{slot}}}": F.col(name).cast("string")}
        if dtype in ("double", "float") or dtype.startswith("decimal"):
            value = F.col(name).cast("double")
            known = lambda c: F.when(value.isNotNull(), c)
            forms = {
                f"{{{slot}}}": known(F.format_string("%.1f", value)),
                f"{{{slot}:.0%}}": known(F.concat(F.format_string("%.0f", value * 100), F.lit("%"))),
                f"{{{slot}:.2f}}": known(F.format_string("%.2f", value)),
            }
        return reduce(
            lambda t, kv: F.replace(t, F.lit(kv[0]), F.coalesce(kv[1], F.lit(kv[0]))), forms.items(), text
        )

    text = reduce(lambda t, kv: fill(t, *kv), values.items(), F.col("_template"))
    out = out.withColumn("rationale", text)
    numbers = F.regexp_count("rationale", F.lit(r"\d+\.?\d*[x%]?"))
    unfilled = F.regexp_count("rationale", F.lit(r"\{[a-z0-9_:.%]+\}"))
    return out.withColumn("rationale_valid", (numbers >= 2) & (unfilled == 0)).drop("_wanted", "_action", "_template")


# --- monitoring --------------------------------------------------------------------------------


def performance_log(
    current: DataFrame, champions: DataFrame | None, week: Column, wape_limit_pp: float = 5.0, recall_limit: float = 0.10
) -> DataFrame:
    """Current error and recall of each champion model against its training baseline.

    Error is a ratio and its limit is in percentage points, so the difference is taken times 100.
    current: channel_type, wape_actual, recall_actual, n_brands_evaluated, n_skus_evaluated;
    champions: channel, model_name, model_version, wape_at_training, recall_at_training. None: each row of current has
    these columns of its champion; rows without a channel have none.
    """
    if champions is None:
        out = current.filter(F.col("channel_type") == F.col("channel"))
    else:
        out = current.join(champions, current["channel_type"] == champions["channel"], "inner")
    wape_delta = (F.col("wape_actual") - F.col("wape_at_training")) * 100
    recall_delta = F.col("recall_actual") - F.col("recall_at_training")
    wape_fired = F.coalesce(wape_delta > wape_limit_pp, F.lit(False))
    recall_fired = F.coalesce(recall_delta < -recall_limit, F.lit(False))
    return out.select(
        week.alias("log_week"), "model_name", "model_version", "channel", "wape_actual",
        F.col("wape_at_training").alias("wape_baseline"), wape_delta.alias("wape_delta_pp"),
        "recall_actual", F.col("recall_at_training").alias("recall_baseline"), recall_delta.alias("recall_delta"),
        wape_fired.alias("wape_trigger_fired"), recall_fired.alias("recall_trigger_fired"),
        (wape_fired | recall_fired).alias("retrain_triggered"), "n_brands_evaluated", "n_skus_evaluated",
    )


def retrospective_alert_eval(
    scores: DataFrame, keys: Sequence[str], period: str, score: str, share: str,
    threshold: float = 70.0, loss: float = -0.5, horizon: int = 8,
) -> DataFrame:
    """How well high scores warn of share losses within the next periods.

    The lowest share of the horizon comes from a range frame on the period number, so no pairs of
    rows are built. Rows without any later period cannot be judged and do not count.
    """
    ahead = W.partitionBy(*keys).orderBy(period).rangeBetween(1, horizon)
    judged = scores.withColumns(
        {"_low": F.min(share).over(ahead), "_flag": F.coalesce(F.col(score) > threshold, F.lit(False))}
    ).filter(F.col("_low").isNotNull() & F.col(share).isNotNull())
    lost = (F.col("_low") - F.col(share)) <= loss
    flag = F.col("_flag")
    out = judged.agg(
        F.count("*").alias("n_judged"),
        F.count_if(flag).alias("n_flags"),
        F.count_if(lost).alias("n_losses"),
        F.count_if(flag & lost).alias("true_positives"),
        F.count_if(flag & ~lost).alias("false_positives"),
    )
    return out.withColumns(
        {
            "recall": safe_divide(F.col("true_positives") * 1.0, F.col("n_losses")),
            "false_positive_rate": safe_divide(F.col("false_positives") * 1.0, F.col("n_flags")),
        }
    )


def cold_start_prior(
    weekly: DataFrame, item: str, brand: str, category: str, week: str, units: str,
    suppress_below: int = 4, prior_below: int = 13,
) -> DataFrame:
    """Mean weekly units per item; young items borrow the mean of brand and category, and items
    with almost no history get none.

    The facts are read once and added up by item; the means of brands and categories come from windows over these rows,
    which are as many as the product master has.
    """
    out = weekly.groupBy(item, brand, category).agg(
        F.sum(units).alias("_u"), F.count("*").alias("_n"), F.count_distinct(week).alias("weeks_of_history")
    )
    mean = lambda of: F.sum("_u").over(W.partitionBy(of)) / F.sum("_n").over(W.partitionBy(of))
    out = out.withColumns({"_brand_mean": mean(brand), "_category_mean": mean(category)})
    weeks = F.col("weeks_of_history")
    own = F.col("_u") / F.col("_n")
    prior = (F.col("_brand_mean") + F.col("_category_mean")) / 2
    basis = F.when(weeks < suppress_below, "SUPPRESSED").when(weeks < prior_below, "BRAND_CATEGORY_PRIOR").otherwise("OWN_HISTORY")
    expected = F.when(weeks < suppress_below, F.lit(None).cast("double")).when(weeks < prior_below, prior).otherwise(own)
    return out.select(item, brand, category, "weeks_of_history", basis.alias("basis"), expected.alias("expected_units"))


def portfolio_scorecard(mart: DataFrame, period: str) -> DataFrame:
    """Portfolio cards per period with the change to the period before.

    mart: brand_key, period, growth_quality_score, waste_risk_category, forecast_units, actual units
    as sell_out_units, sell_out_revenue, waste_cost, investment_spend. The window runs over periods
    of an aggregate; the calendar bounds it.
    """
    at_risk = F.when(F.col("waste_risk_category") == "HIGH", F.col("brand_key"))
    cards = mart.groupBy(period).agg(
        F.avg("growth_quality_score").alias("avg_gqs"),
        F.count_distinct(at_risk).alias("brands_at_waste_risk"),
        F.count_distinct("brand_key").alias("brands"),
        safe_divide(F.sum(F.abs(F.col("forecast_units") - F.col("sell_out_units"))), F.sum("sell_out_units")).alias("wape"),
        safe_divide(F.sum("sell_out_revenue") - F.sum("waste_cost"), F.sum("investment_spend")).alias("roi"),
    )
    order = W.orderBy(period)
    moved = {f"{c}_change": F.col(c) - F.lag(c).over(order) for c in ("avg_gqs", "brands_at_waste_risk", "wape", "roi")}
    return cards.withColumns(moved)


def brand_scorecard(mart: DataFrame) -> DataFrame:
    """One row per brand with revenue, spend, ROI and its ROI rank (equal ROI by name).

    Brands are a master list; the rank window sees one row per brand.
    """
    per_brand = mart.groupBy("brand_key").agg(
        F.avg("growth_quality_score").alias("avg_gqs"),
        F.sum("sell_out_revenue").alias("sell_out_revenue"),
        F.sum("waste_cost").alias("waste_cost"),
        F.sum("investment_spend").alias("investment_spend"),
    )
    roi = safe_divide(F.col("sell_out_revenue") - F.col("waste_cost"), F.col("investment_spend"))
    out = per_brand.withColumn("roi", roi)
    return out.withColumn("roi_rank", F.row_number().over(W.orderBy(F.desc_nulls_last("roi"), "brand_key")))
