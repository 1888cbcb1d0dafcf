"""Scores, recommendations, monitoring and the monthly mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import decisions, mart, quality_aggs
from cartmetrics.plans.join_plans import WAPE_ROWS, wape_rows
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.roles import Tables

#: Rows of a task where the groups are nearly as many as the rows.
ROWS_OF_A_TASK = 500_000

MART_ROLES = ("history", "sell_in", "spend", "forecast", "weekly_panel")


def _clamp(x: str, low: float = 0.0, high: float = 100.0) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN GREATEST({low}::DOUBLE, LEAST({high}::DOUBLE, {x})) END"


def _weighted(parts: dict[str, float]) -> tuple[str, str]:
    missing = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in parts)
    total = " + ".join(f"COALESCE({c} * {w}::DOUBLE, 0)" for c, w in parts.items())
    weight = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w}::DOUBLE ELSE 0 END" for c, w in parts.items())
    score = f"CASE WHEN {missing} <= 2 THEN ROUND(GREATEST(0, LEAST(100, ({total}) / NULLIF({weight}, 0))), 1) END"
    return score, missing


# The weights are written out here, so that a change of the library's weights shows.
GQS_PARTS = {"so_growth_score": 0.25, "share_score": 0.25, "waste_score": 0.2, "forecast_score": 0.15, "roi_score": 0.15}
RISK_PARTS = {"r_share_loss": 0.3, "r_price_gap": 0.25, "r_num_dist": 0.2, "r_wgt_dist": 0.15, "r_share_yoy": 0.1}
GQS_SCORE, GQS_MISSING = _weighted(GQS_PARTS)
RISK_SCORE, RISK_MISSING = _weighted(RISK_PARTS)
PW = "OVER (PARTITION BY brand_key, channel_key ORDER BY period_key)"


def _back(column: str, months: int) -> str:
    """Value of the same brand and channel exactly so many months before."""
    return f"MAX({column}) OVER (PARTITION BY brand_key, channel_key ORDER BY period_key RANGE BETWEEN {months} PRECEDING AND {months} PRECEDING)"


def _weeks_back(column: str, weeks: int) -> str:
    return f"MAX({column}) OVER (PARTITION BY brand_key, channel_key ORDER BY week_end RANGE BETWEEN INTERVAL {7 * weeks} DAY PRECEDING AND INTERVAL {7 * weeks} DAY PRECEDING)"


RISK = {
    "rk1": f"""
        SELECT *, value_share - {_weeks_back("value_share", 13)} AS d_share,
               (price_index_vs_category - {_weeks_back("price_index_vs_category", 13)}) * 100 / NULLIF({_weeks_back("price_index_vs_category", 13)}, 0) AS d_price,
               numeric_distribution - {_weeks_back("numeric_distribution", 13)} AS d_num, weighted_distribution - {_weeks_back("weighted_distribution", 13)} AS d_wgt,
               value_share - {_weeks_back("value_share", 52)} AS d_yoy FROM weekly_panel""",
    "rk2": f"""
        SELECT *, {_clamp("(3 - d_share) / 6 * 100")} AS r_share_loss, {_clamp("(d_price + 20) / 40 * 100")} AS r_price_gap, {_clamp("(10 - d_num) / 20 * 100")} AS r_num_dist,
               {_clamp("(10 - d_wgt) / 20 * 100")} AS r_wgt_dist, {_clamp("(5 - d_yoy) / 10 * 100")} AS r_share_yoy FROM rk1""",
    "risk": f"""
        SELECT brand_key, channel_key, week_end, CASE WHEN n_brands > 1 THEN {RISK_SCORE} END AS competitive_risk_score,
               CASE WHEN n_brands <= 1 THEN 'NO_COMPETITIVE_CONTEXT' ELSE CASE {RISK_MISSING} WHEN 0 THEN 'FULL' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'LOW' ELSE 'NULL' END END AS competitive_risk_confidence,
               d_share IS NOT NULL AS has_history FROM rk2""",
}
MART = RISK | {
    "rk4": """
        SELECT h.brand_key, h.channel_key, h.fecha_month, MAX(w.week_end) AS week_end FROM history h JOIN risk w
          ON w.brand_key = h.brand_key AND w.channel_key = h.channel_key AND w.week_end <= LAST_DAY(h.fecha_month) GROUP BY ALL""",
    "rk5": """
        SELECT k.brand_key, k.channel_key, k.fecha_month, w.competitive_risk_score, w.competitive_risk_confidence,
               CAST(date_diff('day', k.week_end, LAST_DAY(k.fecha_month)) // 7 AS INT) AS nielsen_lag_weeks
        FROM rk4 k JOIN risk w USING (brand_key, channel_key, week_end) WHERE date_diff('day', k.week_end, LAST_DAY(k.fecha_month)) // 7 <= 8""",
    "m_si": "SELECT marca_std AS brand_key, canal_std AS channel_key, fecha_month, ROUND(SUM(volume_liter), 2) AS sell_in_units FROM sell_in WHERE marca_std IS NOT NULL GROUP BY ALL",
    "m_wa": "SELECT marca_std AS brand_key, canal_std AS channel_key, fecha_month, ROUND(SUM(volume_liter), 2) AS waste_units, ROUND(SUM(volume_liter), 2) * 10 AS waste_cost FROM sell_in WHERE marca_std IS NOT NULL AND dis_chl_cod = 'R' GROUP BY ALL",
    "m_sp": "SELECT marca_std AS brand_key, canal_std AS channel_key, fecha_month, ROUND(SUM(inversion_real), 2) AS investment_spend FROM spend GROUP BY ALL",
    "m1": """
        SELECT h.*, si.sell_in_units, wa.waste_units, wa.waste_cost, sp.investment_spend, f.forecasted_units AS forecast_units, f.actual_units,
               h.units / NULLIF(si.sell_in_units, 0) AS sell_out_sell_in_ratio, wa.waste_units / NULLIF(si.sell_in_units, 0) AS waste_rate,
               (h.revenue - COALESCE(wa.waste_cost, 0)) / NULLIF(sp.investment_spend, 0) AS waste_adjusted_roi,
               (f.forecasted_units - f.actual_units) / NULLIF(f.actual_units, 0) AS forecast_bias, ABS(f.forecasted_units - f.actual_units) / NULLIF(f.actual_units, 0) AS forecast_accuracy_wape
        FROM history h LEFT JOIN m_si si USING (brand_key, channel_key, fecha_month) LEFT JOIN m_wa wa USING (brand_key, channel_key, fecha_month)
        LEFT JOIN m_sp sp USING (brand_key, channel_key, fecha_month) LEFT JOIN forecast f USING (brand_key, channel_key, fecha_month)""",
    "m_ch": "SELECT channel_key, fecha_month, SUM(revenue) AS revenue FROM m1 GROUP BY ALL",
    "m2": """
        SELECT a.*, a.revenue / NULLIF(b.revenue, 0) - 1 AS sell_out_growth, (c.revenue / NULLIF(d.revenue, 0) - 1) * 100 AS market_category_growth_pct
        FROM m1 a LEFT JOIN m1 b ON a.brand_key = b.brand_key AND a.channel_key = b.channel_key AND a.fecha_month = CAST(b.fecha_month + INTERVAL 12 MONTH AS DATE)
        JOIN m_ch c ON a.channel_key = c.channel_key AND a.fecha_month = c.fecha_month
        LEFT JOIN m_ch d ON a.channel_key = d.channel_key AND a.fecha_month = CAST(d.fecha_month + INTERVAL 12 MONTH AS DATE)""",
    "m3": f"""
        SELECT *, sell_out_growth * 100 - market_category_growth_pct AS market_adjusted_growth, value_share - {_back("value_share", 1)} AS share_change_pp,
               CAST(SIGN(forecast_units - actual_units) AS INT) AS miss_direction FROM m2""",
    "m4": f"""
        SELECT *, {_clamp("(sell_out_growth * 100 + 20) / 40 * 100")} AS so_growth_score, {_clamp("(share_change_pp + 3) / 6 * 100")} AS share_score,
               {_clamp("100 - waste_rate * 100 / 5 * 100")} AS waste_score, {_clamp("(1 - forecast_accuracy_wape) * 100")} AS forecast_score, {_clamp("waste_adjusted_roi / 3 * 100")} AS roi_score,
               CASE WHEN LAG(miss_direction) {PW} = miss_direction THEN 0 ELSE 1 END AS st FROM m3""",
    "m5": f"""
        SELECT *, {GQS_SCORE} AS growth_quality_score, CASE {GQS_MISSING} WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LOW' ELSE 'NULL' END AS gqs_confidence_level,
               competitive_risk_score, competitive_risk_confidence, nielsen_lag_weeks,
               {_clamp("waste_rate * 3", 0.0, 1.0)} AS waste_risk_score, SUM(st) {PW} AS run FROM m4 LEFT JOIN rk5 USING (brand_key, channel_key, fecha_month)""",
    "m6": """
        SELECT *, CASE WHEN waste_risk_score < 0.30 THEN 'LOW' WHEN waste_risk_score < 0.70 THEN 'MEDIUM' WHEN waste_risk_score IS NOT NULL THEN 'HIGH' END AS waste_risk_category,
               CASE WHEN COUNT(growth_quality_score) OVER w >= 2 THEN ROUND(AVG(growth_quality_score) OVER w, 1) END AS gqs_4w_avg,
               CASE WHEN miss_direction <> 0 THEN CAST(ROW_NUMBER() OVER (PARTITION BY brand_key, channel_key, run ORDER BY period_key) AS INT) ELSE 0 END AS consecutive_forecast_misses,
               CAST(date_diff('day', MIN(fecha_month) OVER (PARTITION BY brand_key, channel_key ORDER BY period_key), CAST(fecha_month + INTERVAL 1 MONTH AS DATE)) // 7 AS INT) AS weeks_of_history
        FROM m5 WINDOW w AS (PARTITION BY brand_key, channel_key ORDER BY period_key ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
    "m7": """
        SELECT *, weeks_of_history >= 4 AND gqs_4w_avg IS NOT NULL AND waste_adjusted_roi IS NOT NULL AND waste_risk_category IS NOT NULL AS ready, COALESCE(share_change_pp, 0) AS sh FROM m6""",
    "m8": """
        SELECT *, CASE WHEN NOT ready THEN 'WATCH' WHEN gqs_4w_avg >= 75 AND waste_adjusted_roi >= 1.5 AND sh >= 0 THEN 'INCREASE' WHEN gqs_4w_avg >= 60 AND waste_adjusted_roi >= 1 THEN 'MAINTAIN'
                       WHEN waste_adjusted_roi < 1 AND gqs_4w_avg >= 50 THEN 'OPTIMIZE' WHEN gqs_4w_avg < 40 AND waste_adjusted_roi < 0.8 AND sh < -1 THEN 'REDUCE' ELSE 'WATCH' END AS recommended_action,
               NULLIF(CONCAT_WS(' + ', CASE WHEN ready AND waste_risk_category = 'HIGH' THEN 'WASTE_REVIEW' END, CASE WHEN ready AND consecutive_forecast_misses >= 3 THEN 'FORECAST_REVIEW' END,
                         CASE WHEN ready AND price_index_vs_category > 1.15 AND share_change_pp < -0.5 THEN 'PRICE_REVIEW' END), '') AS secondary_action FROM m7""",
    "mart": """
        SELECT *, CONCAT_WS(' + ', recommended_action, secondary_action) AS action_compound,
               COALESCE(secondary_action LIKE '%WASTE_REVIEW%', FALSE) AND recommended_action IN ('INCREASE','MAINTAIN') AS conflict_flag FROM m8""",
}

ROUNDED_COLUMNS = (
    "sell_out_sell_in_ratio", "waste_rate", "waste_adjusted_roi", "forecast_bias", "forecast_accuracy_wape", "share_change_pp",
    "market_category_growth_pct", "market_adjusted_growth", "so_growth_score", "share_score", "waste_score", "forecast_score",
    "roi_score", "waste_risk_score",
)


def r(*names: str) -> str:
    return ", ".join(f"ROUND({n}, 4) + 0.0 AS {n}" for n in names)


def monthly_frames(t: Tables) -> list[DataFrame]:
    """The three monthly inputs of the mart."""
    keys = [F.col("marca_std").alias("brand_key"), F.col("canal_std").alias("channel_key"), "fecha_month"]
    total = lambda c: S.stable_round(F.sum(c), 2)
    shipped = t.sell_in.filter(F.col("marca_std").isNotNull())
    wasted = total(F.when(F.col("dis_chl_cod") == "R", F.col("volume_liter")))
    shipments = shipped.groupBy(*keys).agg(
        total("volume_liter").alias("sell_in_units"), wasted.alias("waste_units"), (wasted * 10).alias("waste_cost")
    )
    # Stands for the score of a waste model, which the mart takes as it is.
    rate = S.safe_divide(F.col("waste_units"), F.col("sell_in_units"))
    shipments = shipments.withColumn("waste_risk_score", S.clamp(rate * 3, 0.0, 1.0))
    spend = t.spend.groupBy(*keys).agg(total("inversion_real").alias("investment_spend"))
    base = t.history.withColumns({"forecast_units": t.forecast_units, "actual_units": t.actual_units, "stores": F.col("numeric_distribution")})
    return [base, shipments, spend]


def scored_rows(t: Tables) -> DataFrame:
    base, *others = monthly_frames(t)
    return mart.with_growth_quality(mart.mart_facts(mart.with_growth(base), *others))


def mart_rows(t: Tables) -> DataFrame:
    brands = t.items.select(F.upper("brand").alias("brand_key"), F.initcap("brand").alias("brand_name")).distinct()
    kind = F.when(F.col("channel_key").isin("AUTOMOBILE", "FURNITURE"), "MODERN").otherwise("TRADITIONAL")
    channels = t.customer.groupBy(F.col("c_mktsegment").alias("channel_key")).agg(F.count("*").alias("stores_expected"))
    channels = channels.withColumns({"channel_name": F.initcap("channel_key"), "channel_type": kind})
    return mart.monthly_mart(*monthly_frames(t), t.weekly_panel, brands, channels, run_id="run", fiscal_start_month=7)


@query(
    roles=MART_ROLES,
    extra=MART,
    sql=f"""SELECT SUBSTR(MD5(brand_key || '|' || channel_key || '|' || CAST(fecha_month AS VARCHAR)), 1, 16) AS mart_key, brand_key, channel_key, fecha_month,
                   CAST(STRFTIME(fecha_month, '%Y%m') AS INT) AS month_key, CAST(YEAR(fecha_month) AS INT) AS year_number, CAST(MONTH(fecha_month) AS INT) AS month_number, period_key,
                   {r('sell_in_units', 'waste_units', 'waste_cost', 'investment_spend', 'forecast_units', 'value_share', 'volume_share', 'numeric_distribution', 'weighted_distribution', 'price_index_vs_category')},
                   ROUND(units, 4) AS sell_out_units, ROUND(revenue, 4) AS sell_out_revenue, {r(*ROUNDED_COLUMNS)},
                   growth_quality_score, gqs_confidence_level, 'v1' AS gqs_version, gqs_4w_avg, waste_risk_category, competitive_risk_score, competitive_risk_confidence, consecutive_forecast_misses,
                   weeks_of_history, recommended_action, secondary_action, action_compound, conflict_flag, 'Brand#' || SUBSTR(brand_key, 7) AS brand_name,
                   channel_key[1] || LOWER(channel_key[2:]) AS channel_name, CASE WHEN channel_key IN ('AUTOMOBILE','FURNITURE') THEN 'MODERN' ELSE 'TRADITIONAL' END AS channel_type,
                   0 AS region_key, 'FY' || YEAR(fecha_month + INTERVAL 6 MONTH) || '-P' || LPAD(CAST(MONTH(fecha_month + INTERVAL 6 MONTH) AS VARCHAR), 2, '0') AS fiscal_period,
                   ROUND(numeric_distribution * 100 / (SELECT COUNT(*) FROM customer WHERE c_mktsegment = channel_key), 4) AS sell_out_coverage_pct, nielsen_lag_weeks,
                   'v1' AS recommendation_version, 'run' AS source_pipeline_run_id,
                   CASE WHEN sell_in_units IS NOT NULL AND investment_spend IS NOT NULL AND value_share IS NOT NULL THEN 'HIGH' ELSE 'MEDIUM' END AS data_confidence_overall FROM mart""",
)
def monthly_mart(t: Tables) -> DataFrame:
    """All columns but the time of the run and the rationale, which has a query of its own."""
    return rounded(mart_rows(t).drop("computed_at", "recommendation_rationale"), 4, growth_quality_score=1, gqs_4w_avg=1, competitive_risk_score=1)


IDS = "brand_key, channel_key, period_key"
ID_LIST = ["brand_key", "channel_key", "period_key"]
SCORES = [f"{k}_score" for k in S.GROWTH_WEIGHTS]


@query(roles=MART_ROLES, extra=MART, sql=f"SELECT {IDS}, {r(*SCORES)} FROM mart")
def component_scores(t: Tables) -> DataFrame:
    out = scored_rows(t)
    return rounded(out.select(*ID_LIST, *SCORES))


@query(
    roles=MART_ROLES,
    extra=MART,
    sql=f"SELECT {IDS}, growth_quality_score AS score, gqs_confidence_level AS confidence, {GQS_MISSING} AS null_component_count FROM mart",
)
def growth_quality_score(t: Tables) -> DataFrame:
    out = scored_rows(t)
    score = S.growth_quality_score({k: F.col(f"{k}_score") for k in S.GROWTH_WEIGHTS})
    return rounded(out.select(*ID_LIST, *[c.alias(n) for n, c in score.items()]), 1)


@query(
    roles=("weekly_panel",),
    extra=RISK,
    sql="SELECT brand_key, channel_key, week_end, competitive_risk_score, competitive_risk_confidence, has_history FROM risk",
)
def competitive_risk_score(t: Tables) -> DataFrame:
    out = mart.weekly_competitive_risk(t.weekly_panel)
    return rounded(out.select(*mart.KEYS, "week_end", "competitive_risk_score", "competitive_risk_confidence", "has_history"), 1)


@query(roles=MART_ROLES, extra=MART, sql=f"SELECT {IDS}, recommended_action FROM mart")
def recommend_primary(t: Tables) -> DataFrame:
    return mart_rows(t).select(*ID_LIST, "recommended_action")


@query(roles=MART_ROLES, extra=MART, sql=f"SELECT {IDS}, secondary_action, action_compound, conflict_flag FROM mart")
def recommend_secondary(t: Tables) -> DataFrame:
    return mart_rows(t).select(*ID_LIST, "secondary_action", "action_compound", "conflict_flag")


# Texts of this query; users bring their own.
RATIONALE_TEXTS = {
    "INCREASE": "{brand_name}: score {gqs_score_4w_avg}, return {roi}. Spend more.",
    "MAINTAIN": "{brand_name}: score {gqs_score_4w_avg}, share moved by {share_change_pp}. Keep the spend.",
    "REDUCE": "{brand_name}: return {roi}, share moved by {share_change_pp}. Spend less.",
    "WATCH": "{brand_name}: {weeks_of_history} weeks known, {min_weeks_required} needed. Wait.",
    "INCREASE + WASTE_REVIEW": "{brand_name}: score {gqs_score_4w_avg}, waste {waste_risk_score:.0%} against {waste_risk_threshold:.0%}. Spend more, look at waste.",
    "MAINTAIN + PRICE_REVIEW": "{brand_name}: score {gqs_score_4w_avg}, price index {price_index:.2f}. Look at the price.",
    "MAINTAIN + FORECAST_REVIEW": "{brand_name}: score {gqs_score_4w_avg}, {consecutive_forecast_misses} misses in a row. Look at the forecast.",
    "REDUCE + WASTE_REVIEW": "{brand_name}: return {roi}, waste {waste_risk_score:.0%}. Spend less, look at waste.",
}


def _rationale_sql() -> str:
    """Template text by action with every slot replaced in turn."""
    texts = " ".join(f"WHEN '{a}' THEN '{x.replace(chr(39), chr(39) * 2)}'" for a, x in RATIONALE_TEXTS.items())
    known = ", ".join(f"'{a}'" for a in RATIONALE_TEXTS)
    expr = f"CASE CASE WHEN action_compound IN ({known}) THEN action_compound ELSE SPLIT_PART(action_compound, ' + ', 1) END {texts} END"
    for slot, column, kind in RATIONALE_SLOTS:
        if kind == "double":
            forms = [(f"{{{slot}}}", f"FORMAT('{{:.1f}}', {column})"), (f"{{{slot}:.0%}}", f"FORMAT('{{:.0f}}', {column} * 100) || '%'"), (f"{{{slot}:.2f}}", f"FORMAT('{{:.2f}}', {column})")]
            for form, shown in forms:
                expr = f"REPLACE({expr}, '{form}', COALESCE({shown}, '{form}'))"
        else:
            expr = f"REPLACE({expr}, '{{{slot}}}', COALESCE(CAST({column} AS VARCHAR), '{{{slot}}}'))"
    return expr


# Values are rounded first, so that both engines print the same digits.
RATIONALE_SLOTS = [
    ("brand_name", "brand_key", "string"),
    ("gqs_score_4w_avg", "gqs_4w_avg", "double"),
    ("roi", "roi", "double"),
    ("share_change_pp", "share_change_pp", "double"),
    ("waste_risk_score", "waste_risk_score", "double"),
    ("waste_risk_threshold", "threshold", "double"),
    ("price_index", "price_index", "double"),
    ("consecutive_forecast_misses", "misses", "int"),
    ("weeks_of_history", "weeks", "int"),
    ("min_weeks_required", "min_weeks", "int"),
]


@query(
    roles=MART_ROLES,
    extra=MART
    | {
        "t1": """SELECT brand_key, channel_key, period_key, action_compound, gqs_4w_avg, ROUND(waste_adjusted_roi, 1) AS roi, ROUND(share_change_pp, 1) + 0.0 AS share_change_pp, ROUND(waste_risk_score, 2) AS waste_risk_score,
                        0.7::DOUBLE AS threshold, ROUND(price_index_vs_category, 2) AS price_index, consecutive_forecast_misses AS misses, weeks_of_history AS weeks, 4 AS min_weeks FROM mart""",
        "t2": f"SELECT {IDS}, action_compound, {_rationale_sql()} AS rationale FROM t1",
    },
    sql=r"""SELECT *, LEN(regexp_extract_all(rationale, '[0-9]+\.?[0-9]*[x%]?')) >= 2 AND NOT regexp_matches(rationale, '\{[a-z0-9_:.%]+\}') AS rationale_valid FROM t2""",
)
def render_rationale(t: Tables) -> DataFrame:
    c = F.col
    rows = mart_rows(t).select(
        *ID_LIST, "action_compound", S.stable_round(c("gqs_4w_avg"), 1).alias("gqs_4w_avg"),
        S.stable_round(c("waste_adjusted_roi"), 1).alias("roi"), S.stable_round(c("share_change_pp"), 1).alias("share_change_pp"),
        S.stable_round(c("waste_risk_score"), 2).alias("waste_risk_score"), F.lit(0.7).alias("threshold"),
        S.stable_round(c("price_index_vs_category"), 2).alias("price_index"), c("consecutive_forecast_misses").alias("misses"),
        c("weeks_of_history").alias("weeks"), F.lit(4).alias("min_weeks"),
    )
    out = decisions.render_rationale(rows, {slot: column for slot, column, _ in RATIONALE_SLOTS}, RATIONALE_TEXTS)
    return out.select(*ID_LIST, "action_compound", "rationale", "rationale_valid")


# --- monitoring --------------------------------------------------------------------------------


@query(
    roles=("forecast",),
    extra={
        "cur": f"""SELECT channel_type, SUM(ABS(forecasted_units - actual_units)) / NULLIF(SUM(actual_units), 0) AS w, COUNT(DISTINCT brand_key) AS n_brands_evaluated, COUNT(*) AS n_skus_evaluated,
                          AVG(CASE WHEN forecasted_units >= actual_units THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rec FROM ({WAPE_ROWS}) GROUP BY ALL""",
        "ch": "SELECT channel_type AS channel, 'demand_' || LOWER(channel_type) AS model_name, 'v1' AS model_version, COUNT(DISTINCT brand_key) / 200.0::DOUBLE AS w0, 0.8::DOUBLE AS r0 FROM forecast GROUP BY channel_type",
    },
    sql="""SELECT DATE '2001-07-30' AS log_week, model_name, model_version, channel, ROUND(w, 6) AS wape_actual, ROUND(w0, 6) AS wape_baseline, ROUND((w - w0) * 100, 6) AS wape_delta_pp, ROUND(rec, 6) AS recall_actual, ROUND(r0, 6) AS recall_baseline,
                  ROUND(rec - r0, 6) AS recall_delta, (w - w0) * 100 > 5 AS wape_trigger_fired, rec - r0 < -0.1 AS recall_trigger_fired, (w - w0) * 100 > 5 OR rec - r0 < -0.1 AS retrain_triggered, n_brands_evaluated, n_skus_evaluated
           FROM cur JOIN ch ON cur.channel_type = ch.channel""",
)
def performance_log(t: Tables) -> DataFrame:
    """Champions are one model per channel type; their baseline derives from its number of brands, over all forecasts.

    One aggregate takes both from the forecasts beside their actuals, so that the facts are not read once more.
    """
    recall = F.avg(F.when(F.col("is_judged"), (F.col("forecasted_units") >= F.col("actual_units")).cast("double"))).alias("recall_actual")
    baseline = (F.count_distinct("brand_key") / 200.0).alias("wape_at_training")
    both = quality_aggs.wape(wape_rows(t, keep_unjudged=True), ["channel_type"], more=[recall, baseline], where=F.col("is_judged"))
    both = both.filter("n_skus_evaluated > 0").withColumns(
        {
            "channel": F.col("channel_type"),
            "model_name": F.concat(F.lit("demand_"), F.lower("channel_type")),
            "model_version": F.lit("v1"),
            "recall_at_training": F.lit(0.8),
        }
    )
    return rounded(decisions.performance_log(both, None, F.lit("2001-07-30").cast("date")), 6)


@query(
    roles=("sell_out",),
    extra={
        "w": "SELECT upc, marca_std, category, CAST(DATE_TRUNC('week', sale_date) AS DATE) AS week_start, SUM(vol_sell_out) AS units FROM sell_out WHERE marca_std IS NOT NULL GROUP BY ALL",
        "i": "SELECT upc, marca_std, category, SUM(units) AS u, COUNT(*) AS n, COUNT(DISTINCT week_start) AS weeks_of_history FROM w GROUP BY ALL",
        "b": "SELECT marca_std, SUM(u) / SUM(n) AS bm FROM i GROUP BY ALL",
        "c": "SELECT category, SUM(u) / SUM(n) AS cm FROM i GROUP BY ALL",
    },
    sql="""SELECT i.upc, i.marca_std, i.category, i.weeks_of_history, CASE WHEN weeks_of_history < 4 THEN 'SUPPRESSED' WHEN weeks_of_history < 28 THEN 'BRAND_CATEGORY_PRIOR' ELSE 'OWN_HISTORY' END AS basis,
                  ROUND(CASE WHEN weeks_of_history < 4 THEN NULL WHEN weeks_of_history < 28 THEN (bm + cm) / 2 ELSE u / n END, 4) AS expected_units
           FROM i JOIN b ON i.marca_std = b.marca_std JOIN c ON i.category = c.category""",
)
def cold_start_prior(t: Tables) -> DataFrame:
    """Hardly two sales share item and week, so grouping before the shuffle saves nothing; rows are dealt first, and the
    groups that a task holds stay as many as its rows, whatever the number of lines."""
    keys = ["upc", "marca_std", "category", "week_start"]
    rows = t.sell_out.filter(F.col("marca_std").isNotNull()).withColumn("week_start", F.trunc("sale_date", "week"))
    tasks = max(t.spark.sparkContext.defaultParallelism, -(-t.lineitem.count() // ROWS_OF_A_TASK))
    weekly = rows.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("vol_sell_out").alias("units"))
    return rounded(decisions.cold_start_prior(weekly, "upc", "marca_std", "category", "week_start", "units", prior_below=28))


@query(
    roles=MART_ROLES,
    extra=MART
    | {
        "c": """SELECT period_key, AVG(growth_quality_score) AS g, COUNT(DISTINCT CASE WHEN waste_risk_category = 'HIGH' THEN brand_key END) AS b, COUNT(DISTINCT brand_key) AS brands,
                       SUM(ABS(forecast_units - units)) / NULLIF(SUM(units), 0) AS w, (SUM(revenue) - SUM(waste_cost)) / NULLIF(SUM(investment_spend), 0) AS roi FROM mart GROUP BY period_key"""
    },
    sql="""SELECT period_key, ROUND(g, 4) AS avg_gqs, b AS brands_at_waste_risk, brands, ROUND(w, 4) AS wape, ROUND(roi, 4) AS roi, ROUND(g - LAG(g) OVER p, 4) + 0.0 AS avg_gqs_change, b - LAG(b) OVER p AS brands_at_waste_risk_change,
                  ROUND(w - LAG(w) OVER p, 4) + 0.0 AS wape_change, ROUND(roi - LAG(roi) OVER p, 4) + 0.0 AS roi_change FROM c WINDOW p AS (ORDER BY period_key)""",
)
def portfolio_scorecard(t: Tables) -> DataFrame:
    return rounded(decisions.portfolio_scorecard(mart_rows(t), "period_key"))


@query(
    roles=MART_ROLES,
    extra=MART
    | {
        "b": "SELECT brand_key, AVG(growth_quality_score) AS g, SUM(revenue) AS rev, SUM(waste_cost) AS wc, SUM(investment_spend) AS sp FROM mart GROUP BY brand_key",
        "o": "SELECT *, (rev - wc) / NULLIF(sp, 0) AS roi FROM b",
    },
    sql="""SELECT brand_key, ROUND(g, 4) AS avg_gqs, ROUND(rev, 2) AS sell_out_revenue, ROUND(wc, 2) AS waste_cost, ROUND(sp, 2) AS investment_spend, ROUND(roi, 4) AS roi,
                  CAST(ROW_NUMBER() OVER (ORDER BY roi DESC NULLS LAST, brand_key) AS INT) AS roi_rank FROM o""",
)
def brand_scorecard(t: Tables) -> DataFrame:
    two = dict.fromkeys(("sell_out_revenue", "waste_cost", "investment_spend"), 2)
    return rounded(decisions.brand_scorecard(mart_rows(t)), 4, **two)
