"""Windows over periods, growth, adstock and model fits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import decisions, models, series
from cartmetrics.plans.agg_plans import FINE_SCORE, SCORE, score_rows
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.roles import Tables

KEYS = ["brand_key", "channel_key"]
W = "OVER (PARTITION BY brand_key, channel_key ORDER BY period_key)"
WEEK_NO = "CAST((week_start - DATE '1970-01-05') // 7 AS INT)"


@query(
    roles=("history",),
    extra={
        "l": f"""SELECT brand_key, channel_key, period_key, value_share, price_index_vs_category,
                        LAG(value_share, 13) {W} AS value_share_lag_13, LAG(value_share, 52) {W} AS value_share_lag_52,
                        LAG(price_index_vs_category, 13) {W} AS price_index_vs_category_lag_13 FROM history"""
    },
    sql="""SELECT *, ROUND(value_share - value_share_lag_13, 4) + 0.0 AS value_share_change_13, ROUND(value_share - value_share_lag_52, 4) + 0.0 AS value_share_change_52,
                  ROUND(price_index_vs_category - price_index_vs_category_lag_13, 4) + 0.0 AS price_index_vs_category_change_13
           FROM l WHERE value_share_lag_13 IS NOT NULL""",
)
def period_lags(t: Tables) -> DataFrame:
    rows = t.history.select(*KEYS, "period_key", "value_share", "price_index_vs_category")
    lags = {"value_share": [13, 52], "price_index_vs_category": [13]}
    return rounded(series.period_lags(rows, KEYS, "period_key", lags, "value_share_lag_13"))


@query(
    roles=("history",),
    extra={
        "s": FINE_SCORE,
        "c": f"SELECT ROUND(ABS(score - LAG(score) {W}), 9) AS change FROM s",
    },
    sql="""SELECT ROUND(AVG(change), 4) AS mean_change, ROUND(QUANTILE_CONT(change, 0.90), 4) AS p90_change, ROUND(MAX(change), 4) AS max_change,
                  COUNT(*) AS n_changes FROM c WHERE change IS NOT NULL""",
)
def month_over_month_change(t: Tables) -> DataFrame:
    return rounded(series.month_over_month_change(score_rows(t, 4), KEYS, "period_key", "score"))


@query(
    roles=("sell_out",),
    extra={
        "w": "SELECT DISTINCT upc, CAST(DATE_TRUNC('week', sale_date) AS DATE) AS week_start FROM sell_out",
        "g": "SELECT *, LAG(week_start) OVER (PARTITION BY upc ORDER BY week_start) AS prev_week FROM w",
    },
    sql="""SELECT upc, week_start, prev_week, CAST((week_start - prev_week) // 7 AS INT) AS gap_weeks FROM g WHERE (week_start - prev_week) // 7 > 2""",
)
def temporal_gaps(t: Tables) -> DataFrame:
    return series.temporal_gaps(t.sell_out, "sale_date", ["upc"])


@query(
    roles=("items",),
    extra={
        "w": """SELECT mat_idt, sku_ean_cod, is_active,
                       CASE WHEN sku_ean_cod IS NOT NULL THEN COUNT(mat_idt) OVER (PARTITION BY sku_ean_cod) END AS ean_mat_idt_count,
                       CASE WHEN sku_ean_cod IS NOT NULL THEN CAST(SUM(CASE WHEN is_active THEN 1 ELSE 0 END) OVER (PARTITION BY sku_ean_cod) AS BIGINT) END AS active_mat_idt_count_for_ean
                FROM items""",
        "s": """SELECT *, CASE WHEN ean_mat_idt_count = 1 THEN 'UNIQUE_EAN' WHEN ean_mat_idt_count > 1 AND active_mat_idt_count_for_ean = 1 THEN 'MULTI_MAT_IDT_INACTIVE_HISTORY'
                       WHEN ean_mat_idt_count > 1 AND active_mat_idt_count_for_ean > 1 THEN 'MULTI_MAT_IDT_ACTIVE_CONFLICT' ELSE 'NULL_EAN' END AS ean_cardinality_status FROM w""",
    },
    sql="""SELECT *, ean_cardinality_status = 'UNIQUE_EAN' OR (ean_cardinality_status = 'MULTI_MAT_IDT_INACTIVE_HISTORY' AND is_active) AS is_preferred FROM s""",
)
def key_cardinality_window(t: Tables) -> DataFrame:
    return series.key_cardinality_window(t.items.select("mat_idt", "sku_ean_cod", "is_active"))


@query(
    roles=("history",),
    extra={"s": SCORE},
    sql="""SELECT *, CASE WHEN COUNT(score) OVER w >= 2 THEN ROUND(AVG(score) OVER w, 1) END AS score_4w_avg FROM s
           WINDOW w AS (PARTITION BY brand_key, channel_key ORDER BY period_key ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
)
def rolling_score_4(t: Tables) -> DataFrame:
    return rounded(series.rolling_score(score_rows(t), KEYS, "period_key", "score"), 1)


@query(
    roles=("history",),
    extra={"s": SCORE},
    sql="""SELECT *, CAST(SUM(CASE WHEN score > 45 THEN 1 ELSE 0 END) OVER w AS BIGINT) = 2 AS alert_flag FROM s
           WINDOW w AS (PARTITION BY brand_key, channel_key ORDER BY period_key ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""",
)
def consecutive_alert(t: Tables) -> DataFrame:
    return series.consecutive_alert(score_rows(t), KEYS, "period_key", "score", 45.0)


STREAK = {
    "f": "SELECT brand_key, channel_key, period_key, CAST(SIGN(ROUND(forecasted_units - actual_units, 4)) AS INT) AS miss_direction FROM forecast",
    "st": f"SELECT *, CASE WHEN LAG(miss_direction) {W} = miss_direction THEN 0 ELSE 1 END AS st FROM f",
    "ru": f"SELECT *, SUM(st) {W} AS run FROM st",
    "po": "SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY brand_key, channel_key, run ORDER BY period_key) AS INT) AS pos FROM ru",
}


@query(
    roles=("forecast",),
    extra=STREAK,
    sql="""SELECT brand_key, channel_key, period_key, miss_direction, CASE WHEN miss_direction <> 0 THEN pos ELSE 0 END AS miss_streak,
                  miss_direction <> 0 AND pos >= 3 AS forecast_review FROM po""",
)
def consecutive_miss_streak(t: Tables) -> DataFrame:
    rows = t.forecast.withColumn("forecasted_units", S.stable_round(F.col("forecasted_units"), 4))
    out = series.consecutive_miss_streak(rows, KEYS, "period_key")
    return out.select(*KEYS, "period_key", "miss_direction", "miss_streak", "forecast_review")


@query(
    roles=("history",),
    sql=f"""SELECT brand_key, channel_key, period_key, value_share, ROUND(value_share - LAG(value_share) {W}, 4) + 0.0 AS share_change_pp,
                   ROW_NUMBER() {W} = 1 AS new_entrant FROM history""",
)
def share_change(t: Tables) -> DataFrame:
    rows = t.history.select(*KEYS, "period_key", "value_share")
    return rounded(series.share_change(rows, KEYS, "period_key", "value_share"))


@query(
    roles=("history",),
    sql="""SELECT a.brand_key, a.channel_key, a.fecha_month, a.revenue, b.revenue AS prior_value, ROUND(a.revenue / NULLIF(b.revenue, 0) - 1, 4) + 0.0 AS growth
           FROM history a LEFT JOIN history b ON a.brand_key = b.brand_key AND a.channel_key = b.channel_key
             AND a.fecha_month = CAST(b.fecha_month + INTERVAL 12 MONTH AS DATE)""",
)
def yoy_growth(t: Tables) -> DataFrame:
    rows = t.history.select(*KEYS, "fecha_month", "revenue")
    return rounded(series.growth_to_earlier(rows, KEYS, "fecha_month", "revenue"))


@query(
    roles=("history",),
    extra={
        "c": "SELECT channel_key, fecha_month, ROUND(SUM(revenue), 2) AS revenue FROM history GROUP BY ALL",
        "g": """SELECT a.channel_key, a.fecha_month, a.revenue / NULLIF(b.revenue, 0) - 1 AS growth FROM c a LEFT JOIN c b
                  ON a.channel_key = b.channel_key AND a.fecha_month = CAST(b.fecha_month + INTERVAL 12 MONTH AS DATE)""",
        "x": """SELECT a.brand_key, a.channel_key, a.fecha_month, a.revenue / NULLIF(b.revenue, 0) - 1 AS growth FROM history a LEFT JOIN history b
                  ON a.brand_key = b.brand_key AND a.channel_key = b.channel_key AND a.fecha_month = CAST(b.fecha_month + INTERVAL 12 MONTH AS DATE)""",
    },
    sql="""SELECT x.brand_key, x.channel_key, x.fecha_month, ROUND(x.growth - g.growth, 4) + 0.0 AS market_adjusted_growth
           FROM x JOIN g ON x.channel_key = g.channel_key AND x.fecha_month = g.fecha_month""",
)
def market_adjusted_growth(t: Tables) -> DataFrame:
    """Brand growth minus growth of its category; NULL without a year of history."""
    rows = t.history.select(*KEYS, "fecha_month", "revenue")
    brand = series.growth_to_earlier(rows, KEYS, "fecha_month", "revenue").select(*KEYS, "fecha_month", "growth")
    total = rows.groupBy("channel_key", "fecha_month").agg(S.stable_round(F.sum("revenue"), 2).alias("revenue"))
    market = series.growth_to_earlier(total, ["channel_key"], "fecha_month", "revenue").select(
        "channel_key", "fecha_month", F.col("growth").alias("market_growth")
    )
    joined = brand.join(market, ["channel_key", "fecha_month"])
    adjusted = S.market_adjusted_growth(F.col("growth"), F.col("market_growth"))
    return rounded(joined.select(*KEYS, "fecha_month", adjusted.alias("market_adjusted_growth")))


ADSTOCK_SQL = """
    SELECT a.brand_key, a.channel_key, a.week_start, ROUND(ANY_VALUE(a.spend), 2) AS spend,
           ROUND(SUM(b.spend * POWER({decay}::DOUBLE, (a.week_start - b.week_start) // 7)), 4) AS adstock
    FROM weekly_spend a JOIN weekly_spend b ON a.brand_key = b.brand_key AND a.channel_key = b.channel_key AND b.week_start <= a.week_start
    GROUP BY a.brand_key, a.channel_key, a.week_start"""


@query(roles=("weekly_spend",), sql=ADSTOCK_SQL.format(decay=0.5))
def adstock(t: Tables) -> DataFrame:
    return rounded(series.adstock(t.weekly_spend, KEYS, "week_start", "spend", 0.5), 4, spend=2)


WR = "PARTITION BY brand_key, channel_key ORDER BY t RANGE BETWEEN"


@query(
    roles=("weekly", "weekly_spend"),
    extra={
        "w": f"""SELECT a.brand_key, a.channel_key, a.week_start, a.units, s.spend, a.units > 100 AS promo, {WEEK_NO.replace('week_start', 'a.week_start')} AS t
                 FROM weekly a LEFT JOIN weekly_spend s ON a.brand_key = s.brand_key AND a.channel_key = s.channel_key AND a.week_start = s.week_start""",
        "x": f"""SELECT *, MAX(units) OVER ({WR} 4 PRECEDING AND 4 PRECEDING) AS units_lag4w, MAX(units) OVER ({WR} 8 PRECEDING AND 8 PRECEDING) AS units_lag8w,
                        MAX(units) OVER ({WR} 13 PRECEDING AND 13 PRECEDING) AS units_lag13w, AVG(units) OVER ({WR} 3 PRECEDING AND CURRENT ROW) AS m4,
                        AVG(units) OVER ({WR} 12 PRECEDING AND CURRENT ROW) AS m13, MAX(spend) OVER ({WR} 4 PRECEDING AND 4 PRECEDING) AS spend_lag4w,
                        t - MIN(t) OVER (PARTITION BY brand_key, channel_key) AS sku_age_weeks,
                        t - MAX(CASE WHEN promo THEN t END) OVER ({WR} UNBOUNDED PRECEDING AND CURRENT ROW) AS weeks_since_promotion FROM w""",
    },
    sql="""SELECT brand_key, channel_key, week_start, ROUND(units, 4) AS units, ROUND(spend, 4) AS spend, promo, ROUND(units_lag4w, 4) AS units_lag4w, ROUND(units_lag8w, 4) AS units_lag8w,
                  ROUND(units_lag13w, 4) AS units_lag13w, ROUND(m4, 4) AS units_rolling_mean_4w, ROUND(m13, 4) AS units_rolling_mean_13w, ROUND(spend_lag4w, 4) AS spend_lag4w,
                  CAST(sku_age_weeks AS INT) AS sku_age_weeks, 'Q' || QUARTER(week_start) AS season, CAST(weeks_since_promotion AS INT) AS weeks_since_promotion, promo AS is_promotion_active FROM x""",
)
def lag_rolling_features(t: Tables) -> DataFrame:
    rows = t.weekly.select(*KEYS, "week_start", "units").join(t.weekly_spend, [*KEYS, "week_start"], "left")
    rows = rows.withColumn("promo", F.col("units") > 100)
    out = series.lag_rolling_features(rows, KEYS, "week_start", "units", other_lags={"spend": 4}, promo="promo")
    return rounded(out)


# --- fits --------------------------------------------------------------------------------------

JOINED = """SELECT COALESCE(a.brand_key, s.brand_key) AS brand_key, COALESCE(a.channel_key, s.channel_key) AS channel_key,
                   COALESCE(a.week_start, s.week_start) AS week_start, COALESCE(s.spend, 0) AS spend, COALESCE(a.units, 0) AS units
            FROM weekly a FULL JOIN weekly_spend s ON a.brand_key = s.brand_key AND a.channel_key = s.channel_key AND a.week_start = s.week_start"""


def spend_and_units(t: Tables) -> DataFrame:
    rows = t.weekly.select(*KEYS, "week_start", "units").join(t.weekly_spend, [*KEYS, "week_start"], "full")
    return rows.fillna(0.0, subset=["spend", "units"])


@query(
    roles=("weekly", "weekly_spend"),
    extra={
        "j": JOINED,
        "g": "SELECT UNNEST([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS decay",
        "st": """SELECT a.brand_key, a.channel_key, a.week_start, g.decay, ANY_VALUE(a.units) AS units,
                        SUM(b.spend * POWER(g.decay, (a.week_start - b.week_start) // 7)) AS stock
                 FROM j a JOIN j b ON a.brand_key = b.brand_key AND a.channel_key = b.channel_key AND b.week_start <= a.week_start, g
                 GROUP BY a.brand_key, a.channel_key, a.week_start, g.decay""",
        "c": "SELECT brand_key, channel_key, decay, ROUND(CORR(stock, units), 9) AS r FROM st GROUP BY ALL",
        "k": "SELECT * FROM c WHERE r IS NOT NULL AND NOT isnan(r)",
    },
    sql="""SELECT brand_key, channel_key, ARG_MAX(decay, STRUCT_PACK(r := r, d := -decay)) AS decay_rate, ROUND(MAX(r), 6) AS correlation FROM k GROUP BY ALL""",
)
def adstock_decay_fit(t: Tables) -> DataFrame:
    return rounded(models.adstock_decay_fit(spend_and_units(t), KEYS, "week_start", "spend", "units"), 6)


HILL_GRID = "[0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0]::DOUBLE[]"
HILL_ALPHA = "[0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0]::DOUBLE[]"


@query(
    roles=("weekly", "weekly_spend"),
    extra={
        "j": JOINED,
        "m": "SELECT brand_key, channel_key, AVG(spend) AS mean FROM j GROUP BY ALL HAVING AVG(spend) > 0",
        "g": f"SELECT mu, al FROM (SELECT UNNEST({HILL_GRID}) AS mu), (SELECT UNNEST({HILL_ALPHA}) AS al)",
        "h": """SELECT j.brand_key, j.channel_key, m.mean, g.mu, g.al, j.units AS y, POWER(j.spend, g.al) / (POWER(g.mu * m.mean, g.al) + POWER(j.spend, g.al)) AS h
                FROM j JOIN m ON j.brand_key = m.brand_key AND j.channel_key = m.channel_key, g""",
        "s": "SELECT brand_key, channel_key, mean, mu, al, SUM(h * y) AS hy, SUM(h * h) AS hh, SUM(y * y) AS yy, COUNT(*) AS n FROM h GROUP BY ALL",
        "e": "SELECT *, hy / NULLIF(hh, 0) AS b, ROUND((yy - hy / NULLIF(hh, 0) * hy) / NULLIF(yy, 0), 9) AS er FROM s",
        "r": "SELECT *, ROW_NUMBER() OVER (PARTITION BY brand_key, channel_key ORDER BY er NULLS FIRST, mu, al) AS rn FROM e",
    },
    sql="""SELECT brand_key, channel_key, ROUND(mu * mean, 4) AS hill_k, al AS hill_alpha, ROUND(b, 4) AS scale, ROUND(er, 4) AS relative_error, n AS n_points FROM r WHERE rn = 1""",
)
def hill_fit(t: Tables) -> DataFrame:
    return rounded(models.hill_fit(spend_and_units(t), KEYS, "spend", "units"))


@query(
    roles=("weekly_spend",),
    extra={"q": "SELECT brand_key, channel_key, QUANTILE_CONT(spend, 0.99) AS cap FROM weekly_spend GROUP BY ALL"},
    sql="""SELECT w.brand_key, w.channel_key, w.week_start, ROUND(w.spend, 4) AS spend, ROUND(LEAST(w.spend, q.cap), 4) AS spend_capped
           FROM weekly_spend w JOIN q ON w.brand_key = q.brand_key AND w.channel_key = q.channel_key""",
)
def winsorize(t: Tables) -> DataFrame:
    return rounded(models.winsorize(t.weekly_spend, KEYS, "spend"))


MMM = ["hill_spend", "promotion_active", "price_index_vs_category", "weighted_distribution", "is_holiday", "units_lag_1"]


def _elimination_sql(names: list[str], target: str) -> dict[str, str]:
    """Normal equations of centred columns, one elimination per step. A pivot that is next to nothing is skipped."""
    cols = [*names, target]
    n = len(names)
    cells = [(i, j) for i in range(n + 1) for j in range(n + 1)]
    moments = [f"COVAR_POP({cols[i]}, {cols[j]}) AS a{i}_{j}" for i, j in cells] + [f"AVG({c}) AS m{i}" for i, c in enumerate(cols)]
    steps = {"e0": f"SELECT brand_key, channel_key, COUNT(*) AS n_rows, {', '.join(moments)}, {', '.join(f'VAR_POP({c}) AS v{i}' for i, c in enumerate(cols))} FROM mm GROUP BY ALL"}
    for k in range(n):
        d = f"a{k}_{k}"
        ok = f"(v{k} > 0 AND {d} > v{k} * 1e-9::DOUBLE)"
        new = []
        for i, j in cells:
            if i == k:
                cell = f"1 / {d}" if j == k else f"a{k}_{j} / {d}"
            else:
                cell = f"-a{i}_{k} / {d}" if j == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / {d}"
            new.append(f"CASE WHEN {ok} THEN {cell} ELSE a{i}_{j} END AS a{i}_{j}")
        steps[f"e{k + 1}"] = f"SELECT * REPLACE ({', '.join(new)}), {ok} AS p{k} FROM e{k}"
    return steps


def _mmm_sql() -> str:
    beta = [f"CASE WHEN p{i} THEN a{i}_{len(MMM)} ELSE 0 END" for i in range(len(MMM))]
    intercept = " - ".join([f"m{len(MMM)}", *[f"{b} * m{i}" for i, b in enumerate(beta)]])
    rank = " + ".join(f"CAST(p{i} AS INT)" for i in range(len(MMM)))
    shown = ", ".join(f"ROUND({b}, 4) + 0.0 AS {n}_coef" for n, b in zip(MMM, beta, strict=True))
    y = len(MMM)
    return f"""SELECT brand_key, channel_key, n_rows, 1 + {rank} AS matrix_rank, ROUND({intercept}, 4) + 0.0 AS intercept_coef, {shown},
        ROUND(CASE WHEN v{y} > 0 THEN 1 - a{y}_{y} / v{y} END, 4) + 0.0 AS r2 FROM e{y}"""


@query(
    roles=("history", "weekly_spend"),
    extra={
        "ms": "SELECT brand_key, channel_key, CAST(DATE_TRUNC('month', week_start) AS DATE) AS fecha_month, SUM(spend) AS spend FROM weekly_spend GROUP BY ALL",
        "ml": f"""SELECT h.*, COALESCE(s.spend, 0) / (100 + COALESCE(s.spend, 0)) AS hill_spend, CAST(MONTH(h.fecha_month) = 12 AS DOUBLE) AS is_holiday,
                     CAST(period_key % 3 = 0 AS DOUBLE) AS promotion_active, LAG(units) {W} AS units_lag_1 FROM history h LEFT JOIN ms s USING (brand_key, channel_key, fecha_month)""",
        "mm": "SELECT * FROM ml WHERE units_lag_1 IS NOT NULL AND hill_spend IS NOT NULL AND price_index_vs_category IS NOT NULL AND weighted_distribution IS NOT NULL AND units IS NOT NULL",
    }
    | _elimination_sql(MMM, "units"),
    sql=_mmm_sql(),
)
def mmm_regression(t: Tables) -> DataFrame:
    """Units on transformed spend, price, distribution and season, per brand and channel."""
    month = S.month_trunc(F.col("week_start"))
    spend = t.weekly_spend.groupBy(*KEYS, month.alias("fecha_month")).agg(F.sum("spend").alias("spend"))
    rows = t.history.join(spend, [*KEYS, "fecha_month"], "left").fillna(0.0, subset=["spend"])
    rows = rows.withColumns(
        {
            "hill_spend": S.hill_response(F.col("spend"), F.lit(100.0), F.lit(1.0)),
            "is_holiday": (F.month("fecha_month") == 12).cast("double"),
            "promotion_active": (F.col("period_key") % 3 == 0).cast("double"),
        }
    )
    lagged = series.period_lags(rows, KEYS, "period_key", {"units": [1]}, "units_lag_1")
    return rounded(models.mmm_regression(lagged, KEYS, MMM, "units"), 4)


@query(
    roles=("history",),
    extra={
        "x": """SELECT brand_key, channel_key, COUNT(*) AS n, REGR_SLOPE(units, price_index_vs_category) AS b1, REGR_INTERCEPT(units, price_index_vs_category) AS b0,
                       REGR_R2(units, price_index_vs_category) AS r2 FROM history GROUP BY ALL"""
    },
    sql="""SELECT brand_key, channel_key, n AS n_rows, 2 AS matrix_rank, ROUND(b0, 4) AS intercept_coef, ROUND(b1, 4) AS price_index_vs_category_coef, ROUND(r2, 4) AS r2 FROM x""",
)
def price_regression(t: Tables) -> DataFrame:
    """The regression with a single feature, where SQL has its own least squares."""
    return rounded(models.mmm_regression(t.history, KEYS, ["price_index_vs_category"], "units"))


@query(
    roles=("history",),
    extra={
        "w": """SELECT brand_key, channel_key, period_key, value_share, value_share > 4 AS flag,
                       MIN(value_share) OVER (PARTITION BY brand_key, channel_key ORDER BY period_key RANGE BETWEEN 1 FOLLOWING AND 8 FOLLOWING) AS low FROM history""",
        "j": "SELECT *, low - value_share <= -0.5 AS lost FROM w WHERE low IS NOT NULL",
        "n": """SELECT COUNT(*) AS n_judged, COUNT(CASE WHEN flag THEN 1 END) AS n_flags, COUNT(CASE WHEN lost THEN 1 END) AS n_losses,
                       COUNT(CASE WHEN flag AND lost THEN 1 END) AS true_positives, COUNT(CASE WHEN flag AND NOT lost THEN 1 END) AS false_positives FROM j""",
    },
    sql="SELECT *, ROUND(true_positives * 1.0::DOUBLE / NULLIF(n_losses, 0), 6) AS recall, ROUND(false_positives * 1.0::DOUBLE / NULLIF(n_flags, 0), 6) AS false_positive_rate FROM n",
)
def retrospective_alert_eval(t: Tables) -> DataFrame:
    rows = t.history.withColumn("score", F.col("value_share"))
    return rounded(decisions.retrospective_alert_eval(rows, KEYS, "period_key", "score", "value_share", threshold=4.0), 6)
