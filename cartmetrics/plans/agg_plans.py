"""Descriptive aggregates, set comparisons and top values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import checks, kpi, quality_aggs, sets, std
from cartmetrics.operators.profiling import column_scores
from cartmetrics.operators.series import share_of_total as share_of_total_op
from cartmetrics.plans.join_plans import WAPE_ROWS, wape_rows
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.roles import Tables

# --- keys and labels ---------------------------------------------------------------------------


@query(
    roles=("items",),
    sql="""SELECT category, COUNT(*) AS total_rows, COUNT(DISTINCT sku_ean_cod) AS distinct_codes,
                  COUNT(CASE WHEN sku_ean_cod IS NULL THEN 1 END) AS null_codes,
                  ROUND(COUNT(CASE WHEN sku_ean_cod IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*), 6) AS null_pct
           FROM items GROUP BY category""",
)
def key_coverage_by_level(t: Tables) -> DataFrame:
    return rounded(quality_aggs.key_coverage_by_level(t.items, "category", "sku_ean_cod"), 6)


@query(
    roles=("dictionary",),
    sql="""SELECT COUNT(*) AS total_rows, COUNT(DISTINCT old_cus_idt) AS distinct_old, COUNT(DISTINCT new_cus_idt) AS distinct_new,
                  COUNT(CASE WHEN old_cus_idt = new_cus_idt THEN 1 END) AS no_change_rows FROM dictionary""",
)
def dictionary_stats(t: Tables) -> DataFrame:
    return quality_aggs.dictionary_stats(t.dictionary)


BRANDED = {
    "best": "SELECT variant, ARG_MIN(canonical, priority) AS canonical FROM crosswalk GROUP BY variant",
    "b": """SELECT m.*, COALESCE(best.canonical, UPPER(TRIM(marca))) AS marca_std FROM media m LEFT JOIN best ON UPPER(TRIM(marca)) = best.variant""",
}


@query(
    roles=("media", "crosswalk"),
    extra=BRANDED,
    sql="SELECT marca, marca_std, COUNT(DISTINCT campana) AS distinct_products FROM b GROUP BY ALL",
)
def brand_label_products(t: Tables) -> DataFrame:
    return quality_aggs.brand_label_products(std.brand_std(t.media, "marca", t.crosswalk), "marca", "marca_std", "campana")


@query(
    roles=("media", "crosswalk"),
    extra=BRANDED,
    sql="""SELECT COUNT(DISTINCT marca) AS distinct_labels,
                  COUNT(DISTINCT CASE WHEN UPPER(TRIM(marca)) <> marca_std THEN marca END) AS mapped_labels,
                  COUNT(DISTINCT CASE WHEN UPPER(TRIM(marca)) = marca_std THEN marca END) AS passthrough_labels,
                  COUNT(CASE WHEN marca IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*) AS null_pct FROM b""",
)
def mapped_passthrough_counts(t: Tables) -> DataFrame:
    return quality_aggs.mapped_passthrough_counts(std.brand_std(t.media, "marca", t.crosswalk), "marca", "marca_std")


@query(
    roles=("weekly_spend",),
    sql="""SELECT brand_key, channel_key, ROUND(STDDEV(spend), 4) AS spend_stddev, ROUND(AVG(spend), 4) AS spend_mean,
                  ROUND(STDDEV(spend) / NULLIF(AVG(spend), 0), 4) AS coeff_variation, STDDEV(spend) / NULLIF(AVG(spend), 0) < 0.20 AS saturation_not_observable
           FROM weekly_spend GROUP BY ALL""",
)
def mix_variation_profile(t: Tables) -> DataFrame:
    return rounded(quality_aggs.mix_variation_profile(t.weekly_spend, ["brand_key", "channel_key"], "spend"))


SCORE = "SELECT brand_key, channel_key, period_key, ROUND(value_share * 5 + 20, 1) AS score FROM history"


FINE_SCORE = "SELECT brand_key, channel_key, period_key, ROUND(value_share * 5 + 20, 4) AS score FROM history"


def score_rows(t: Tables, digits: int = 1) -> DataFrame:
    """A score per brand, channel and month made from its share."""
    return t.history.select(
        "brand_key", "channel_key", "period_key", S.stable_round(F.col("value_share") * 5 + 20, digits).alias("score")
    )


@query(
    roles=("history",),
    extra={
        "s": FINE_SCORE,
        "q": """SELECT QUANTILE_CONT(score, 0.10) AS p10, QUANTILE_CONT(score, 0.25) AS p25, QUANTILE_CONT(score, 0.75) AS p75,
                       QUANTILE_CONT(score, 0.90) AS p90, AVG(score) AS mean, STDDEV(score) AS stddev, MIN(score) AS min, MAX(score) AS max FROM s""",
    },
    sql="""SELECT ROUND(p10, 4) AS p10, ROUND(p25, 4) AS p25, ROUND(p75, 4) AS p75, ROUND(p90, 4) AS p90, ROUND(mean, 4) AS mean,
                  ROUND(stddev, 4) AS stddev, ROUND(min, 4) AS min, ROUND(max, 4) AS max, ROUND(p75 - p25, 4) AS iqr, p75 - p25 < 15 AS needs_recalibration FROM q""",
)
def score_distribution(t: Tables) -> DataFrame:
    return rounded(quality_aggs.score_distribution(score_rows(t, 4), "score"))


@query(
    roles=("forecast",),
    sql=f"""SELECT channel_type, ROUND(SUM(ABS(forecasted_units - actual_units)) / NULLIF(SUM(actual_units), 0), 6) AS wape_actual,
                   COUNT(DISTINCT brand_key) AS n_brands_evaluated, COUNT(*) AS n_skus_evaluated FROM ({WAPE_ROWS}) GROUP BY channel_type""",
)
def wape(t: Tables) -> DataFrame:
    return rounded(quality_aggs.wape(wape_rows(t), ["channel_type"]), 6)


@query(
    roles=("forecast",),
    sql="""SELECT brand_key, channel_key, period_key,
                  ROUND(AVG(CASE WHEN actual_units <> 0 THEN (forecasted_units - actual_units) / actual_units END)
                    OVER (PARTITION BY brand_key, channel_key ORDER BY period_key ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), 6) AS forecast_bias FROM forecast""",
)
def forecast_bias(t: Tables) -> DataFrame:
    out = quality_aggs.forecast_bias(t.forecast, ["brand_key", "channel_key"], "period_key", 13)
    return rounded(out.select("brand_key", "channel_key", "period_key", "forecast_bias"), 6)


@query(
    roles=("items",),
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS null_rows,
            COUNT(CASE WHEN TRIM({c}) = '' THEN 1 END) AS blank_rows, COUNT(CASE WHEN {c} IS NULL AND is_active THEN 1 END) AS null_active_rows FROM items"""
        for c in ("mat_idt", "sku_ean_cod", "brand")
    ),
)
def count_if_audit(t: Tables) -> DataFrame:
    return quality_aggs.count_if_audit(t.items, ["mat_idt", "sku_ean_cod", "brand"], F.col("is_active"))


@query(
    roles=("items",),
    sql="""SELECT sku_ean_cod, COUNT(DISTINCT mat_idt) AS n_products, COUNT(DISTINCT CASE WHEN is_active THEN mat_idt END) AS n_active_products,
                  COUNT(DISTINCT brand) AS n_brands, COUNT(DISTINCT mat_lcl_dsc) AS n_descriptions,
                  STRING_AGG(DISTINCT CAST(is_active AS VARCHAR), ',' ORDER BY CAST(is_active AS VARCHAR)) AS active_flags
           FROM items WHERE sku_ean_cod IS NOT NULL GROUP BY sku_ean_cod HAVING COUNT(DISTINCT mat_idt) > 1""",
)
def ean_cardinality(t: Tables) -> DataFrame:
    return quality_aggs.ean_cardinality(t.items)


@query(
    roles=("items",),
    sql="""SELECT sku_ean_cod, COUNT(DISTINCT mat_idt) AS n_active_products FROM items WHERE sku_ean_cod IS NOT NULL AND is_active
           GROUP BY sku_ean_cod HAVING COUNT(DISTINCT mat_idt) > 1""",
)
def active_conflict(t: Tables) -> DataFrame:
    return quality_aggs.active_conflict(t.items)


@query(
    roles=("sell_out",),
    extra={"k": "SELECT COUNT(*) AS n FROM sell_out GROUP BY fecha_month, marca_std"},
    sql="""SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, ROUND(SUM(n) / COUNT(*), 4) AS rows_per_key,
                  CASE WHEN SUM(n) / COUNT(*) > 10 THEN 'WARN' ELSE 'PASS' END AS status FROM k""",
)
def grain_fanout_ratio(t: Tables) -> DataFrame:
    return rounded(quality_aggs.grain_fanout_ratio(t.sell_out, ["fecha_month", "marca_std"]))


@query(
    roles=("sell_out",),
    sql="""SELECT canal_std, COUNT(*) AS n_rows, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS pct_rows FROM sell_out GROUP BY canal_std""",
)
def share_of_total(t: Tables) -> DataFrame:
    return rounded(share_of_total_op(t.sell_out, "canal_std"), 6)


# --- sets --------------------------------------------------------------------------------------


@query(
    roles=("sell_out",),
    sql="""SELECT upc, COUNT(*) AS n_rows, ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS pct_rows FROM sell_out
           GROUP BY upc ORDER BY COUNT(*) DESC, upc NULLS FIRST LIMIT 30""",
)
def top_values(t: Tables) -> DataFrame:
    return rounded(sets.top_values(t.sell_out, "upc", 30), 6)


def _score_sql(source: str, table: str, column: str) -> str:
    return f"""SELECT '{source}' AS source, '{column}' AS column_name, ROUND((1 - COUNT(CASE WHEN {column} IS NULL THEN 1 END) * 1.0::DOUBLE / COUNT(*))
                      * LN(1 + COUNT(DISTINCT {column})), 4) AS d1_score FROM {table}"""


@query(
    roles=("stores", "items"),
    extra={
        "s": " UNION ALL ".join(
            [_score_sql("STORES", "stores", c) for c in ("chain", "format", "region")]
            + [_score_sql("ITEMS", "items", c) for c in ("brand", "category", "sku_ean_cod")]
        )
    },
    sql="SELECT source, MAX(d1_score) AS best_score, ARG_MAX(column_name, d1_score) AS best_column FROM s GROUP BY source",
)
def best_column_select(t: Tables) -> DataFrame:
    a = column_scores(t.stores, "STORES", ["chain", "format", "region"])
    b = column_scores(t.items, "ITEMS", ["brand", "category", "sku_ean_cod"])
    return sets.best_column_select(a.unionByName(b), "source", "column_name", "d1_score")


@query(
    roles=("media",),
    sql="""SELECT fecha, marca, campana, inversion_real, soporte_plataforma, 'MKT_ON' AS investment_source FROM media WHERE investment_source = 'MKT_ON'
           UNION ALL SELECT fecha, marca, campana, inversion_real, NULL, 'MKT_OFF' FROM media WHERE investment_source = 'MKT_OFF'""",
)
def union_tagged_sources(t: Tables) -> DataFrame:
    rows = t.media.withColumnRenamed("investment_source", "kind")
    frames = {"MKT_ON": rows.filter("kind = 'MKT_ON'"), "MKT_OFF": rows.filter("kind = 'MKT_OFF'").drop("soporte_plataforma")}
    columns = ["fecha", "marca", "campana", "inversion_real", "soporte_plataforma"]
    return std.union_tagged_sources(frames, columns, "investment_source")


@query(
    """SELECT 'C' || c_custkey AS id, c_mktsegment, NULL AS s_name, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'S' || s_suppkey, NULL, s_name, s_acctbal FROM supplier
       UNION ALL SELECT 'N' || n_nationkey, NULL, NULL, NULL FROM nation"""
)
def union_by_name_missing(t: Tables) -> DataFrame:
    label = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("id")
    a = t.customer.select(label("C", "c_custkey"), "c_mktsegment", F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(label("S", "s_suppkey"), "s_name", F.col("s_acctbal").alias("balance"))
    c = t.nation.select(label("N", "n_nationkey"))
    return std.union_by_name_missing([a, b, c])


@query(
    roles=("market_rows",),
    sql="""SELECT fact_column, 'LEVEL_11' AS branch, COUNT(*) AS n_rows FROM market_rows WHERE hierarchy_level = 11 GROUP BY ALL
           UNION ALL SELECT fact_column, 'LEVEL_9', COUNT(*) FROM market_rows WHERE hierarchy_level = 9 AND fact_value > 50 GROUP BY ALL""",
)
def union_all_branches(t: Tables) -> DataFrame:
    a = std.hierarchy_level_filter(t.market_rows, 11).withColumn("branch", F.lit("LEVEL_11"))
    b = std.hierarchy_level_filter(t.market_rows, 9).filter("fact_value > 50").withColumn("branch", F.lit("LEVEL_9"))
    return a.unionByName(b).groupBy("fact_column", "branch").agg(F.count("*").alias("n_rows"))


@query(roles=("media",), sql="SELECT DISTINCT UPPER(TRIM(marca)) AS value FROM media WHERE marca IS NOT NULL")
def distinct_values(t: Tables) -> DataFrame:
    return sets.distinct_values(t.media, "marca")


OVERLAP = {
    "a": "SELECT DISTINCT UPPER(TRIM(marca)) AS value FROM media WHERE marca IS NOT NULL",
    "b": "SELECT DISTINCT UPPER(TRIM(brand)) AS value FROM items WHERE brand IS NOT NULL",
    "f": "SELECT COALESCE(a.value, b.value) AS value, a.value IS NOT NULL AS l, b.value IS NOT NULL AS r FROM a FULL JOIN b ON a.value = b.value",
    "n": "SELECT COUNT(CASE WHEN l AND r THEN 1 END) AS in_both, COUNT(CASE WHEN NOT r THEN 1 END) AS left_only, COUNT(CASE WHEN NOT l THEN 1 END) AS right_only FROM f",
}


@query(
    roles=("media", "items"),
    extra=OVERLAP,
    sql="""SELECT *, ROUND(in_both * 100.0::DOUBLE / (in_both + left_only), 6) AS match_pct,
                  CASE WHEN in_both * 100.0::DOUBLE / (in_both + left_only) < 70 THEN 'WARN' ELSE 'PASS' END AS status FROM n""",
)
def value_overlap(t: Tables) -> DataFrame:
    return rounded(sets.value_overlap(t.media, t.items, "marca", "brand"), 6)


@query(
    roles=("media", "items"),
    extra=OVERLAP | {"p": "SELECT *, ROUND(in_both * 100.0::DOUBLE / (in_both + left_only + right_only), 2) AS overlap_pct FROM n"},
    sql="SELECT *, ROUND(LN(1 + in_both) * overlap_pct / 100, 4) AS alignment_score FROM p",
)
def jaccard_overlap(t: Tables) -> DataFrame:
    return sets.jaccard_overlap(t.media, t.items, "marca", "brand")


@query(
    roles=("media", "items"),
    extra=OVERLAP,
    sql="SELECT value, CASE WHEN l AND r THEN 'IN_BOTH' WHEN l THEN 'LEFT_ONLY' ELSE 'RIGHT_ONLY' END AS membership FROM f",
)
def overlap_membership(t: Tables) -> DataFrame:
    return sets.overlap_membership(t.media, t.items, "marca", "brand")


@query(
    roles=("media", "items"),
    extra=OVERLAP,
    sql="SELECT value, CASE WHEN l THEN 'MEDIA' ELSE 'ITEMS' END AS source, l AND r AS in_other_source FROM f",
)
def presence_seed(t: Tables) -> DataFrame:
    return sets.presence_seed(t.media, t.items, "marca", "brand", "MEDIA", "ITEMS")


SET_SQL = {
    "lines": "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS value FROM lineitem",
    "parts": "SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS value FROM part",
    "orders_c": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders",
    "cust": "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS value FROM customer",
}
_NAMES = list(SET_SQL)
_PAIRS = [(a, b) for i, a in enumerate(_NAMES) for b in _NAMES[i + 1 :]]


@query(
    extra=SET_SQL,
    sql=" UNION ALL ".join(
        [f"SELECT '{a}|{b}' AS pair, COUNT(*) AS shared_values FROM {a} JOIN {b} USING (value)" for a, b in _PAIRS]
        + ["SELECT 'ALL', COUNT(*) FROM lines JOIN parts USING (value) JOIN orders_c USING (value) JOIN cust USING (value)"]
    ),
)
def pairwise_overlap_matrix(t: Tables) -> DataFrame:
    text = lambda df, c: df.select(F.col(c).cast("string").alias("value")).distinct()
    return sets.pairwise_overlap_matrix(
        {
            "lines": text(t.lineitem, "l_partkey"),
            "parts": text(t.part, "p_partkey"),
            "orders_c": text(t.orders, "o_custkey"),
            "cust": text(t.customer, "c_custkey"),
        }
    )


@query(
    roles=("sell_in",),
    extra={
        "d": "SELECT cbu, SUM(revenue_mxn) AS t, COUNT(*) AS n FROM sell_in GROUP BY cbu",
        "k": "SELECT cbu, mat_idt, fecha_month, SUM(revenue_mxn) AS t, COUNT(*) AS n FROM sell_in GROUP BY ALL",
        "r": "SELECT cbu, SUM(t) AS t, CAST(SUM(n) AS BIGINT) AS n FROM k GROUP BY cbu",
    },
    sql="""SELECT d.cbu, ROUND(d.t, 2) AS direct_total, d.n AS direct_rows, ROUND(r.t, 2) AS rolled_total, r.n AS rolled_rows,
                  CASE WHEN ABS(d.t - r.t) < 0.005 AND d.n = r.n THEN 'MATCH' ELSE 'DIFFERENT' END AS status FROM d JOIN r ON d.cbu IS NOT DISTINCT FROM r.cbu""",
)
def sell_in_grain_reconcile(t: Tables) -> DataFrame:
    return rounded(kpi.old_new_grain_reconcile(t.sell_in, ["cbu"], ["mat_idt", "fecha_month"], "revenue_mxn"), 2)


_NULLED = {"o_orderkey": "o_orderkey", "some_key": "NULLIF(o_orderkey % 60, 0)", "priority": "NULLIF(SUBSTR(o_orderpriority, 1, 1), '1')"}


@query(
    extra={
        "n": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(*) - COUNT({e}) AS null_rows FROM orders" for c, e in _NULLED.items()
        ),
        "p": "SELECT *, null_rows * 100.0::DOUBLE / total_rows AS pct FROM n",
    },
    sql="""SELECT column_name, total_rows, null_rows, ROUND(pct, 6) AS null_pct, CASE WHEN pct > 5 THEN 'HIGH' WHEN pct > 1 THEN 'WARN' ELSE 'OK' END AS null_flag FROM p""",
)
def null_rate_orders(t: Tables) -> DataFrame:
    """A full column, one with a few NULLs and one with many."""
    rows = t.orders.select("o_orderkey", F.expr("nullif(o_orderkey % 60, 0)").alias("some_key"), F.expr("nullif(substr(o_orderpriority, 1, 1), '1')").alias("priority"))
    return rounded(checks.null_rate_report(rows, list(_NULLED)), 6)
