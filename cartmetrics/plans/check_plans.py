"""Data-quality checks, gates and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import labels
from cartmetrics.functions import scalars as S
from cartmetrics.operators import checks, kpi, std
from cartmetrics.operators.checks import Check, Rule

from cartmetrics.plans.registry import query, rounded
from cartmetrics.plans.std_plans import channel_seed
from cartmetrics.sources.readers import config_frame
from cartmetrics.sources.roles import Tables


def check_sql(check_id: str, table: str, metric: str, threshold: float, fails: str, severity: str, source: str) -> str:
    """Oracle text of one check row."""
    op = {"above": ">", "below": "<", "equal": "="}[fails]
    return (
        f"SELECT '{check_id}' AS check_id, '{table}' AS table_name, CAST(m AS DOUBLE) AS metric, {threshold}::DOUBLE AS threshold, "
        f"CASE WHEN m {op} {threshold} THEN '{severity}' ELSE 'PASS' END AS status FROM (SELECT {metric} AS m FROM {source})"
    )


def checks_sql(table: str, source: str, rows: list[tuple[str, str, float, str, str]]) -> str:
    return " UNION ALL ".join(check_sql(i, table, m, t, f, s, source) for i, m, t, f, s in rows)


COUNT_IF = "COUNT(CASE WHEN {0} THEN 1 END)".format

# --- one pass over one table -------------------------------------------------------------------


@query(
    """SELECT check_id, 'lineitem' AS table_name, CAST(m AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold, CASE WHEN m > 0 THEN 'BLOCKER' ELSE 'PASS' END AS status FROM (
         SELECT 'B10_unique:l_orderkey,l_linenumber' AS check_id, (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS m)"""
)
def check_unique_keys(t: Tables) -> DataFrame:
    return checks.run_checks(t.lineitem, "lineitem", [checks.check_unique_keys(["l_orderkey", "l_linenumber"])])


@query(
    roles=("sales", "stores"),
    sql="""SELECT 'B8_no_fanout' AS check_id, 'sales x stores' AS table_name, CAST(b - a AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold, CASE WHEN b > a THEN 'BLOCKER' ELSE 'PASS' END AS status
           FROM (SELECT (SELECT COUNT(*) FROM sales) AS a, (SELECT COUNT(*) FROM sales s LEFT JOIN stores t ON s.store_id = t.store_id) AS b)""",
)
def check_no_fanout(t: Tables) -> DataFrame:
    after = t.sales.join(t.stores, "store_id", "left")
    return checks.check_no_fanout(t.sales, after, "sales x stores")


@query(
    """SELECT 'R15_row_count' AS check_id, label AS table_name, CAST(b - a AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold,
              CASE WHEN b = a THEN 'PASS' WHEN b > a THEN 'BLOCKER' ELSE sev END AS status FROM (
         SELECT 'orders x lines' AS label, 'BLOCKER' AS sev, (SELECT COUNT(*) FROM orders) AS a, (SELECT COUNT(*) FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey) AS b
         UNION ALL SELECT 'orders x customers', 'BLOCKER', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
         UNION ALL SELECT 'orders filtered', 'WARNING', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P')
         UNION ALL SELECT 'orders lost', 'BLOCKER', (SELECT COUNT(*) FROM orders), (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F'))"""
)
def check_row_count_exact(t: Tables) -> DataFrame:
    """A fan-out, a clean lookup, a documented filter and a silent loss."""
    o = t.orders
    lines = o.join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    customers = o.join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return std.union_by_name_missing(
        [
            checks.check_row_count_exact(o, lines, "orders x lines"),
            checks.check_row_count_exact(o, customers, "orders x customers"),
            checks.check_row_count_exact(o, o.filter("o_orderstatus <> 'P'"), "orders filtered", "partial orders are left out"),
            checks.check_row_count_exact(o, o.filter("o_orderstatus = 'F'"), "orders lost"),
        ]
    )


SELL_OUT_CHECKS = [
    ("B1_not_empty", "COUNT(*)", 1, "below", "BLOCKER"),
    ("B2_null_key:fecha_month", COUNT_IF("fecha_month IS NULL"), 0, "above", "BLOCKER"),
    ("B3_null_brand:marca_std", COUNT_IF("marca_std IS NULL"), 0, "above", "WARNING"),
    ("B11_month_range:fecha_month", COUNT_IF("fecha_month < DATE '1995-06-01' OR fecha_month > DATE '2001-01-01'"), 0, "above", "BLOCKER"),
    ("B13_first_of_month:fecha_month", COUNT_IF("DAY(fecha_month) <> 1"), 0, "above", "BLOCKER"),
    ("W1_month_coverage:fecha_month", "COUNT(DISTINCT fecha_month)", 12, "below", "WARNING"),
    ("W2_negative:revenue_sell_out", COUNT_IF("revenue_sell_out < 0"), 0, "above", "WARNING"),
    ("B4_inf_nan:price", COUNT_IF("isnan(revenue_sell_out / NULLIF(vol_sell_out, 0)) OR isinf(revenue_sell_out / NULLIF(vol_sell_out, 0))"), 0, "above", "BLOCKER"),
    ("A4_structural_null:cadena_raw", COUNT_IF("FALSE"), 0, "above", "BLOCKER"),
    ("V1_vocabulary:canal_std", COUNT_IF("canal_std NOT IN ('AUTOMOBILE','BUILDING','FURNITURE')"), 0, "above", "BLOCKER"),
]


def sell_out_check_rows(t: Tables) -> DataFrame:
    rows = t.sell_out.withColumns(
        {"price": S.safe_divide(F.col("revenue_sell_out"), F.col("vol_sell_out")), "cadena_raw": S.null_column()}
    )
    wanted = [
        checks.check_not_empty(),
        checks.check_null_key("fecha_month"),
        checks.check_null_key("marca_std", "B3_null_brand").warn(),
        *checks.check_month_range("fecha_month", "1995-06-01", "2001-01-01"),
        checks.check_month_coverage("fecha_month"),
        checks.check_negative("revenue_sell_out"),
        checks.check_no_inf_nan("price"),
        checks.check_structural_null("cadena_raw"),
        checks.check_closed_vocabulary("canal_std", ["AUTOMOBILE", "BUILDING", "FURNITURE"]),
    ]
    return checks.run_checks(rows, "sell_out", wanted)


@query(roles=("sell_out",), sql=checks_sql("sell_out", "sell_out", SELL_OUT_CHECKS))
def sell_out_checks(t: Tables) -> DataFrame:
    """Ten checks of one table in one pass."""
    return sell_out_check_rows(t)


@query(
    roles=("sell_out",),
    extra={"c": checks_sql("sell_out", "sell_out", SELL_OUT_CHECKS)},
    sql="""SELECT COUNT(*) AS n_checks, COUNT(CASE WHEN status = 'BLOCKER' THEN 1 END) AS n_blockers, COUNT(CASE WHEN status = 'WARNING' THEN 1 END) AS n_warnings,
                  CASE WHEN COUNT(CASE WHEN status = 'BLOCKER' THEN 1 END) > 0 THEN 'BLOCKED' WHEN COUNT(CASE WHEN status = 'WARNING' THEN 1 END) > 0 THEN 'CLEAR WITH WARNINGS' ELSE 'CLEAR' END AS gate FROM c""",
)
def quality_gate(t: Tables) -> DataFrame:
    return checks.quality_gate(sell_out_check_rows(t))


def _one(name: str, roles: tuple[str, ...], source: str, table: str, rows: tuple | list[tuple], plan) -> None:
    """Register the rows of a single check under its own name."""
    query(roles=roles, sql=checks_sql(table, source, rows if isinstance(rows, list) else [rows]), name=name)(plan)


_one(
    "check_month_range", ("sell_in",), "sell_in", "sell_in",
    [
        ("B11_month_range:fecha_month", COUNT_IF("fecha_month < DATE '1996-01-01'"), 0, "above", "BLOCKER"),
        ("B13_first_of_month:fecha_month", COUNT_IF("DAY(fecha_month) <> 1"), 0, "above", "BLOCKER"),
    ],
    lambda t: checks.run_checks(t.sell_in, "sell_in", checks.check_month_range("fecha_month", "1996-01-01")),
)
_one(
    "check_no_inf_nan", (), "customer", "customer",
    ("B4_inf_nan:c_acctbal", COUNT_IF("isnan(c_acctbal) OR isinf(c_acctbal)"), 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(t.customer, "customer", [checks.check_no_inf_nan("c_acctbal")]),
)
_one(
    "check_null_key", ("sell_in",), "sell_in", "sell_in",
    ("B3_null_brand:marca_std", COUNT_IF("marca_std IS NULL"), 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(t.sell_in, "sell_in", [checks.check_null_key("marca_std", "B3_null_brand")]),
)
_one(
    "check_negative", (), "customer", "customer",
    ("W2_negative:c_acctbal", COUNT_IF("c_acctbal < 0"), 0, "above", "WARNING"),
    lambda t: checks.run_checks(t.customer, "customer", [checks.check_negative("c_acctbal")]),
)
_one(
    "check_month_coverage", ("spend",), "spend", "spend",
    ("W1_month_coverage:fecha_month", "COUNT(DISTINCT fecha_month)", 60, "below", "WARNING"),
    lambda t: checks.run_checks(t.spend, "spend", [checks.check_month_coverage("fecha_month", 60)]),
)
_one(
    "check_structural_null", ("media",), "media WHERE investment_source = 'MKT_OFF'", "mkt_off",
    ("A4_structural_null:cadena_std", COUNT_IF("FALSE"), 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(
        t.media.filter("investment_source = 'MKT_OFF'").withColumn("cadena_std", S.null_column()),
        "mkt_off",
        [checks.check_structural_null("cadena_std")],
    ),
)
_one(
    "check_no_fuzzy", ("items",), "(SELECT CASE WHEN is_active THEN 'EXACT' ELSE 'Fuzzy_name' END AS match_method FROM items)", "matches",
    ("A7_no_fuzzy", COUNT_IF("LOWER(match_method) LIKE '%fuzzy%'"), 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(
        t.items.select(F.when(F.col("is_active"), "EXACT").otherwise("Fuzzy_name").alias("match_method")),
        "matches",
        [checks.check_no_fuzzy()],
    ),
)
_one(
    "check_expected_rows", (), "nation", "nation",
    ("A8_expected_rows", "ABS(COUNT(*) - 25)", 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(t.nation, "nation", [checks.check_expected_rows(25)]),
)
_one(
    "homologation_validate", ("sell_in",), "sell_in", "volumes",
    ("H1_lost:kg", COUNT_IF("dis_chl_cod = 'A' AND volume_liter IS NOT NULL"), 0, "above", "BLOCKER"),
    lambda t: checks.run_checks(
        t.sell_in.withColumn("unit", F.when(F.col("dis_chl_cod") == "A", "OTHER").otherwise(F.col("cbu"))).withColumn(
            "kg", S.volume_to_kg(F.col("unit"), F.col("volume_liter"))
        ),
        "volumes",
        [checks.homologation_validate("kg", "volume_liter")],
    ),
)


@query(
    roles=("shipments", "clients"),
    extra={
        "s": """SELECT CASE WHEN c IN ('MODERNO','NC MODERNO') THEN 'MODERNO' WHEN c = 'DTT' THEN 'TRADICIONAL' WHEN c = 'INTERNAL' THEN 'INTERNOS' ELSE c END AS channel
                FROM (SELECT UPPER(TRIM(canal_raw)) AS c FROM shipments JOIN clients ON shp_cus_idt = cus_idt)"""
    },
    sql="SELECT channel AS value, COUNT(*) AS n_rows FROM s WHERE channel NOT IN ('MODERNO','TRADICIONAL','INTERNOS') GROUP BY channel",
)
def check_closed_vocabulary(t: Tables) -> DataFrame:
    """Channel values outside the closed list, which is itself a table."""
    per_customer = t.shipments.groupBy("shp_cus_idt").agg(F.count("*").alias("n_rows"))
    per_customer = per_customer.join(t.clients, F.col("shp_cus_idt") == F.col("cus_idt"))
    raw = S.norm_key(F.col("canal_raw"))
    rows = per_customer.select(F.coalesce(labels.channel_std(raw), raw).alias("channel"), "n_rows")
    allowed = channel_seed(t).select("channel_standard").distinct()
    return checks.values_outside_vocabulary(rows, "channel", allowed, "channel_standard", "n_rows")


@query(
    roles=("items",),
    sql="""SELECT 'A5_one_to_one:sku_ean_cod->mat_idt' AS check_id, 'items' AS table_name, CAST(COUNT(*) AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold,
                  CASE WHEN COUNT(*) > 0 THEN 'BLOCKER' ELSE 'PASS' END AS status
           FROM (SELECT sku_ean_cod FROM items WHERE sku_ean_cod IS NOT NULL GROUP BY sku_ean_cod HAVING COUNT(DISTINCT mat_idt) > 1)""",
)
def check_one_to_one(t: Tables) -> DataFrame:
    return checks.check_one_to_one(t.items, "sku_ean_cod", "mat_idt", "items")


@query(
    roles=("items",),
    sql="""SELECT 'A9_null_accounted:sku_ean_cod' AS check_id, 'items' AS table_name, CAST(COUNT(*) AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold,
                  CASE WHEN COUNT(*) > 0 THEN 'BLOCKER' ELSE 'PASS' END AS status FROM items WHERE sku_ean_cod IS NULL AND NOT is_active""",
)
def check_null_accounted(t: Tables) -> DataFrame:
    """Only the active products without a bar code went to quarantine."""
    held = t.items.filter(F.col("sku_ean_cod").isNull() & F.col("is_active"))
    held = std.quarantine(held, "ITEMS_NO_EAN", "no bar code", "2024-01-01 00:00:00")
    return checks.check_null_accounted(t.items, held, "sku_ean_cod", ["mat_idt"], "items")


# --- reports -----------------------------------------------------------------------------------


@query(
    roles=("sell_in",),
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT({c}) AS mapped_rows, ROUND(COUNT({c}) * 100.0::DOUBLE / COUNT(*), 6) AS coverage_pct, {lim}::DOUBLE AS threshold_pct,
            {"'EXEMPT'" if c == "cbu" else f"CASE WHEN COUNT({c}) * 100.0::DOUBLE / COUNT(*) < {lim} THEN 'WARNING' ELSE 'PASS' END"} AS status FROM sell_in"""
        for c, lim in (("marca_std", 97.2), ("sku_ean_cod", 95.0), ("canal_std", 99.0), ("cbu", 99.0))
    ),
)
def coverage_report(t: Tables) -> DataFrame:
    limits = {"marca_std": 97.2, "sku_ean_cod": 95.0, "canal_std": 99.0, "cbu": 99.0}
    return rounded(checks.coverage_report(t.sell_in, limits, ["cbu"]), 6)


@query(
    roles=("sell_in",),
    sql=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total_rows, COUNT(CASE WHEN {c} IS NULL THEN 1 END) AS null_rows,
            ROUND(COUNT(CASE WHEN {c} IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*), 6) AS null_pct,
            CASE WHEN COUNT(CASE WHEN {c} IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*) > 5 THEN 'HIGH' WHEN COUNT(CASE WHEN {c} IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*) > 1 THEN 'WARN' ELSE 'OK' END AS null_flag FROM sell_in"""
        for c in ("marca_std", "sku_ean_cod", "canal_std", "revenue_mxn")
    ),
)
def null_rate_report(t: Tables) -> DataFrame:
    return rounded(checks.null_rate_report(t.sell_in, ["marca_std", "sku_ean_cod", "canal_std", "revenue_mxn"]), 6)


RULES = [
    Rule("o_orderkey", "mandatory", severity="CRITICAL"),
    Rule("o_orderkey", "unique", severity="CRITICAL"),
    Rule("o_orderstatus", "allowed_values", ["F", "O"], "HIGH"),
    Rule("o_totalprice", "value_range", (1000.0, 400000.0), "MEDIUM"),
    Rule("o_orderpriority", "pattern", r"^[1-5]-[A-Z ]+$", "LOW"),
    Rule("o_custkey", "unique", severity="MEDIUM"),
    Rule("o_clerk", "mandatory", severity="LOW"),
]
RULES_SQL = """
    SELECT 'o_orderkey' AS column_name, 'mandatory' AS rule_type, 'CRITICAL' AS severity, COUNT(*) - COUNT(o_orderkey) AS violations FROM orders
    UNION ALL SELECT 'o_orderkey', 'unique', 'CRITICAL', COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'allowed_values', 'HIGH', COUNT(CASE WHEN o_orderstatus NOT IN ('F','O') THEN 1 END) FROM orders
    UNION ALL SELECT 'o_totalprice', 'value_range', 'MEDIUM', COUNT(CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 1 END) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'pattern', 'LOW', COUNT(CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$') THEN 1 END) FROM orders
    UNION ALL SELECT 'o_custkey', 'unique', 'MEDIUM', COUNT(*) - COUNT(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'o_clerk', 'mandatory', 'LOW', NULL"""


@query(extra={"v": RULES_SQL}, sql="SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM v")
def dq_rules(t: Tables) -> DataFrame:
    return checks.dq_rules(t.orders, RULES)


@query(
    extra={
        "v": RULES_SQL,
        "p": "SELECT CASE WHEN violations = 0 THEN 0 ELSE CASE severity WHEN 'CRITICAL' THEN 15 WHEN 'HIGH' THEN 8 WHEN 'MEDIUM' THEN 3 ELSE 0 END END AS lost, violations FROM v",
    },
    sql="""SELECT COUNT(*) AS n_rules, COUNT(CASE WHEN violations IS NULL OR violations <> 0 THEN 1 END) AS n_failed, CAST(SUM(lost) AS BIGINT) AS points_lost,
                  CAST(GREATEST(0, 100 - SUM(lost)) AS BIGINT) AS dq_score FROM p""",
)
def dq_severity_score(t: Tables) -> DataFrame:
    return checks.dq_severity_score(checks.dq_rules(t.orders, RULES))


PANEL_LIMITS = {"min_brands": 20, "min_distinct_months": 60, "min_rows": 1000, "max_null_brand_pct": 3.0, "min_value": 1.0}


@query(
    roles=("market_rows",),
    sql=checks_sql(
        "panel",
        "market_rows",
        [
            ("min_brands", "COUNT(DISTINCT marca_std)", 20, "below", "BLOCKER"),
            ("min_distinct_months", "COUNT(DISTINCT fecha_month)", 60, "below", "BLOCKER"),
            ("min_rows", "COUNT(*)", 1000, "below", "BLOCKER"),
            ("max_null_brand_pct", "COUNT(CASE WHEN marca_std IS NULL THEN 1 END) * 100.0::DOUBLE / COUNT(*)", 3.0, "above", "BLOCKER"),
            ("min_value", "ROUND(SUM(fact_value), 2)", 1.0, "below", "BLOCKER"),
        ],
    ),
)
def market_panel_thresholds(t: Tables) -> DataFrame:
    out = checks.market_panel_thresholds(t.market_rows, "panel", "marca_std", "fecha_month", "fact_value", PANEL_LIMITS)
    rounded_metric = F.when(F.col("check_id") == "min_value", S.stable_round(F.col("metric"), 2)).otherwise(F.col("metric"))
    return out.withColumn("metric", rounded_metric)


METRICS_SQL = """
    SELECT 'orders' AS name, CAST(COUNT(*) AS DOUBLE) AS value, 'LT' AS comparison, 100.0::DOUBLE AS threshold, CAST(NULL AS VARCHAR) AS override FROM orders
    UNION ALL SELECT 'partial_orders', COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END), 'GT', 10, NULL FROM orders
    UNION ALL SELECT 'negative_balances', COUNT(CASE WHEN c_acctbal < 0 THEN 1 END), 'WARN', 5, NULL FROM customer
    UNION ALL SELECT 'regions', COUNT(*), 'EQ', 0, NULL FROM region
    UNION ALL SELECT 'low_priority', COUNT(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END), 'GT', 1, 'INFO' FROM orders"""


@query(
    extra={"m": METRICS_SQL},
    sql="""SELECT *, COALESCE(override, CASE WHEN (comparison = 'GT' AND value > threshold) OR (comparison = 'EQ' AND value = threshold) OR (comparison = 'LT' AND value < threshold) THEN 'BLOCKER'
                  WHEN comparison = 'WARN' AND value > threshold THEN 'WARNING' ELSE 'PASS' END) AS status FROM m""",
)
def threshold_assertions(t: Tables) -> DataFrame:
    def metric(df: DataFrame, name: str, value, how: str, limit: float, override: str | None = None) -> DataFrame:
        return df.agg(
            F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(how).alias("comparison"),
            F.lit(float(limit)).alias("threshold"), F.lit(override).cast("string").alias("override"),
        )

    rows = [
        metric(t.orders, "orders", F.count("*"), "LT", 100),
        metric(t.orders, "partial_orders", F.count_if(F.col("o_orderstatus") == "P"), "GT", 10),
        metric(t.customer, "negative_balances", F.count_if(F.col("c_acctbal") < 0), "WARN", 5),
        metric(t.region, "regions", F.count("*"), "EQ", 0),
        metric(t.orders, "low_priority", F.count_if(F.col("o_orderpriority") == "5-LOW"), "GT", 1, "INFO"),
    ]
    return checks.threshold_assertions(std.union_by_name_missing(rows))


@query(
    roles=("items", "stores"),
    sql="""SELECT mat_idt, brand, NULL AS store_id, NULL AS chain, 'ITEMS_NO_EAN' AS _quarantine_source, 'no bar code' AS _quarantine_reason FROM items WHERE sku_ean_cod IS NULL
           UNION ALL SELECT NULL, NULL, store_id, chain, 'STORE_CHAIN_REVIEW', 'chain not mapped' FROM stores WHERE chain IN ('NATION_1','NATION_2')""",
)
def quarantine_split(t: Tables) -> DataFrame:
    """Rejected rows of unlike tables in one set. The time column is left out of the comparison."""
    at = "2024-01-01 00:00:00"
    a = std.quarantine(t.items.filter("sku_ean_cod IS NULL").select("mat_idt", "brand"), "ITEMS_NO_EAN", "no bar code", at)
    b = t.stores.filter(F.col("chain").isin("NATION_1", "NATION_2")).select("store_id", "chain")
    b = std.quarantine(b, "STORE_CHAIN_REVIEW", "chain not mapped", at)
    return std.union_by_name_missing([a, b]).drop("_quarantine_ts")


@query(
    roles=("sell_in", "crosswalk"),
    sql="""SELECT COUNT(*) AS left_keys, COUNT(r) AS matched_keys, ROUND((COUNT(*) - COUNT(r)) * 100.0::DOUBLE / COUNT(*), 6) AS unmatched_pct,
                  CASE WHEN (COUNT(*) - COUNT(r)) * 100.0::DOUBLE / COUNT(*) > 20 THEN 'FAIL' ELSE 'PASS' END AS status
           FROM (SELECT DISTINCT marca_std AS k FROM sell_in WHERE marca_std IS NOT NULL) LEFT JOIN (SELECT DISTINCT canonical AS r FROM crosswalk) ON k = r""",
)
def join_key_match(t: Tables) -> DataFrame:
    return rounded(checks.join_key_match(t.sell_in, t.crosswalk, "marca_std", "canonical"), 6)


@query(
    """SELECT CAST(MAX(o_orderdate) AS DATE) AS internal_max_date, md AS market_max_date,
              CAST((CAST(DATE_TRUNC('week', CAST(MAX(o_orderdate) AS DATE)) AS DATE) - CAST(DATE_TRUNC('week', md) AS DATE)) // 7 AS INT) AS lag_weeks,
              (CAST(DATE_TRUNC('week', CAST(MAX(o_orderdate) AS DATE)) AS DATE) - CAST(DATE_TRUNC('week', md) AS DATE)) // 7 > 6 AS lag_banner_required,
              CASE WHEN (CAST(DATE_TRUNC('week', CAST(MAX(o_orderdate) AS DATE)) AS DATE) - CAST(DATE_TRUNC('week', md) AS DATE)) // 7 > 6
                   THEN 'Market data as of ' || STRFTIME(md, '%Y-%m-%d') || ' (' || CAST((CAST(DATE_TRUNC('week', CAST(MAX(o_orderdate) AS DATE)) AS DATE) - CAST(DATE_TRUNC('week', md) AS DATE)) // 7 AS INT) || ' weeks behind internal data)'
                   ELSE 'Market data current' END AS lag_banner_message
       FROM orders, (SELECT MAX(DATE '1997-01-05' + 7 * CAST(event_id % 208 AS INT)) AS md FROM events) GROUP BY md"""
)
def market_data_lag(t: Tables) -> DataFrame:
    return checks.market_data_lag(t.orders, t.periods, "o_orderdate", "period_end_date")


@query(
    roles=("sell_out", "sell_in", "spend"),
    extra={
        "so": "SELECT fecha_month, canal_std, marca_std, SUM(revenue_sell_out) AS r FROM sell_out WHERE marca_std IS NOT NULL GROUP BY ALL",
        "iv": "SELECT DISTINCT fecha_month, canal_std, marca_std FROM spend",
    },
    sql="""SELECT so.canal_std, COUNT(*) AS total_rows, COUNT(iv.marca_std) AS matched_rows, ROUND(COUNT(iv.marca_std) * 100.0::DOUBLE / COUNT(*), 6) AS match_pct
           FROM so LEFT JOIN iv ON so.fecha_month = iv.fecha_month AND so.canal_std = iv.canal_std AND so.marca_std = iv.marca_std GROUP BY so.canal_std""",
)
def spend_match_rate(t: Tables) -> DataFrame:
    """How many sell-out cells find spend on the master keys, per channel."""
    keys = ["fecha_month", "canal_std", "marca_std"]
    cells = t.sell_out.filter(F.col("marca_std").isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))
    found = t.spend.select(*keys).distinct().withColumn("hit", F.lit(1))
    joined = cells.join(found, keys, "left").groupBy("canal_std")
    return rounded(
        joined.agg(
            F.count("*").alias("total_rows"),
            F.count("hit").alias("matched_rows"),
            (F.count("hit") * 100.0 / F.count("*")).alias("match_pct"),
        ),
        6,
    )




def _schema_sql(table: str) -> str:
    """Columns of a given table, named without the table's prefix, with the type names of Spark."""
    return f"""SELECT 'party' AS table_name, SUBSTR(column_name, 3) AS column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS type,
               is_nullable = 'YES' AS nullable FROM information_schema.columns WHERE table_name = '{table}'"""


@query(
    extra={"old": _schema_sql("customer"), "new": _schema_sql("supplier")},
    sql="""SELECT * FROM (SELECT COALESCE(o.table_name, n.table_name) AS table_name, COALESCE(o.column_name, n.column_name) AS column_name, o.type AS old_type, o.nullable AS old_nullable, n.type AS new_type, n.nullable AS new_nullable,
                  CASE WHEN o.type IS NULL THEN 'ADDED' WHEN n.type IS NULL THEN 'DROPPED' WHEN o.type <> n.type THEN 'TYPE_CHANGED' WHEN o.nullable <> n.nullable THEN 'NULLABILITY_CHANGED' END AS change
                  FROM old o FULL JOIN new n ON o.table_name = n.table_name AND o.column_name = n.column_name) WHERE change IS NOT NULL""",
)
def schema_drift(t: Tables) -> DataFrame:
    """The schema of customers against that of suppliers, as if one table had been replaced by the other."""

    def columns(df: DataFrame) -> DataFrame:
        bare = df.toDF(*[c[2:] for c in df.columns])
        return config_frame(t.spark, checks.schema_rows(bare, "party"), "table_name string, column_name string, type string, nullable boolean")

    return checks.schema_drift(columns(t.customer), columns(t.supplier))


@query(
    roles=("sell_out",),
    extra={"k": "SELECT fecha_month, marca_std, canal_std, cadena_std, SUM(revenue_sell_out) AS r, SUM(vol_sell_out) AS v FROM sell_out WHERE marca_std IS NOT NULL GROUP BY ALL"},
    sql=checks_sql(
        "gold_sell_out",
        "k",
        [
            ("B1_not_empty", "COUNT(*)", 1, "below", "BLOCKER"),
            ("B10_unique:fecha_month,marca_std,canal_std,cadena_std", COUNT_IF("FALSE"), 0, "above", "BLOCKER"),
            ("B4_inf_nan:so_avg_price_mxn", COUNT_IF("FALSE"), 0, "above", "BLOCKER"),
            ("W2_negative:so_revenue_mxn", COUNT_IF("r < 0"), 0, "above", "WARNING"),
        ],
    ),
)
def gold_checks(t: Tables) -> DataFrame:
    """Checks of a finished KPI table."""
    gold = kpi.sell_out_kpi(t.sell_out)
    wanted: list[Check] = [
        checks.check_not_empty(),
        checks.check_unique_keys(kpi.MASTER_KEYS),
        checks.check_no_inf_nan("so_avg_price_mxn"),
        checks.check_negative("so_revenue_mxn"),
    ]
    return checks.run_checks(gold, "gold_sell_out", wanted)


@query(
    roles=("sales", "stores", "items", "store_products"),
    extra={
        "bridge": "SELECT sku_ean_cod, MIN(mat_idt) AS mat_idt FROM items WHERE TRIM(sku_ean_cod) <> '' GROUP BY ALL",
        "s": "SELECT 'E' || (CAST(upc AS INT) - CAST(upc AS INT) % 3) AS upc, revenue_sell_out FROM sales",
    },
    sql="""SELECT UPPER(TRIM(p.so_brand)) AS marca_std, COUNT(*) AS n_rows, COUNT(b.mat_idt) AS bridged_rows, ROUND(SUM(s.revenue_sell_out), 2) AS revenue
           FROM s LEFT JOIN bridge b ON s.upc = b.sku_ean_cod LEFT JOIN store_products p ON s.upc = p.int_id GROUP BY ALL""",
)
def store_sales_enriched(t: Tables) -> DataFrame:
    """Store sales with bar-code bridge and store product attributes."""
    number = F.col("upc").cast("int")
    coded = t.sales.select(F.concat(F.lit("E"), (number - number % 3).cast("string")).alias("upc"), "revenue_sell_out")
    per_code = coded.groupBy("upc").agg(F.count("*").alias("n"), F.sum("revenue_sell_out").alias("r"))
    out = kpi.store_sales_enriched(per_code, t.items, t.store_products)
    return rounded(
        out.groupBy("marca_std").agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("mat_idt").isNotNull(), F.col("n"))), F.lit(0)).alias("bridged_rows"),
            F.sum("r").alias("revenue"),
        ),
        2,
    )


