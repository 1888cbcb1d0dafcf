"""Filters, projections, sources and label standardization."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import labels
from cartmetrics.functions import scalars as S
from cartmetrics.operators import checks, std
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.readers import read_source
from cartmetrics.sources.sinks import capped_export
from cartmetrics.sources.roles import Tables

# --- sources -----------------------------------------------------------------------------------


@query(
    "SELECT l_returnflag, COUNT(*) AS n_rows, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag",
    name="read_source",
)
def read_source_columns(t: Tables) -> DataFrame:
    """Only two columns reach the scan."""
    rows = read_source(t.spark, f"{t.folder}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return rounded(rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity")), 2)


@query(
    roles=("shipments",),
    sql="""SELECT COUNT(*) AS total_rows, COUNT(DISTINCT mat_idt) AS distinct_keys, MIN(bill_date) AS min_date,
                  MAX(bill_date) AS max_date FROM shipments""",
)
def row_count_probe(t: Tables) -> DataFrame:
    return checks.row_count_probe(t.shipments, "mat_idt", "bill_date")


@query(
    roles=("shipments",),
    extra={
        "c": "SELECT CAST(DATE_TRUNC('month', bill_date) AS DATE) AS period, COUNT(*) AS n_rows FROM shipments GROUP BY ALL",
        "p": "SELECT *, LAG(n_rows) OVER (ORDER BY period) AS prior_rows FROM c",
        "d": "SELECT *, n_rows * 1.0::DOUBLE / prior_rows AS x FROM p",
    },
    sql="""SELECT period, n_rows, prior_rows, ROUND(x, 4) AS ratio, COALESCE(x < 0.95, FALSE) AS below_minimum,
                  CASE WHEN 1 - x > 0.20 THEN 'ERROR' WHEN 1 - x > 0.10 THEN 'WARNING' ELSE 'PASS' END AS status FROM d""",
)
def prior_period_volume_check(t: Tables) -> DataFrame:
    return rounded(checks.prior_period_volume_check(t.shipments, "bill_date", 0.95))


@query(
    roles=("sell_out",),
    extra={"s": "SELECT upc, SUM(vol_sell_out) AS v, COUNT(*) AS n_rows FROM sell_out GROUP BY upc"},
    sql="SELECT upc, ROUND(v, 2) AS units, n_rows FROM s ORDER BY n_rows DESC, upc LIMIT 100",
)
def top_n_capped_export(t: Tables) -> DataFrame:
    per_product = t.sell_out.groupBy("upc").agg(F.sum("vol_sell_out").alias("units"), F.count("*").alias("n_rows"))
    ranked = per_product.withColumn("_rank", -F.col("n_rows"))
    return rounded(capped_export(ranked, ["_rank", "upc"], 100).drop("_rank"), 2)


@query(
    roles=("sell_out",),
    sql="""SELECT canal_std, cadena_std, COUNT(*) AS n_rows FROM sell_out GROUP BY ALL ORDER BY canal_std, cadena_std""",
)
def ordered_output(t: Tables) -> DataFrame:
    from cartmetrics.operators.sets import ordered_output as ordered

    return ordered(t.sell_out.groupBy("canal_std", "cadena_std").agg(F.count("*").alias("n_rows")), ["canal_std", "cadena_std"])


# --- filters -----------------------------------------------------------------------------------


@query(roles=("media",), sql="SELECT UPPER(TRIM(marca)) AS marca_key, COUNT(*) AS n_rows FROM media GROUP BY ALL")
def norm_key(t: Tables) -> DataFrame:
    return t.media.groupBy(S.norm_key(F.col("marca")).alias("marca_key")).agg(F.count("*").alias("n_rows"))


@query(
    """SELECT l_returnflag, COUNT(*) AS n_rows, ROUND(SUM(l_extendedprice), 2) AS revenue FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY l_returnflag"""
)
def period_filter(t: Tables) -> DataFrame:
    start = F.lit("1999-01-01").cast("timestamp_ntz")
    kept = t.lineitem.filter(F.col("l_shipdate") >= start)
    return rounded(kept.groupBy("l_returnflag").agg(F.count("*").alias("n_rows"), F.sum("l_extendedprice").alias("revenue")), 2)


@query(
    """SELECT o_orderpriority, COUNT(*) AS n_rows FROM orders
       WHERE CAST(STRFTIME(o_orderdate, '%Y%m%d') AS INT) >= 19990101 GROUP BY ALL"""
)
def period_filter_int(t: Tables) -> DataFrame:
    coded = t.orders.withColumn("day_id", F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
    return std.period_filter(coded, "day_id", 19990101).groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"))


@query(roles=("items",), sql="SELECT * FROM items WHERE sku_ean_cod IS NOT NULL AND TRIM(sku_ean_cod) <> ''")
def active_catalog_filter(t: Tables) -> DataFrame:
    return std.active_catalog_filter(t.items, "sku_ean_cod")


@query(
    roles=("sell_in",),
    sql="""SELECT cbu, COUNT(*) AS n_rows, ROUND(SUM(revenue_mxn), 2) AS revenue_mxn FROM sell_in
           WHERE dis_chl_cod NOT IN ('A') AND marca_std NOT IN ('BRAND#3', 'BRAND#7') GROUP BY cbu""",
)
def code_exclusion_filter(t: Tables) -> DataFrame:
    """Rows without a brand go too, as NOT IN is unknown for NULL."""
    kept = std.code_exclusion_filter(t.sell_in, {"dis_chl_cod": ["A"], "marca_std": ["BRAND#3", "BRAND#7"]})
    return rounded(kept.groupBy("cbu").agg(F.count("*").alias("n_rows"), F.sum("revenue_mxn").alias("revenue_mxn")), 2)


@query(
    roles=("waste",),
    sql="""SELECT cadena, COUNT(*) AS n_rows, ROUND(SUM(waste_kg), 2) AS waste_kg FROM waste
           WHERE UPPER(TRIM(fuente)) = 'TOPLINE' GROUP BY cadena""",
)
def source_flag_filter(t: Tables) -> DataFrame:
    kept = std.source_flag_filter(t.waste, "fuente", "TOPLINE")
    return rounded(kept.groupBy("cadena").agg(F.count("*").alias("n_rows"), F.sum("waste_kg").alias("waste_kg")), 2)


@query(
    roles=("market_rows",),
    sql="SELECT fact_column, COUNT(*) AS n_rows FROM market_rows WHERE hierarchy_level = 11 GROUP BY fact_column",
)
def hierarchy_level_filter(t: Tables) -> DataFrame:
    return std.hierarchy_level_filter(t.market_rows, 11).groupBy("fact_column").agg(F.count("*").alias("n_rows"))


PLANNING_SQL = """SELECT CAST(o_orderdate AS DATE) AS fecha, o_totalprice AS valor,
                         CASE o_orderstatus WHEN 'F' THEN ' real' WHEN 'O' THEN 'IBP'
                              ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'ADJ' ELSE 'm3' END END AS etiqueta FROM orders"""
SCENARIO_SQL = """CASE WHEN UPPER(TRIM(etiqueta)) = 'REAL' THEN 'ACTUAL' WHEN UPPER(TRIM(etiqueta)) = 'IBP' THEN 'IBP_FORECAST'
                       WHEN UPPER(TRIM(etiqueta)) LIKE 'M%' THEN 'ROLLING_FORECAST' ELSE 'OTHER' END"""


def planning(t: Tables) -> DataFrame:
    """Orders as planning rows whose tag tells actual, plan and rolling forecast apart."""
    tag = (
        F.when(F.col("o_orderstatus") == "F", " real")
        .when(F.col("o_orderstatus") == "O", "IBP")
        .when(F.col("o_orderpriority") == "5-LOW", "ADJ")
        .otherwise("m3")
    )
    return t.orders.select(
        F.col("o_orderdate").cast("date").alias("fecha"), F.col("o_totalprice").alias("valor"), tag.alias("etiqueta")
    )


@query(
    f"SELECT etiqueta, scenario, COUNT(*) AS n_rows FROM (SELECT etiqueta, {SCENARIO_SQL} AS scenario FROM ({PLANNING_SQL})) GROUP BY ALL"
)
def scenario_label(t: Tables) -> DataFrame:
    rows = planning(t).withColumn("scenario", S.scenario_label(F.col("etiqueta")))
    return rows.groupBy("etiqueta", "scenario").agg(F.count("*").alias("n_rows"))


@query(
    f"""SELECT CAST(DATE_TRUNC('month', fecha) AS DATE) AS fecha_month, scenario, ROUND(SUM(valor), 2) AS valor
        FROM (SELECT fecha, valor, {SCENARIO_SQL} AS scenario FROM ({PLANNING_SQL})) GROUP BY ALL"""
)
def scenario_guard(t: Tables) -> DataFrame:
    rows = planning(t).select(
        S.month_trunc(F.col("fecha")).alias("fecha_month"), S.scenario_label(F.col("etiqueta")).alias("scenario"), "valor"
    )
    return rounded(std.scenario_guard(rows, "scenario", ["fecha_month", "scenario"], ["valor"]), 2)


@query(
    roles=("waste",),
    sql="""SELECT cadena, COUNT(*) AS n_rows, COUNT(CASE WHEN COALESCE(waste_amount, 0) = 0 THEN 1 END) AS zero_rows,
                  ROUND(AVG(COALESCE(waste_amount, 0)), 4) AS mean_waste_amount FROM waste GROUP BY cadena""",
)
def keep_zero_rows(t: Tables) -> DataFrame:
    """Rows without a measure count as zero in the average."""
    rows = std.null_to_zero(t.waste, ["waste_amount"])
    return rounded(
        rows.groupBy("cadena").agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("waste_amount") == 0).alias("zero_rows"),
            F.avg("waste_amount").alias("mean_waste_amount"),
        )
    )


@query(
    roles=("media", "crosswalk"),
    sql="""SELECT UPPER(TRIM(marca)) AS marca_key, COUNT(*) AS n_rows FROM media
           WHERE UPPER(TRIM(marca)) NOT IN (SELECT variant FROM crosswalk WHERE canonical = 'OVERLAP') GROUP BY ALL""",
)
def sentinel_exclusion(t: Tables) -> DataFrame:
    collective = t.crosswalk.filter("canonical = 'OVERLAP'")
    kept = std.sentinel_exclusion(t.media, "marca", collective, "variant")
    return kept.groupBy(S.norm_key(F.col("marca")).alias("marca_key")).agg(F.count("*").alias("n_rows"))


@query(
    roles=("sell_in",),
    sql="""SELECT 'VALID' AS part, COUNT(*) AS n_rows, ROUND(SUM(revenue_mxn), 2) AS revenue_mxn FROM sell_in WHERE marca_std IS NOT NULL
           UNION ALL SELECT 'QUARANTINE', COUNT(*), ROUND(SUM(revenue_mxn), 2) FROM sell_in WHERE marca_std IS NULL""",
)
def valid_brand_filter(t: Tables) -> DataFrame:
    ok, bad = std.valid_brand_filter(t.sell_in, "marca_std")
    total = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n_rows"), F.sum("revenue_mxn").alias("revenue_mxn"))
    return rounded(total(ok, "VALID").unionByName(total(bad, "QUARANTINE")), 2)


@query(
    roles=("media",),
    sql="""SELECT fecha, campana, inversion_real, CAST(NULL AS VARCHAR) AS cadena_std FROM media WHERE investment_source = 'MKT_OFF'""",
)
def structural_null_column(t: Tables) -> DataFrame:
    offline = t.media.filter("investment_source = 'MKT_OFF'")
    return offline.select("fecha", "campana", "inversion_real", S.null_column().alias("cadena_std"))


@query(roles=("waste",), sql="SELECT fecha, sku, COALESCE(waste_amount, 0) AS waste_amount, COALESCE(waste_kg, 0) AS waste_kg FROM waste")
def null_to_zero_measures(t: Tables) -> DataFrame:
    return std.null_to_zero(t.waste, ["waste_amount", "waste_kg"]).select("fecha", "sku", "waste_amount", "waste_kg")


@query(roles=("items",), sql="SELECT mat_idt, brand, sku_ean_cod FROM items")
def select_contract_columns(t: Tables) -> DataFrame:
    return std.select_contract_columns(t.items, ["mat_idt", "brand", "sku_ean_cod"])


@query(
    roles=("stores",),
    sql="""SELECT store_id, chain, region, CAST(NULL AS VARCHAR) AS city, 'STORES' AS source, CAST(NULL AS DATE) AS opened FROM stores""",
)
def align_schema(t: Tables) -> DataFrame:
    schema = {"store_id": "string", "chain": "string", "region": "string", "city": "string", "source": "string", "opened": "date"}
    return std.align_schema(t.stores, schema, {"source": "STORES"})


# --- scalar rules ------------------------------------------------------------------------------


@query(
    """SELECT c_custkey, ROUND(c_acctbal / NULLIF(c_nationkey, 0), 4) AS ratio,
              CASE WHEN c_nationkey = 0 THEN 0.0::DOUBLE ELSE ROUND(c_acctbal / c_nationkey, 4) END AS ratio_or_zero FROM customer"""
)
def safe_divide(t: Tables) -> DataFrame:
    num, den = F.col("c_acctbal"), F.col("c_nationkey")
    return rounded(
        t.customer.select(
            "c_custkey", S.safe_divide(num, den).alias("ratio"), S.safe_divide(num, den, 0.0).alias("ratio_or_zero")
        )
    )


@query("SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS fecha_month, COUNT(*) AS n_rows FROM orders GROUP BY ALL")
def month_trunc(t: Tables) -> DataFrame:
    month = S.month_trunc(F.col("o_orderdate")).alias("fecha_month")
    return t.orders.groupBy(month).agg(F.count("*").alias("n_rows"))


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_date, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month_date FROM orders"""
)
def date_from_int(t: Tables) -> DataFrame:
    """Dates coded as numbers of eight or six digits."""
    coded = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("d"),
        F.date_format("o_orderdate", "yyyyMM").cast("int").alias("m"),
    )
    return coded.select(
        "o_orderkey", S.date_from_int(F.col("d")).alias("day_date"), S.date_from_int(F.col("m")).alias("month_date")
    )


def store_counts(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n_stores"))


COVERAGE_SQL = """SELECT c_mktsegment, n_name, COUNT(*) AS n_stores FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


@query(
    f"""SELECT c_mktsegment, n_name, n_stores,
               CASE WHEN n_stores >= 50 THEN 'HIGH' WHEN n_stores >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS coverage_level
        FROM ({COVERAGE_SQL})"""
)
def coverage_level(t: Tables) -> DataFrame:
    return store_counts(t).withColumn("coverage_level", S.coverage_level(F.col("n_stores")))


@query(
    f"""SELECT c_mktsegment, n_name, n_stores,
               CASE WHEN n_stores / 25.0::DOUBLE < 0.70 THEN 'LOW' WHEN n_stores / 25.0::DOUBLE < 0.85 THEN 'MEDIUM' ELSE 'HIGH' END AS coverage_level
        FROM ({COVERAGE_SQL})"""
)
def coverage_level_ratio(t: Tables) -> DataFrame:
    """Share of twenty-five expected stores per cell that report."""
    return store_counts(t).withColumn("coverage_level", S.coverage_level_ratio(F.col("n_stores") / 25.0))


MONTH_FACTS = {
    "w": "SELECT CAST(DATE_TRUNC('month', fecha) AS DATE) AS fecha_month, ROUND(SUM(waste_kg), 2) AS waste, ROUND(SUM(waste_amount), 2) AS waste_cost FROM waste GROUP BY ALL",
    "i": "SELECT fecha_month, ROUND(SUM(CASE WHEN MONTH(fecha_month) <> 3 THEN volume_liter END), 2) AS sell_in FROM sell_in GROUP BY ALL",
    "o": "SELECT fecha_month, ROUND(SUM(vol_sell_out), 2) AS sell_out, ROUND(SUM(revenue_sell_out), 2) AS revenue FROM sell_out GROUP BY ALL",
    "s": "SELECT fecha_month, ROUND(SUM(inversion_real), 2) AS spend FROM spend GROUP BY ALL",
    "m": """SELECT COALESCE(i.fecha_month, o.fecha_month) AS fecha_month, w.waste, w.waste_cost, CASE WHEN MONTH(o.fecha_month) = 7 THEN 0.0::DOUBLE ELSE i.sell_in END AS sell_in,
                   o.sell_out, o.revenue, s.spend
            FROM i FULL JOIN o ON i.fecha_month = o.fecha_month LEFT JOIN w ON COALESCE(i.fecha_month, o.fecha_month) = w.fecha_month
            LEFT JOIN s ON COALESCE(i.fecha_month, o.fecha_month) = s.fecha_month""",
}
MONTH_ROLES = ("waste", "sell_in", "sell_out", "spend")


def month_facts(t: Tables) -> DataFrame:
    """Waste, sell-in, sell-out and spend per month, with missing and zero sell-in months."""
    month = S.month_trunc(F.col("fecha")).alias("fecha_month")
    r = lambda c, a: S.stable_round(F.sum(c), 2).alias(a)
    w = t.waste.groupBy(month).agg(r("waste_kg", "waste"), r("waste_amount", "waste_cost"))
    i = t.sell_in.groupBy("fecha_month").agg(
        r(F.when(F.month("fecha_month") != 3, F.col("volume_liter")), "sell_in")
    )
    o = t.sell_out.groupBy("fecha_month").agg(r("vol_sell_out", "sell_out"), r("revenue_sell_out", "revenue"))
    s = t.spend.groupBy("fecha_month").agg(r("inversion_real", "spend"))
    out = i.join(o, "fecha_month", "full").join(w, "fecha_month", "left").join(s, "fecha_month", "left")
    zero = (F.month("fecha_month") == 7) & F.col("sell_out").isNotNull()
    return out.withColumn("sell_in", F.when(zero, 0.0).otherwise(F.col("sell_in")))


@query(
    roles=MONTH_ROLES,
    extra=MONTH_FACTS,
    sql="""SELECT fecha_month, ROUND(waste / NULLIF(sell_in, 0), 6) AS waste_rate, COALESCE(waste / NULLIF(sell_in, 0) > 1, FALSE) AS is_anomaly,
                  CASE WHEN sell_in = 0 THEN 'SELL_IN_ZERO' WHEN sell_in IS NULL THEN 'SELL_IN_NULL' WHEN waste IS NULL THEN 'WASTE_NULL'
                       WHEN waste / sell_in > 1 THEN 'WASTE_EXCEEDS_SELL_IN' END AS anomaly_reason FROM m""",
)
def waste_rate(t: Tables) -> DataFrame:
    rule = S.waste_rate(F.col("waste"), F.col("sell_in"))
    return rounded(month_facts(t).select("fecha_month", *[c.alias(n) for n, c in rule.items()]), 6)


@query(
    roles=MONTH_ROLES,
    extra=MONTH_FACTS,
    sql="""SELECT fecha_month, ROUND(sell_out / NULLIF(sell_in, 0), 6) AS ratio, sell_out / NULLIF(sell_in, 0) IS NOT NULL AS is_valid,
                  CASE WHEN COALESCE(sell_in, 0) = 0 THEN 'SELL_IN_ZERO' WHEN sell_out IS NULL THEN 'SELL_OUT_NULL'
                       WHEN sell_out / sell_in > 1.5 THEN 'RATIO_EXCEEDS_1_5'
                       WHEN sell_out / sell_in > 1.0 THEN 'RATIO_ABOVE_1_PRIOR_INVENTORY' END AS flag FROM m""",
)
def sell_out_sell_in_ratio(t: Tables) -> DataFrame:
    rule = S.sell_ratio(F.col("sell_out"), F.col("sell_in"))
    return rounded(month_facts(t).select("fecha_month", *[c.alias(n) for n, c in rule.items()]), 6)


@query(
    roles=MONTH_ROLES,
    extra=MONTH_FACTS,
    sql="""SELECT fecha_month, ROUND((revenue - waste_cost) / NULLIF(spend, 0), 4) AS roi, ROUND(revenue / NULLIF(spend, 0), 4) AS roas_gross,
                  ROUND(waste * 30 / NULLIF(sell_out, 0), 4) AS inventory_days,
                  CASE WHEN COALESCE(spend, 0) = 0 THEN 'UNSPONSORED' WHEN waste_cost > revenue THEN 'CATASTROPHIC_LOSS' ELSE 'OK' END AS roi_flag
           FROM m""",
)
def waste_adjusted_roi(t: Tables) -> DataFrame:
    c = F.col
    return rounded(
        month_facts(t).select(
            "fecha_month",
            S.waste_adjusted_roi(c("revenue"), c("waste_cost"), c("spend")).alias("roi"),
            S.safe_divide(c("revenue"), c("spend")).alias("roas_gross"),
            S.inventory_days(c("waste"), c("sell_out")).alias("inventory_days"),
            S.roi_flag(c("revenue"), c("waste_cost"), c("spend")).alias("roi_flag"),
        )
    )


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal / 10000 < 0.30 THEN 'LOW' WHEN c_acctbal / 10000 < 0.70 THEN 'MEDIUM' ELSE 'HIGH' END AS waste_risk_category FROM customer"""
)
def waste_risk_bucket(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", S.waste_risk_bucket(F.col("c_acctbal") / 10000).alias("waste_risk_category"))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal / 100 - 50 > 0 THEN 'GREEN' WHEN c_acctbal / 100 - 50 >= -5 THEN 'AMBER' ELSE 'RED' END AS trend,
              CASE WHEN c_acctbal / 1000 < 3 THEN 'GREEN' WHEN c_acctbal / 1000 <= 6 THEN 'AMBER' ELSE 'RED' END AS waste_trend FROM customer"""
)
def trend_band(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", S.growth_band(b / 100 - 50).alias("trend"), S.waste_band(b / 1000, 3.0).alias("waste_trend")
    )


@query(
    """SELECT c_custkey, ROUND(POWER(GREATEST(c_acctbal, 0), 1.5) / (POWER(5000.0::DOUBLE, 1.5) + POWER(GREATEST(c_acctbal, 0), 1.5)), 6) AS response FROM customer"""
)
def hill_response(t: Tables) -> DataFrame:
    spend = F.greatest(F.col("c_acctbal"), F.lit(0.0))
    return rounded(t.customer.select("c_custkey", S.hill_response(spend, F.lit(5000.0), F.lit(1.5)).alias("response")), 6)


@query(
    roles=("sell_out",),
    sql="""SELECT fecha_month, ROUND(SUM(vol_inv) * 30 / NULLIF(SUM(vol_sell_out), 0), 4) AS inventory_days FROM sell_out GROUP BY ALL""",
)
def inventory_days(t: Tables) -> DataFrame:
    totals = t.sell_out.groupBy("fecha_month").agg(F.sum("vol_inv").alias("stock"), F.sum("vol_sell_out").alias("sold"))
    return rounded(totals.select("fecha_month", S.inventory_days(F.col("stock"), F.col("sold")).alias("inventory_days")))


@query(
    roles=MONTH_ROLES,
    extra=MONTH_FACTS,
    sql="SELECT fecha_month, ROUND(revenue / NULLIF(spend, 0), 4) AS roas_gross FROM m",
)
def roas_gross(t: Tables) -> DataFrame:
    return rounded(month_facts(t).select("fecha_month", S.safe_divide(F.col("revenue"), F.col("spend")).alias("roas_gross")))


@query(
    roles=MONTH_ROLES,
    extra=MONTH_FACTS,
    sql="""SELECT fecha_month, CASE WHEN sell_in IS NOT NULL AND sell_out IS NOT NULL AND spend IS NOT NULL AND waste IS NOT NULL THEN 'HIGH'
                  WHEN sell_out IS NOT NULL THEN 'MEDIUM' ELSE 'LOW' END AS data_confidence FROM m""",
)
def data_confidence(t: Tables) -> DataFrame:
    """Confidence of a month from the sources that report it."""
    has = [F.col(c).isNotNull() for c in ("sell_in", "sell_out", "spend", "waste")]
    return month_facts(t).select("fecha_month", S.data_confidence(*has).alias("data_confidence"))


@query(
    roles=("sell_in",),
    sql="""SELECT unit, ROUND(SUM(volume), 2) AS volume_raw, ROUND(SUM(CASE UPPER(TRIM(unit)) WHEN 'WATERS' THEN volume * 1 WHEN 'EDP' THEN volume * 1000 END), 2) AS volume_kg,
                  COUNT(CASE WHEN UPPER(TRIM(unit)) NOT IN ('WATERS','EDP') THEN 1 END) AS unknown_unit_rows
           FROM (SELECT CASE WHEN dis_chl_cod = 'A' THEN 'OTHER' WHEN dis_chl_cod = 'N' THEN LOWER(cbu) ELSE cbu END AS unit, volume_liter AS volume FROM sell_in)
           GROUP BY unit""",
)
def volume_to_kg(t: Tables) -> DataFrame:
    unit = F.when(F.col("dis_chl_cod") == "A", "OTHER").when(F.col("dis_chl_cod") == "N", F.lower("cbu")).otherwise(F.col("cbu"))
    rows = t.sell_in.select(unit.alias("unit"), F.col("volume_liter").alias("volume"))
    rows = rows.withColumn("kg", S.volume_to_kg(F.col("unit"), F.col("volume")))
    lost = checks.homologation_validate("kg", "volume").metric
    return rounded(
        rows.groupBy("unit").agg(F.sum("volume").alias("volume_raw"), F.sum("kg").alias("volume_kg"), lost.alias("unknown_unit_rows")),
        2,
    )


@query(
    roles=("shipments", "items"),
    sql="""SELECT i.cbu, ROUND(SUM(s.sku_qty * CASE WHEN i.cbu = 'WATERS' THEN i.size ELSE i.size / 10.0::DOUBLE END), 2) AS volume
           FROM shipments s JOIN items i ON s.mat_idt = i.mat_idt GROUP BY i.cbu""",
)
def volume_by_unit_factor(t: Tables) -> DataFrame:
    """Pieces times litres or kilograms per piece, by business unit."""
    per_product = t.shipments.groupBy("mat_idt").agg(F.sum("sku_qty").alias("pieces"))
    joined = per_product.join(t.items.select("mat_idt", "cbu", "size"), "mat_idt")
    volume = S.volume_by_unit_factor(F.col("cbu"), F.col("pieces"), F.col("size"))
    return rounded(joined.groupBy("cbu").agg(F.sum(volume).alias("volume")), 2)


@query(
    roles=("stores",),
    sql="""SELECT store_id, CASE WHEN UPPER(TRIM(chain)) = 'NATION_3' THEN format ELSE chain END AS cadena_std FROM stores""",
)
def chain_or_format(t: Tables) -> DataFrame:
    return t.stores.select("store_id", S.chain_or_format(F.col("chain"), F.col("format"), "nation_3").alias("cadena_std"))


@query(
    roles=("spend",),
    sql=f"""SELECT marca_std, CASE WHEN marca_std IN ({', '.join(f"'BRAND#{i}'" for i in range(1, 13))}) THEN 'OWN' ELSE 'COMPETITOR' END AS brand_owner_type,
                   COUNT(*) AS n_rows FROM spend GROUP BY ALL""",
)
def brand_owner_type(t: Tables) -> DataFrame:
    from cartmetrics.sources.roles import OWN_BRANDS

    owner = S.owner_type(F.col("marca_std"), OWN_BRANDS).alias("brand_owner_type")
    return t.spend.groupBy("marca_std", owner).agg(F.count("*").alias("n_rows"))


@query(
    """SELECT p_partkey, SUBSTR(MD5(p_brand || '|' || p_type || '|' || CASE WHEN p_size > 40 THEN 'None' ELSE CAST(p_size AS VARCHAR) END), 1, 16) AS product_key FROM part"""
)
def surrogate_key(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") <= 40, F.col("p_size"))
    return t.part.select("p_partkey", S.surrogate_key(F.col("p_brand"), F.col("p_type"), size).alias("product_key"))


@query(
    """SELECT o_orderkey, CAST((CAST(DATE_TRUNC('week', d2) AS DATE) - CAST(DATE_TRUNC('week', d1) AS DATE)) // 7 AS INT) AS lag_weeks,
              ROUND((d2 - d1) / 7.0::DOUBLE, 4) AS lag_days_7
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 AS INT) AS d2 FROM orders)"""
)
def boundary_weeks(t: Tables) -> DataFrame:
    """Calendar weeks between two dates count Mondays; days over seven do not."""
    day = F.col("o_orderdate").cast("date")
    rows = t.orders.select("o_orderkey", day.alias("d1"), F.date_add(day, (F.col("o_custkey") % 40).cast("int")).alias("d2"))
    return rounded(
        rows.select(
            "o_orderkey",
            S.boundary_weeks(F.col("d2"), F.col("d1")).alias("lag_weeks"),
            (F.datediff("d2", "d1") / 7.0).alias("lag_days_7"),
        )
    )


@query(
    """SELECT doc_id, pos AS index, chunk AS value FROM (
         SELECT doc_id, CAST(UNNEST(RANGE(LEN(parts))) AS INT) AS pos, UNNEST(parts) AS chunk
         FROM (SELECT doc_id, STRING_SPLIT(REPLACE(REPLACE(text, CHR(13), ''), CHR(10), ''), ',') AS parts FROM documents))"""
)
def split_list(t: Tables) -> DataFrame:
    """A separated text becomes rows; line breaks inside are dropped."""
    return std.split_list(t.documents, "text", "value").select("doc_id", "index", "value")


@query(
    """SELECT brand, STRING_AGG(DISTINCT p_type, ',' ORDER BY p_type) AS types, COUNT(*) AS n_rows,
              COUNT(TRY_CAST(code AS BIGINT)) AS numeric_codes, COUNT(CASE WHEN p_name LIKE '%ring%' THEN 1 END) AS ring_rows
       FROM (SELECT LEFT(p_brand, 7) AS brand, p_type, p_name, SPLIT_PART(p_brand, '#', 2) || CASE WHEN p_size > 25 THEN 'x' ELSE '' END AS code FROM part)
       GROUP BY brand"""
)
def text_functions(t: Tables) -> DataFrame:
    """Prefix, pattern, safe cast and sorted distinct list of a closed vocabulary."""
    suffix = F.when(F.col("p_size") > 25, "x").otherwise("")
    code = F.concat(F.split_part("p_brand", F.lit("#"), F.lit(2)), suffix)
    return t.part.groupBy(F.left("p_brand", F.lit(7)).alias("brand")).agg(
        F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"),
        F.count("*").alias("n_rows"),
        F.count(code.try_cast("long")).alias("numeric_codes"),
        F.count_if(F.col("p_name").like("%ring%")).alias("ring_rows"),
    )


# --- labels ------------------------------------------------------------------------------------


@query(
    roles=("media", "crosswalk"),
    extra={"best": "SELECT variant, ARG_MIN(canonical, priority) AS canonical FROM crosswalk GROUP BY variant"},
    sql="""SELECT marca, COALESCE(b.canonical, UPPER(TRIM(marca))) AS marca_std, COUNT(*) AS n_rows
           FROM media LEFT JOIN best b ON UPPER(TRIM(marca)) = b.variant GROUP BY ALL""",
)
def brand_std(t: Tables) -> DataFrame:
    return std.brand_std(t.media, "marca", t.crosswalk).groupBy("marca", "marca_std").agg(F.count("*").alias("n_rows"))


CHANNEL_CASE = """CASE WHEN c IN ('MODERNO','NC MODERNO','UTT') THEN 'MODERNO' WHEN c IN ('TRADICIONAL','DTT') THEN 'TRADICIONAL'
                       WHEN c IN ('INTERNOS','INTERNAL') THEN 'INTERNOS' END"""


@query(
    roles=("shipments", "clients"),
    extra={
        "r": "SELECT canal_raw, UPPER(TRIM(canal_raw)) AS c, revenue_mxn FROM shipments JOIN clients ON shp_cus_idt = cus_idt",
        "s": f"SELECT canal_raw, {CHANNEL_CASE} AS channel_standard, revenue_mxn FROM r",
    },
    sql="""SELECT canal_raw, channel_standard,
                  CASE channel_standard WHEN 'MODERNO' THEN 'UTT' WHEN 'TRADICIONAL' THEN 'DTT' WHEN 'INTERNOS' THEN 'INTERNAL' END AS gran_canal_grp,
                  CASE WHEN channel_standard = 'INTERNOS' THEN 'INTERNAL_OPERATION' WHEN channel_standard IS NOT NULL THEN 'COMMERCIAL' END AS business_route,
                  COUNT(*) AS n_rows, ROUND(SUM(revenue_mxn), 2) AS revenue_mxn FROM s GROUP BY ALL""",
)
def channel_std(t: Tables) -> DataFrame:
    """Channel, group and business route of shipments."""
    rows = t.shipments.groupBy("shp_cus_idt").agg(F.count("*").alias("n"), F.sum("revenue_mxn").alias("revenue"))
    rows = rows.join(t.clients, F.col("shp_cus_idt") == F.col("cus_idt"))
    out = std.channel_columns(rows, "canal_raw")
    return rounded(
        out.groupBy("canal_raw", "channel_standard", "gran_canal_grp", "business_route").agg(
            F.sum("n").alias("n_rows"), F.sum("revenue").alias("revenue_mxn")
        ),
        2,
    )


SEED_SQL = """
    SELECT DISTINCT CASE WHEN c_nationkey % 2 = 0 THEN 'SELL_OUT' ELSE 'WASTE' END AS source_system, 'FORMAT' AS source_column,
           LOWER(c_mktsegment) AS source_value,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'UTT' WHEN 'BUILDING' THEN 'DTT' WHEN 'MACHINERY' THEN 'INTERNAL' WHEN 'FURNITURE' THEN 'UTT' ELSE 'ELSE' END AS gran_canal_grp,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MODERNO' WHEN 'BUILDING' THEN 'TRADICIONAL' WHEN 'MACHINERY' THEN 'INTERNOS' ELSE 'MODERNO' END AS channel_standard,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Chain ' || c_mktsegment END AS chain_standard,
           c_mktsegment AS format_standard,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'INTERNAL_OPERATION' ELSE 'COMMERCIAL' END AS business_route,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN 'PENDING' ELSE 'CONFIRMED' END AS mapping_status,
           CAST(NULL AS VARCHAR) AS notes
    FROM customer"""


def channel_seed(t: Tables) -> DataFrame:
    """Channel seed derived from the customer table, with unconfirmed and out-of-list rows."""
    m = F.col("c_mktsegment")
    pairs = lambda d, o: F.coalesce(S.lookup(m, d), F.lit(o))
    return t.customer.select(
        F.when(F.col("c_nationkey") % 2 == 0, "SELL_OUT").otherwise("WASTE").alias("source_system"),
        F.lit("FORMAT").alias("source_column"),
        F.lower(m).alias("source_value"),
        pairs({"AUTOMOBILE": "UTT", "BUILDING": "DTT", "MACHINERY": "INTERNAL", "FURNITURE": "UTT"}, "ELSE").alias("gran_canal_grp"),
        pairs({"BUILDING": "TRADICIONAL", "MACHINERY": "INTERNOS"}, "MODERNO").alias("channel_standard"),
        F.when(m != "BUILDING", F.concat(F.lit("Chain "), m)).alias("chain_standard"),
        m.alias("format_standard"),
        F.when(m == "MACHINERY", "INTERNAL_OPERATION").otherwise("COMMERCIAL").alias("business_route"),
        F.when(m == "FURNITURE", "PENDING").otherwise("CONFIRMED").alias("mapping_status"),
        S.null_column().alias("notes"),
    ).distinct()


@query(
    roles=("stores",),
    extra={"seed": SEED_SQL},
    sql="""SELECT t.format, UPPER(s.gran_canal_grp) AS gran_canal_grp, UPPER(s.channel_standard) AS channel_standard, UPPER(s.chain_standard) AS chain_standard,
                  UPPER(s.format_standard) AS format_standard, COUNT(*) AS n_stores
           FROM stores t LEFT JOIN seed s ON t.format = UPPER(s.source_value) AND s.source_system = 'SELL_OUT' AND s.mapping_status = 'CONFIRMED'
           GROUP BY ALL""",
)
def channel_hierarchy_apply(t: Tables) -> DataFrame:
    out = std.channel_hierarchy_apply(t.stores, channel_seed(t), "SELL_OUT", "format")
    keys = ["format", "gran_canal_grp", "channel_standard", "chain_standard", "format_standard"]
    return out.groupBy(*keys).agg(F.count("*").alias("n_stores"))


def _case(col: str, rules, otherwise: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{label}'" for p, label in rules)
    return f"CASE {whens} ELSE {otherwise} END"


# The dots that touch no digit are found without look-around: dots next to digits are hidden first.
CLEAN_SQL = r"""
    UPPER(TRIM(regexp_replace(REPLACE(REPLACE(
        regexp_replace(regexp_replace(REPLACE(regexp_replace(mrkt_dsc_shrt, '_MT\s*$', ''), '_', ' '), '([0-9])\.', '\1~', 'g'), '\.([0-9])', '~\1', 'g'),
        '.', ''), '~', '.'), '\s+', ' ', 'g')))"""
MARKET_EXTRA = {
    "cleaned": f"SELECT market_id, mrkt_dsc_shrt, {CLEAN_SQL} AS market_label FROM markets",
    "lvl": f"SELECT *, CASE WHEN regexp_matches(market_label, '{labels.TOTAL_LEVEL}') THEN 'TOTAL' ELSE 'DETAIL' END AS agg_level, "
    f"{_case('market_label', labels.REGION_TYPE, chr(39) + 'CITY' + chr(39))} AS region_type FROM cleaned",
    "classified": f"""
        SELECT market_id, mrkt_dsc_shrt, market_label, agg_level, region_type,
               {_case('market_label', labels.BROAD_CHANNEL, "CASE WHEN agg_level = 'TOTAL' THEN 'TOTAL_MERCADO' ELSE 'SIN_CLASIFICAR' END")} AS canal_lvl1,
               {_case('market_label', labels.FINE_CHANNEL, "CASE WHEN agg_level = 'TOTAL' THEN 'TOTAL_MERCADO' ELSE 'SIN_CLASIFICAR' END")} AS canal_lvl2,
               CASE WHEN region_type = 'NATIONAL' THEN 'TOTAL_MEXICO' ELSE
               {_case('market_label', labels.AREA, f"CASE WHEN region_type = 'VDM' THEN 'VDM' ELSE TRIM(regexp_replace(market_label, '{labels.CITY_PREFIX}', '')) END")} END AS region_std,
               {_case('market_label', labels.REGION_DETAIL, 'NULL')} AS region_detail
        FROM lvl""",
}
CLASSIFIED = ["market_id", "mrkt_dsc_shrt", "market_label", "agg_level", "region_type", "canal_lvl1", "canal_lvl2", "region_std", "region_detail"]


def classified_markets(t: Tables) -> DataFrame:
    return std.market_label_columns(t.markets.select("market_id", "mrkt_dsc_shrt"), "mrkt_dsc_shrt")


@query(
    roles=("markets",),
    extra=MARKET_EXTRA,
    sql="SELECT *, CASE WHEN canal_lvl2 = 'SIN_CLASIFICAR' THEN 'NEEDS_REVIEW' ELSE 'CONFIRMED' END AS review_status FROM classified",
)
def market_label_classify(t: Tables) -> DataFrame:
    return classified_markets(t)


MARKET_CHANNEL_CASE = reduce(lambda a, kv: f"{a} WHEN '{kv[0]}' THEN '{kv[1]}'", labels.MARKET_TO_CHANNEL.items(), "CASE canal_lvl2") + " END"


@query(
    roles=("markets",),
    extra=MARKET_EXTRA,
    sql=f"""SELECT canal_lvl2, {MARKET_CHANNEL_CASE} AS channel_standard,
                   CASE WHEN canal_lvl2 LIKE '%SCANNING%' THEN 'YES' ELSE 'NO' END AS is_scanning,
                   CASE WHEN region_std = 'TOTAL_MEXICO' THEN 'YES' ELSE 'NO' END AS is_total_mexico, COUNT(*) AS n_markets
            FROM classified GROUP BY ALL""",
)
def market_channel_std(t: Tables) -> DataFrame:
    rows = classified_markets(t)
    return rows.groupBy(
        "canal_lvl2",
        labels.market_channel_std(F.col("canal_lvl2")).alias("channel_standard"),
        labels.is_scanning(F.col("canal_lvl2")).alias("is_scanning"),
        labels.is_total_mexico(F.col("region_std")).alias("is_total_mexico"),
    ).agg(F.count("*").alias("n_markets"))


@query(
    roles=("markets",),
    extra=MARKET_EXTRA,
    sql="SELECT canal_lvl2, CASE WHEN canal_lvl2 LIKE '%SCANNING%' THEN 'YES' ELSE 'NO' END AS is_scanning, COUNT(*) AS n_markets FROM classified GROUP BY ALL",
)
def is_scanning(t: Tables) -> DataFrame:
    flag = labels.is_scanning(F.col("canal_lvl2")).alias("is_scanning")
    return classified_markets(t).groupBy("canal_lvl2", flag).agg(F.count("*").alias("n_markets"))


@query(
    roles=("markets",),
    extra=MARKET_EXTRA,
    sql="SELECT region_std, CASE WHEN region_std = 'TOTAL_MEXICO' THEN 'YES' ELSE 'NO' END AS is_total_mexico, COUNT(*) AS n_markets FROM classified GROUP BY ALL",
)
def is_total_mexico(t: Tables) -> DataFrame:
    flag = labels.is_total_mexico(F.col("region_std")).alias("is_total_mexico")
    return classified_markets(t).groupBy("region_std", flag).agg(F.count("*").alias("n_markets"))


@query(
    roles=("waste",),
    extra={"c": f"SELECT canal, {CHANNEL_CASE.replace(' c IN', ' UPPER(TRIM(canal)) IN')} AS ch FROM waste"},
    sql="""SELECT canal, CASE WHEN ch = 'INTERNOS' THEN 'INTERNAL_OPERATION' WHEN ch IS NOT NULL THEN 'COMMERCIAL' END AS business_route, COUNT(*) AS n_rows FROM c GROUP BY ALL""",
)
def business_route(t: Tables) -> DataFrame:
    route = labels.business_route(labels.channel_std(F.col("canal"))).alias("business_route")
    return t.waste.groupBy("canal", route).agg(F.count("*").alias("n_rows"))


@query(
    """SELECT segment, presentation, COUNT(*) AS n_products FROM (
         SELECT *, CASE WHEN segment = 'NATURAL' AND p_size IN (1, 2, 3) THEN 'SMALL NATURAL' WHEN segment = 'FLAVOURED' THEN 'ANY FLAVOURED'
                        WHEN p_type = 'PROMO' THEN 'PROMO PACK' ELSE segment END AS presentation
         FROM (SELECT p_type, p_size, CASE WHEN p_type IN ('ECONOMY','STANDARD') THEN 'NATURAL' WHEN p_type IN ('STANDARD','LARGE') THEN 'MINERAL'
                                           WHEN p_type = 'SMALL' THEN 'FLAVOURED' ELSE 'OTHER' END AS segment FROM part)) GROUP BY ALL"""
)
def market_segment_chain(t: Tables) -> DataFrame:
    """Layer on layer: the second rule list reads the label of the first; the first match wins."""
    part = t.part.withColumn("size_text", F.col("p_size").cast("string"))
    first = [
        ({"p_type": ["ECONOMY", "STANDARD"]}, "NATURAL"),
        ({"p_type": ["STANDARD", "LARGE"]}, "MINERAL"),
        ({"p_type": ["SMALL"]}, "FLAVOURED"),
    ]
    second = [
        ({"segment": ["NATURAL"], "size_text": ["1", "2", "3"]}, "SMALL NATURAL"),
        ({"segment": ["FLAVOURED"]}, "ANY FLAVOURED"),
        ({"p_type": ["PROMO"]}, "PROMO PACK"),
    ]
    out = std.ordered_case(part, first, "segment", F.lit("OTHER"))
    out = std.ordered_case(out, second, "presentation", F.col("segment"))
    return out.groupBy("segment", "presentation").agg(F.count("*").alias("n_products"))


def dairy_rules() -> list:
    return [
        ({"brand_key": ["BRAND#1", "BRAND#2"], "p_type": ["ECONOMY"]}, "BASE"),
        ({"brand_key": ["BRAND#1"], "name_first": ["RED", "BLUE"]}, "FRUIT"),
        ({"name_second": ["RING", "BOLT"], "p_type": ["LARGE", "PROMO"]}, "FAMILY"),
        ("p_brand <> 'Brand#3' AND p_type = 'LARGE' OR p_brand LIKE 'Brand#2%' AND p_size BETWEEN 40 AND 45", "LARGE PACK"),
        ("(p_brand IS NULL OR p_name NOT LIKE '%o%') AND NOT p_size < 10", F.col("p_type")),
        ({"p_type": ["SMALL", "MEDIUM"]}, "DRINK"),
    ]


@query(
    """SELECT segment, COUNT(*) AS n_products, ROUND(SUM(p_retailprice), 2) AS retail FROM (
         SELECT p_retailprice, CASE WHEN UPPER(p_brand) IN ('BRAND#1','BRAND#2') AND p_type = 'ECONOMY' THEN 'BASE'
             WHEN UPPER(p_brand) = 'BRAND#1' AND SPLIT_PART(p_name, ' ', 1) IN ('red','blue') THEN 'FRUIT'
             WHEN SPLIT_PART(p_name, ' ', 2) IN ('ring','bolt') AND p_type IN ('LARGE','PROMO') THEN 'FAMILY'
             WHEN (p_brand <> 'Brand#3' AND p_type = 'LARGE') OR (STARTS_WITH(p_brand, 'Brand#2') AND p_size >= 40 AND p_size <= 45) THEN 'LARGE PACK'
             WHEN (p_brand IS NULL OR NOT CONTAINS(p_name, 'o')) AND p_size >= 10 THEN p_type
             WHEN p_type IN ('SMALL','MEDIUM') THEN 'DRINK' ELSE 'UNSEGMENTED' END AS segment FROM part) GROUP BY segment"""
)
def dairy_segment_2025(t: Tables) -> DataFrame:
    """A long ordered rule list over maker, brand, size and flavour is configuration."""
    part = t.part.withColumns(
        {
            "brand_key": F.col("p_brand"),
            "name_first": F.split_part("p_name", F.lit(" "), F.lit(1)),
            "name_second": F.split_part("p_name", F.lit(" "), F.lit(2)),
        }
    )
    out = std.ordered_case(part, dairy_rules(), "segment", F.lit("UNSEGMENTED"))
    return rounded(out.groupBy("segment").agg(F.count("*").alias("n_products"), F.sum("p_retailprice").alias("retail")), 2)


WASTE_STD_SQL = f"""
    SELECT fecha, sku, UPPER(TRIM(cadena)) AS cadena_raw, UPPER(TRIM(formato)) AS formato_raw, c AS canal_raw, UPPER(TRIM(fuente)) AS fuente,
           COALESCE(waste_amount, 0) AS waste_amount, COALESCE(waste_kg, 0) AS waste_kg, {CHANNEL_CASE} AS channel_standard, 'WASTE' AS source_system
    FROM (SELECT *, UPPER(TRIM(canal)) AS c FROM waste) WHERE UPPER(TRIM(fuente)) = 'TOPLINE'"""
WASTE_GROUPS = """CASE channel_standard WHEN 'MODERNO' THEN 'UTT' WHEN 'TRADICIONAL' THEN 'DTT' WHEN 'INTERNOS' THEN 'INTERNAL' END AS gran_canal_grp,
                  CASE WHEN channel_standard = 'INTERNOS' THEN 'INTERNAL_OPERATION' WHEN channel_standard IS NOT NULL THEN 'COMMERCIAL' END AS business_route"""
WASTE_COLUMNS = ["fecha", "sku", "cadena_raw", "formato_raw", "canal_raw", "fuente", "waste_amount", "waste_kg", "channel_standard", "gran_canal_grp", "business_route"]


@query(
    roles=("waste",),
    extra={"w": WASTE_STD_SQL},
    sql=f"SELECT fecha, sku, cadena_raw, formato_raw, canal_raw, fuente, waste_amount, waste_kg, channel_standard, {WASTE_GROUPS} FROM w",
)
def waste_std(t: Tables) -> DataFrame:
    return std.waste_std(t.waste).select(*WASTE_COLUMNS)


WASTE_SEED_SQL = """
    SELECT DISTINCT 'WASTE' AS source_system, 'CANAL' AS source_column, canal AS source_value,
           CASE WHEN c IN ('MODERNO','NC MODERNO') THEN 'UTT' WHEN c = 'DTT' THEN 'DTT' ELSE 'INTERNAL' END AS gran_canal_grp,
           CASE WHEN c IN ('MODERNO','NC MODERNO') THEN 'MODERNO' WHEN c = 'DTT' THEN 'TRADICIONAL' ELSE 'INTERNOS' END AS channel_standard,
           CAST(NULL AS VARCHAR) AS chain_standard, CAST(NULL AS VARCHAR) AS format_standard,
           CASE WHEN c = 'INTERNAL' THEN 'INTERNAL_OPERATION' ELSE 'COMMERCIAL' END AS business_route,
           CASE WHEN c = 'NC MODERNO' THEN 'PENDING' ELSE 'CONFIRMED' END AS mapping_status, 'from waste' AS notes
    FROM (SELECT canal, UPPER(TRIM(canal)) AS c FROM waste) WHERE c <> 'OTHER'"""


def waste_seed(t: Tables) -> DataFrame:
    """Channel seed rows for the channels that waste rows use."""
    c = S.norm_key(F.col("canal"))
    modern = c.isin("MODERNO", "NC MODERNO")
    return t.waste.filter(c != "OTHER").select(
        F.lit("WASTE").alias("source_system"),
        F.lit("CANAL").alias("source_column"),
        F.col("canal").alias("source_value"),
        F.when(modern, "UTT").when(c == "DTT", "DTT").otherwise("INTERNAL").alias("gran_canal_grp"),
        F.when(modern, "MODERNO").when(c == "DTT", "TRADICIONAL").otherwise("INTERNOS").alias("channel_standard"),
        S.null_column().alias("chain_standard"),
        S.null_column().alias("format_standard"),
        F.when(c == "INTERNAL", "INTERNAL_OPERATION").otherwise("COMMERCIAL").alias("business_route"),
        F.when(c == "NC MODERNO", "PENDING").otherwise("CONFIRMED").alias("mapping_status"),
        F.lit("from waste").alias("notes"),
    ).distinct()


DIM_CHANNEL_SQL = """
    SELECT SUBSTR(MD5(CONCAT_WS('|', source_system, source_column, source_value, gran_canal_grp, channel_standard,
                  COALESCE(chain_standard, 'None'), COALESCE(format_standard, 'None'))), 1, 16) AS channel_key,
           source_system, source_column, source_value, gran_canal_grp, channel_standard, chain_standard, format_standard, business_route, notes
    FROM (SELECT source_system, source_column, UPPER(TRIM(source_value)) AS source_value, gran_canal_grp, channel_standard, UPPER(TRIM(chain_standard)) AS chain_standard,
                 UPPER(TRIM(format_standard)) AS format_standard, business_route, mapping_status, notes FROM {0})
    WHERE mapping_status = 'CONFIRMED' AND gran_canal_grp IN ('UTT','DTT','INTERNAL') AND channel_standard IN ('MODERNO','TRADICIONAL','INTERNOS')"""


@query(extra={"seed": SEED_SQL}, sql=DIM_CHANNEL_SQL.format("seed"))
def dim_channel(t: Tables) -> DataFrame:
    return std.dim_channel(channel_seed(t))


@query(
    roles=("waste",),
    extra={"w": WASTE_STD_SQL, "seed": WASTE_SEED_SQL, "dim": DIM_CHANNEL_SQL.format("seed"), "f": f"SELECT *, {WASTE_GROUPS} FROM w"},
    sql="""SELECT dim.channel_key, f.canal_raw, f.gran_canal_grp, f.channel_standard, f.business_route, COUNT(*) AS n_rows,
                  ROUND(SUM(f.waste_amount), 2) AS waste_amount, ROUND(SUM(f.waste_kg), 2) AS waste_kg
           FROM f LEFT JOIN dim ON f.source_system = dim.source_system AND f.canal_raw = dim.source_value AND f.gran_canal_grp = dim.gran_canal_grp
                AND f.channel_standard = dim.channel_standard AND f.business_route = dim.business_route GROUP BY ALL""",
)
def fact_waste(t: Tables) -> DataFrame:
    fact = std.fact_waste(std.waste_std(t.waste), std.dim_channel(waste_seed(t)))
    return rounded(
        fact.groupBy("channel_key", "canal_raw", "gran_canal_grp", "channel_standard", "business_route").agg(
            F.count("*").alias("n_rows"), F.sum("waste_amount").alias("waste_amount"), F.sum("waste_kg").alias("waste_kg")
        ),
        2,
    )


@query(
    roles=("market_rows",),
    sql="""SELECT fecha_month, maker, COUNT(*) AS n_rows, ROUND(SUM(fact_value), 2) AS fact_value FROM (
             SELECT fecha_month, marca_std AS maker, fact_value FROM market_rows WHERE hierarchy_level = 11
             UNION ALL SELECT fecha_month, 'MARCAS GENERICAS', fact_value FROM market_rows WHERE hierarchy_level = 9 AND marca_std = 'BRAND#1') GROUP BY ALL""",
)
def controlled_label_branch(t: Tables) -> DataFrame:
    rows = t.market_rows.withColumn("maker", F.col("marca_std"))
    out = std.controlled_label_branch(rows, 11, 9, F.col("marca_std") == "BRAND#1", {"maker": "MARCAS GENERICAS"})
    return rounded(out.groupBy("fecha_month", "maker").agg(F.count("*").alias("n_rows"), F.sum("fact_value").alias("fact_value")), 2)
