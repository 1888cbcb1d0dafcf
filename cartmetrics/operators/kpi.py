"""KPI tables: month x dimension aggregates of the standardized sources.

Sums combine on the map side, so a hot brand or month costs no more shuffle than any other. Exact
distinct counts go through one distinct pre-aggregation on (key, counted column), which spreads a
hot key over its counted values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions.labels import channel_std
from cartmetrics.functions.scalars import (
    coverage_level,
    data_confidence,
    inventory_days,
    month_trunc,
    null_column,
    owner_type,
    safe_divide,
    zero_if_null,
)
from cartmetrics.operators.joins import first_row_dedup, min_per_key, mapping_left_join
from cartmetrics.operators.std import sum_by, valid_brand_filter

# --- standardized sources ----------------------------------------------------------------------


def sell_in_std(fact: DataFrame, items: DataFrame, dictionary: DataFrame, clients: DataFrame) -> DataFrame:
    """Shipments by product, customer group and month.

    fact: mat_idt, shp_cus_idt, cbu, dis_chl_cod, bill_date and five measures. Rows are added up by
    product, customer and month before any lookup, so the joins see far fewer rows than the fact.
    """
    measures = ["revenue_mxn", "volume_kgr", "volume_liter", "cases", "sku_qty"]
    fact = fact.withColumn("year_month", F.date_format("bill_date", "yyyyMM"))
    base = sum_by(fact, ["mat_idt", "shp_cus_idt", "cbu", "dis_chl_cod", "year_month"], {m: m for m in measures})
    active = items.filter(F.col("sku_ean_cod").isNotNull())
    item = first_row_dedup(
        active.select(
            F.col("mat_idt").alias("_mat"), "sku_ean_cod", "mat_lcl_dsc",
            F.upper(F.trim("brand")).alias("marca_std"), F.col("cbu").alias("_cbu"),
        ),
        ["_mat"],
    )
    hop = dictionary.groupBy(F.col("old_cus_idt").alias("_old")).agg(F.min("new_cus_idt").alias("_new"))
    client = first_row_dedup(clients.select(F.col("cus_idt").alias("_cus"), "canal_raw", "cus_grp_dsc"), ["_cus"])
    out = base.join(item, base["mat_idt"] == item["_mat"], "left")
    out = out.join(hop, out["shp_cus_idt"] == hop["_old"], "left")
    out = out.withColumn("_harmonized", F.coalesce("_new", "shp_cus_idt"))
    out = out.join(client, out["_harmonized"] == client["_cus"], "left")
    keys = [
        "mat_idt", "sku_ean_cod", "mat_lcl_dsc", "marca_std", "cbu", "canal_raw", "cus_grp_dsc",
        "dis_chl_cod", "year_month",
    ]
    out = out.withColumn("cbu", F.coalesce("cbu", "_cbu"))
    rows = out.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in measures], F.sum("fact_row_count").alias("fact_row_count")
    )
    return rows.withColumns(
        {
            "cadena_std": null_column(),
            "canal_std": channel_std(F.col("canal_raw")),
            "source_system": F.lit("SELL_IN"),
        }
    )


def sell_out_std(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Store sales by product, store and month with the store's chain, format and region.

    fact: upc, store_id, sale_date and five measures. Adding up before the store lookup keeps the
    join small.
    """
    measures = ["revenue_sell_out", "vol_sell_out", "pcs_sell_out", "vol_inv", "pcs_inv"]
    fact = fact.withColumn("year_month", F.date_format("sale_date", "yyyyMM"))
    base = sum_by(fact, ["upc", "store_id", "year_month"], {m: m for m in measures})
    store = first_row_dedup(
        stores.select(F.col("store_id").alias("_store"), "chain", "format", "region"), ["_store"]
    )
    return base.join(store, base["store_id"] == store["_store"], "left").drop("_store")


def sell_in_consolidated(
    rows: DataFrame, branches: Sequence[tuple[Column, str, Column]], keys: Sequence[str]
) -> DataFrame:
    """All business units from one pass over the rows. Each branch is (condition, id prefix, volume expression): one
    unit reports litres, the other tonnes from kilograms, so volumes are not comparable. A row counts in every branch
    whose condition holds, and branches are not added up, as in a UNION ALL of one query per branch."""
    parts = [
        F.when(when, F.struct(F.lit(i).alias("_branch"), F.lit(prefix).alias("_prefix"), volume.cast("double").alias("_volume")))
        for i, (when, prefix, volume) in enumerate(branches)
    ]
    each = rows.select("*", F.inline(F.array_compact(F.array(*parts))))
    each = each.withColumn("cliente_id", F.concat("_prefix", F.col("cliente")))
    out = each.groupBy(*keys, "_branch").agg(F.sum("_volume").alias("volumen"), F.sum("revenue_mxn").alias("valor"))
    return out.drop("_branch")


def market_facts_std(
    facts: DataFrame, markets: DataFrame, periods: DataFrame, metrics: DataFrame, metric_key: Column | None = None
) -> DataFrame:
    """Market panel facts (market_id, period_id, fact_column, fact_value) summed by market label,
    level, period and metric. Ids are summed first; labels are looked up on the small result."""
    base = facts.groupBy("market_id", "period_id", "fact_column").agg(
        F.sum(zero_if_null(F.col("fact_value"))).alias("_v"), F.count("*").alias("_n")
    )
    market = first_row_dedup(
        markets.filter(F.col("mrkt_dsc_shrt").isNotNull()).select("market_id", "mrkt_dsc_shrt", "hierarchy_level"),
        ["market_id"],
    )
    period = first_row_dedup(periods.select("period_id", "period_label", "period_end_date"), ["period_id"])
    key = metric_key if metric_key is not None else F.col("fact_column")
    metric = first_row_dedup(
        metrics.select(key.alias("_metric"), "fact_description", "fact_group"), ["_metric"]
    )
    out = base.join(market, "market_id", "inner").join(period, "period_id", "left")
    out = out.join(metric, out["fact_column"] == metric["_metric"], "left")
    return out.groupBy(
        "mrkt_dsc_shrt",
        "hierarchy_level",
        "period_label",
        "period_end_date",
        F.col("fact_column").alias("metric_name"),
        F.col("fact_description").alias("metric_description"),
        F.col("fact_group").alias("metric_group"),
    ).agg(F.sum("_v").alias("metric_value"), F.sum("_n").alias("row_count"))


# --- KPI tables --------------------------------------------------------------------------------

MASTER_KEYS = ["fecha_month", "marca_std", "canal_std", "cadena_std"]


def with_month(df: DataFrame, date: Column) -> DataFrame:
    return df.withColumn("fecha_month", month_trunc(date))


def _prices(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "si_avg_price_mxn_per_litre": safe_divide(F.col("si_revenue_mxn"), F.col("si_vol_litros")),
            "si_avg_price_mxn_per_kg": safe_divide(F.col("si_revenue_mxn"), F.col("si_vol_kg")),
        }
    )


def sell_in_kpi(std: DataFrame, keys: Sequence[str] = ("fecha_month", "marca_std", "canal_std", "cbu")) -> DataFrame:
    """Revenue, volumes, distinct products, rows and prices of shipments with a brand."""
    ok, _ = valid_brand_filter(std, "marca_std")
    return _prices(
        ok.groupBy(*keys).agg(
            F.sum("revenue_mxn").alias("si_revenue_mxn"),
            F.sum("volume_liter").alias("si_vol_litros"),
            F.sum("volume_kgr").alias("si_vol_kg"),
            F.count_distinct("sku_ean_cod").alias("si_sku_count"),
            F.count("*").alias("si_transaction_count"),
        )
    )


def sell_in_kpi_master(std: DataFrame) -> DataFrame:
    """Shipments at month x brand x channel.

    One pass by business unit and product gives both counts: ``si_sku_count`` is the exact number of
    products, ``si_sku_count_by_cbu`` adds the counts of the units up and so counts a product once
    per unit.
    """
    keys = ["fecha_month", "marca_std", "canal_std"]
    ok, _ = valid_brand_filter(std, "marca_std")
    by_sku = ok.groupBy(*keys, "cbu", "sku_ean_cod").agg(
        F.sum("revenue_mxn").alias("_revenue"),
        F.sum("volume_liter").alias("_litres"),
        F.sum("volume_kgr").alias("_kg"),
        F.count("*").alias("_rows"),
    )
    return _prices(
        by_sku.groupBy(*keys).agg(
            F.sum("_revenue").alias("si_revenue_mxn"),
            F.sum("_litres").alias("si_vol_litros"),
            F.sum("_kg").alias("si_vol_kg"),
            F.count_distinct("sku_ean_cod").alias("si_sku_count"),
            F.count("sku_ean_cod").alias("si_sku_count_by_cbu"),
            F.sum("_rows").alias("si_transaction_count"),
        )
    )


def sell_out_kpi(rows: DataFrame) -> DataFrame:
    """Sell-out at the master grain.

    Two distinct counts in one aggregate would copy each row per count. Instead, one roll-up goes over stores and adds
    up the sums, another one over products; both combine before their shuffle, and meet at the master grain, one row
    per key on either side. Keys are compared with NULL as a value.
    """
    ok, _ = valid_brand_filter(rows, "marca_std")
    sums = {
        "so_revenue_mxn": "revenue_sell_out",
        "so_vol_units": "vol_sell_out",
        "so_pcs": "pcs_sell_out",
        "so_inventory_units": "vol_inv",
        "so_pcs_inv": "pcs_inv",
    }
    by_store = ok.groupBy(*MASTER_KEYS, "store_id").agg(
        *[F.sum(src).alias(out) for out, src in sums.items()], F.count("*").alias("so_fact_rows")
    )
    out = by_store.groupBy(*MASTER_KEYS).agg(
        *[F.sum(c).alias(c) for c in sums], F.count("store_id").alias("so_store_count"), F.sum("so_fact_rows").alias("so_fact_rows")
    )
    by_product = ok.groupBy(*MASTER_KEYS, "sku_ean_cod").agg(F.lit(1))
    products = by_product.groupBy(*[F.col(k).alias(f"_{k}") for k in MASTER_KEYS]).agg(F.count("sku_ean_cod").alias("so_sku_count"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in MASTER_KEYS])
    out = out.join(products, same).drop(*[f"_{k}" for k in MASTER_KEYS])
    return out.withColumns(
        {
            "so_avg_price_mxn": safe_divide(F.col("so_revenue_mxn"), F.col("so_vol_units")),
            "so_inventory_days": inventory_days(F.col("so_inventory_units"), F.col("so_vol_units")),
            "coverage_level": coverage_level(F.col("so_store_count")),
        }
    )


def investment_kpi(
    spend: DataFrame, own_brands: Sequence[str], own: str = "OWN", on: str = "MKT_ON", off: str = "MKT_OFF"
) -> DataFrame:
    """Spend by month, brand, channel and owner, split in online and offline media.

    spend: fecha_month, marca_std, canal_std, campana, medio, soporte_plataforma, inversion_real,
    investment_source.
    """
    ok, _ = valid_brand_filter(spend, "marca_std")
    ok = ok.withColumn("brand_owner_type", owner_type(F.col("marca_std"), own_brands, own))
    keys = ["fecha_month", "marca_std", "canal_std", "brand_owner_type"]
    by = [*keys, "campana", "soporte_plataforma", "medio"]
    part = lambda name: F.sum(F.when(F.col("investment_source") == name, F.col("inversion_real")).otherwise(0.0))
    fine = ok.groupBy(*by).agg(
        part(on).alias("inv_mkt_on_mxn"),
        part(off).alias("inv_mkt_off_mxn"),
        F.sum("inversion_real").alias("inv_total_mxn"),
    )
    out = fine.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("inv_mkt_on_mxn", "inv_mkt_off_mxn", "inv_total_mxn")],
        F.count_distinct("campana").alias("inv_campaign_count"),
        F.count_distinct("soporte_plataforma").alias("inv_platform_count"),
        F.count_distinct("medio").alias("inv_media_type_count"),
    )
    return out.withColumn("inv_on_pct", safe_divide(F.col("inv_mkt_on_mxn"), F.col("inv_total_mxn")))


# --- market panel ------------------------------------------------------------------------------

# Raw metric name -> KPI name. Two raw names may feed one KPI.
METRIC_NAMES = {
    "U": "nls_units",
    "E": "nls_equiv_units",
    "DOL": "nls_dollar_sales",
    "AVG_U_PRC": "nls_avg_unit_price",
    "AVG_E_PRC": "nls_avg_equiv_price",
    "U_ROS": "nls_units_ros",
    "E_ROS": "nls_equiv_ros",
    "DOL_ROS": "nls_dollar_ros",
    "VALUE_SHARE": "nls_value_share",
    "VOLUME_SHARE": "nls_volume_share",
    "NUMERIC_DISTRIBUTION": "nls_numeric_dist",
    "NUM_DIST": "nls_numeric_dist",
    "CATEGORY_VALUE": "nls_category_value_mxn",
    "NUMERIC_DIST_OOSLS": "nls_numeric_dist_oos",
    "DOL_CCV_REACH_CONTEXT": "nls_dollar_ccv_reach",
    "DOL_CCV_NON_REACH_CONTEXT_OOSLS": "nls_dollar_ccv_oos_no_reach",
    "DOL_CCV_TDP_REACH_CONTEXT": "nls_dollar_ccv_tdp_reach",
}


def metric_pivot(facts: DataFrame, keys: Sequence[str], names: Mapping[str, str] = METRIC_NAMES) -> DataFrame:
    """Metric rows -> one column per KPI, and the metrics without a KPI in the map ``other_metrics`` (NULL if none).

    An absent metric is a NULL column. Aliases of one KPI fill in for each other in list order. Facts are added up by
    key and metric first; what is left per key is as long as the vocabulary. ``unmapped_metrics`` warns of the map.
    """
    sums = facts.groupBy(*keys, "metric_name").agg(F.sum("metric_value").cast("double").alias("_sum"))
    other = F.collect_list(F.when(~F.col("metric_name").isin(list(names)), F.struct("metric_name", "_sum")))
    wide = sums.groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric_name") == raw, F.col("_sum"))).alias(f"_m{i}") for i, raw in enumerate(names)], other.alias("_other")
    )
    place = {raw: f"_m{i}" for i, raw in enumerate(names)}
    return wide.select(
        *keys,
        *[F.coalesce(*[F.col(place[raw]) for raw, k in names.items() if k == kpi]).alias(kpi) for kpi in dict.fromkeys(names.values())],
        F.when(F.size("_other") > 0, F.map_from_entries("_other")).alias("other_metrics"),
    )


def unmapped_metrics(facts: DataFrame, names: Mapping[str, str] = METRIC_NAMES, table: str = "market_facts") -> DataFrame:
    """Metrics without a KPI as check rows: their name, number of rows and a warning each."""
    counts = facts.filter(F.col("metric_name").isNotNull() & ~F.col("metric_name").isin(list(names))).groupBy("metric_name").agg(F.count("*").alias("_n"))
    return counts.select(
        F.concat(F.lit("W3_unmapped_metric:"), "metric_name").alias("check_id"), F.lit(table).alias("table_name"),
        F.col("_n").cast("double").alias("metric"), F.lit(0.0).alias("threshold"), F.lit("WARNING").alias("status"),
    )


# Metrics that cannot be added over markets and weeks.
RATIO_PRICES = {
    "nls_avg_unit_price": ("nls_dollar_sales", "nls_units"),
    "nls_avg_equiv_price": ("nls_dollar_sales", "nls_equiv_units"),
}
WEIGHTED_SHARES = ("nls_value_share", "nls_volume_share")
MAX_METRICS = (
    "nls_numeric_dist",
    "nls_numeric_dist_oos",
    "nls_dollar_ccv_reach",
    "nls_dollar_ccv_oos_no_reach",
    "nls_dollar_ccv_tdp_reach",
)


def market_kpi_master(wide: DataFrame, weight: str = "nls_dollar_sales") -> DataFrame:
    """Market KPIs at month x channel.

    Additive metrics are summed. A price is value over units, a share is the mean weighted by value
    (plain mean without weights), a distribution is the maximum.
    """
    keys = ["fecha_month", "canal_std"]
    exprs = []
    for c in [c for c in wide.columns if c.startswith("nls_")]:
        value = F.col(c)
        if c in RATIO_PRICES:
            num, den = RATIO_PRICES[c]
            total = safe_divide(F.sum(num), F.sum(den))
            exprs.append(F.coalesce(total, F.avg(value)).alias(c))
        elif c in WEIGHTED_SHARES:
            w = F.when(value.isNotNull(), F.col(weight))
            exprs.append(F.coalesce(safe_divide(F.sum(value * w), F.sum(w)), F.avg(value)).alias(c))
        elif c in MAX_METRICS:
            exprs.append(F.max(value).alias(c))
        else:
            exprs.append(F.sum(value).alias(c))
    return wide.groupBy(*keys).agg(*exprs)


def market_kpi_sums(wide: DataFrame) -> DataFrame:
    """Every market column summed, prices and shares too: kept to compare with older reports."""
    cols = [c for c in wide.columns if c.startswith("nls_")]
    return wide.groupBy("fecha_month", "canal_std").agg(*[F.sum(c).alias(c) for c in cols])


def conditional_metric_wide(
    long: DataFrame, keys: Sequence[str], sums: Mapping[str, Sequence[str]], maxima: Mapping[str, Sequence[str]],
    tag: str = "fact_tag", text: str = "fact_short_dsc", value: str = "fact_value",
) -> DataFrame:
    """One column per measure from rows whose tag or description is in its list. Rows of other
    metrics count as 0, so a maximum is never below 0."""

    def picked(names: Sequence[str]) -> Column:
        hit = F.coalesce(F.col(tag).isin(*names), F.lit(False)) | F.coalesce(F.col(text).isin(*names), F.lit(False))
        return F.when(hit, F.col(value)).otherwise(0.0)

    return long.groupBy(*keys).agg(
        *[F.sum(picked(n)).alias(out) for out, n in sums.items()],
        *[F.max(picked(n)).alias(out) for out, n in maxima.items()],
    )


def unit_rescale_metric(long: DataFrame, metrics: Sequence[str], factor: float = 1000.0, tag: str = "fact_tag") -> DataFrame:
    scaled = F.when(F.col(tag).isin(*metrics), F.col("fact_value") / factor).otherwise(F.col("fact_value"))
    return long.withColumn("fact_value", scaled)


# --- master ------------------------------------------------------------------------------------

# Column contract of the master table.
MASTER_COLUMNS = [
    "fecha_month", "marca_std", "canal_std", "cadena_std",
    "si_revenue_mxn", "si_vol_litros", "si_vol_kg", "si_avg_price_mxn_per_litre",
    "si_avg_price_mxn_per_kg", "si_sku_count",
    "so_revenue_mxn", "so_vol_units", "so_avg_price_mxn", "so_inventory_days", "so_store_count",
    "coverage_level",
    "inv_total_mxn", "inv_mkt_on_mxn", "inv_mkt_off_mxn", "inv_on_pct",
    "nls_value_share", "nls_volume_share", "nls_numeric_dist", "nls_category_value_mxn",
    "roas_gross",
    "gold_run_ts", "data_confidence", "has_sell_in", "has_sell_out", "has_investment", "has_nielsen",
    "silver_input_mode",
]


def kpi_master_join(
    sell_out: DataFrame, sell_in: DataFrame, spend: DataFrame, market: DataFrame, own: str = "OWN",
    run_at: str | None = None, input_mode: str = "FULL",
) -> DataFrame:
    """Sell-out rows with shipments, own spend and market KPIs on coarser and coarser keys.

    The right sides are aggregates grouped by exactly their join keys, so the left joins cannot add
    rows. Own spend drops the owner column after the filter, which leaves it unique too.
    """
    if input_mode == "SAMPLE":
        raise ValueError("a sample must not produce KPI output")
    brand_keys = ["fecha_month", "marca_std", "canal_std"]
    own_spend = spend.filter(F.col("brand_owner_type") == own).drop("brand_owner_type")
    out = (
        sell_out.join(sell_in, brand_keys, "left")
        .join(own_spend, brand_keys, "left")
        .join(market, ["fecha_month", "canal_std"], "left")
    )
    has = {
        "has_sell_in": F.col("si_revenue_mxn").isNotNull(),
        "has_sell_out": F.col("so_revenue_mxn").isNotNull(),
        "has_investment": F.col("inv_total_mxn").isNotNull(),
        "has_nielsen": F.col("nls_value_share").isNotNull() | F.col("nls_volume_share").isNotNull(),
    }
    out = out.withColumns(
        {
            **has,
            "roas_gross": safe_divide(F.col("so_revenue_mxn"), F.col("inv_total_mxn")),
            "data_confidence": data_confidence(*has.values()),
            "gold_run_ts": F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp"),
            "silver_input_mode": F.lit(input_mode),
        }
    )
    return out.select(*MASTER_COLUMNS)


def brand_month_all_source(sources: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> dict[str, DataFrame]:
    """Month x brand sums per source: {name: (rows, {output: column})}."""
    return {
        name: rows.groupBy("fecha_month", "marca_std").agg(*[F.sum(c).alias(out) for out, c in sums.items()])
        for name, (rows, sums) in sources.items()
    }


def all_source_full_join(sell_in: DataFrame, sell_out: DataFrame, online: DataFrame, offline: DataFrame) -> DataFrame:
    """Shipments FULL OUTER store sales, media LEFT on the merged keys. Inputs are month x brand
    aggregates; ``using`` columns of a full join are already the coalesced keys."""
    keys = ["fecha_month", "marca_std"]
    return sell_in.join(sell_out, keys, "full").join(online, keys, "left").join(offline, keys, "left")


def old_new_grain_reconcile(rows: DataFrame, keys: Sequence[str], fine: Sequence[str], measure: str) -> DataFrame:
    """Totals per key from the rows and from a finer pre-aggregation; both must agree."""
    direct = rows.groupBy(*keys).agg(F.sum(measure).alias("direct_total"), F.count("*").alias("direct_rows"))
    pre = rows.groupBy(*keys, *fine).agg(F.sum(measure).alias("_m"), F.count("*").alias("_n"))
    rolled = pre.groupBy(*keys).agg(F.sum("_m").alias("rolled_total"), F.sum("_n").alias("rolled_rows"))
    joined = direct.join(rolled, list(keys), "full")
    same = (F.abs(F.col("direct_total") - F.col("rolled_total")) < 0.005) & (
        F.col("direct_rows") == F.col("rolled_rows")
    )
    return joined.withColumn("status", F.when(same, "MATCH").otherwise("DIFFERENT"))


def store_sales_enriched(std: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Standardized store sales with bar-code bridge, store product attributes and brand."""
    bridge = min_per_key(items.filter(F.trim("sku_ean_cod") != ""), "sku_ean_cod", ["mat_idt"])
    out = std.join(bridge, std["upc"] == bridge["sku_ean_cod"], "left")
    out = mapping_left_join(out, products, "upc", "int_id", ["so_name", "so_brand", "so_category"], on_conflict="first")
    return out.withColumn("marca_std", F.upper(F.trim("so_brand")))
