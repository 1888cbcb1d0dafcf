"""Profiles, readiness and relations between datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import checks, profiling
from cartmetrics.operators.series import temporal_gaps
from cartmetrics.plans.check_plans import RULES
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.readers import config_frame
from cartmetrics.sources.roles import Tables

GLOSSARY = ["C_MKTSEGMENT", "C_CUSTKEY", "O_ORDERKEY"]


def inventory_sql(dataset: str, table: str, types: dict[str, str], classes: dict[str, str] | None = None) -> str:
    """Oracle text of the column inventory; values compare as text."""
    classes = classes or {}
    parts = []
    for c, kind in types.items():
        parts.append(f"""
            SELECT '{dataset}' AS dataset, '{c}' AS column_name, '{kind}' AS data_type, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_rows,
                   ROUND((COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*), 6) AS null_pct,
                   CASE WHEN (COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*) > 5 THEN 'HIGH' WHEN (COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*) > 1 THEN 'WARN' ELSE 'OK' END AS null_flag,
                   COUNT(DISTINCT {c}) + CASE WHEN COUNT(*) > COUNT({c}) THEN 1 ELSE 0 END AS distinct_count,
                   COUNT(DISTINCT {c}) = COUNT(*) AS is_pk_candidate,
                   (SELECT STRING_AGG(v, ' | ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5)) AS sample_values,
                   '{classes.get(c, 'FACT / MEASURE')}' AS dimension_class, {str(c.upper() in GLOSSARY).upper()} AS in_glossary
            FROM {table}""")
    return " UNION ALL ".join(parts)


CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string"}
ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_orderpriority": "string"}
ITEM_TYPES = {
    "mat_idt": "string", "sku_ean_cod": "string", "mat_lcl_dsc": "string", "brand": "string", "cbu": "string", "is_active": "boolean",
    "category": "string", "size": "int",
}


@query(roles=("items",), sql=inventory_sql("ITEMS", "items", ITEM_TYPES, {"brand": "DIM_BRAND", "category": "DIM_BRAND"}))
def column_inventory(t: Tables) -> DataFrame:
    """All columns are counted value by value, however many values they have."""
    return rounded(profiling.column_inventory(t.items, "ITEMS", t.items.columns, GLOSSARY, exact_up_to=None).drop("distinct_is_exact"), 6)


@query(
    roles=("sell_out",),
    extra={
        "v": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS n FROM sell_out GROUP BY {c}" for c in ("cadena_std", "canal_std", "marca_std", "upc")
        ),
        "r": "SELECT *, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n DESC, value NULLS LAST) AS rn, SUM(n) OVER (PARTITION BY column_name) AS total FROM v",
    },
    sql="SELECT 'SELL_OUT' AS dataset, column_name, COALESCE(value, '(null)') AS value, n AS frequency, ROUND(n * 100.0::DOUBLE / total, 6) AS coverage_pct FROM r WHERE rn <= 50",
)
def domain_profile(t: Tables) -> DataFrame:
    return rounded(profiling.domain_profile(t.sell_out, "SELL_OUT", ["cadena_std", "canal_std", "marca_std", "upc"], top=50), 6)


@query(
    """SELECT 'ORDERS' AS dataset, MIN(d) AS date_min, MAX(d) AS date_max, COUNT(DISTINCT d) AS distinct_dates, COUNT(CASE WHEN d IS NULL THEN 1 END) AS failed_casts,
              (SELECT COUNT(*) FROM (SELECT w - LAG(w) OVER (ORDER BY w) AS g FROM (SELECT DISTINCT CAST(DATE_TRUNC('week', o_orderdate) AS DATE) AS w FROM orders WHERE o_orderstatus <> 'P')) WHERE g // 7 > 2) AS temporal_gaps
       FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)"""
)
def temporal_profile(t: Tables) -> DataFrame:
    """Dates coded as text, those of partial orders unreadable."""
    coded = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    rows = t.orders.select(coded.alias("day_id"))
    return profiling.temporal_profile(rows, "ORDERS", "day_id", S.date_from_int(F.col("day_id")))


LINE_GRAIN = {
    "combos": " UNION ALL ".join(
        f"SELECT {i} AS try_no, '{' x '.join(c)}' AS candidate_grain, {len(c)} AS combo_size, '{s}' AS source, COUNT(*) AS distinct_rows FROM (SELECT DISTINCT {', '.join(c)} FROM lineitem)"
        for i, (s, c) in enumerate(
            [
                ("DECLARED", ("l_orderkey", "l_linenumber")),
                ("AUTO", ("l_orderkey",)),
                ("AUTO", ("l_linenumber",)),
                ("AUTO", ("l_partkey",)),
                ("AUTO", ("l_suppkey",)),
                ("AUTO", ("l_orderkey", "l_partkey")),
                ("AUTO", ("l_orderkey", "l_suppkey")),
                ("AUTO", ("l_linenumber", "l_partkey")),
                ("AUTO", ("l_linenumber", "l_suppkey")),
                ("AUTO", ("l_partkey", "l_suppkey")),
                ("AUTO", ("l_orderkey", "l_partkey", "l_suppkey")),
                ("AUTO", ("l_linenumber", "l_partkey", "l_suppkey")),
            ]
        )
    ),
    "every": "SELECT *, distinct_rows * 100.0::DOUBLE / (SELECT COUNT(*) FROM lineitem) AS pct FROM combos",
    "p": "SELECT * FROM every WHERE try_no <= COALESCE((SELECT MIN(try_no) FROM every WHERE pct >= 100), 99)",
}


@query(
    extra=LINE_GRAIN,
    sql="""SELECT 'LINEITEM' AS dataset, try_no, candidate_grain, combo_size, source, distinct_rows, ROUND(pct, 6) AS uniqueness_pct,
                  CASE WHEN pct >= 100 THEN 'PERFECT' WHEN pct >= 95 THEN 'HIGH' WHEN pct >= 80 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
                  try_no = (SELECT ARG_MIN(try_no, STRUCT_PACK(p := -pct, t := try_no)) FROM p) AS is_best
           FROM p""",
)
def grain_detection(t: Tables) -> DataFrame:
    """The declared grain and every combination up to the first perfect one, counted exactly."""
    out = profiling.grain_detection(
        t.lineitem, "LINEITEM", ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], every=True
    )
    return rounded(out.drop("is_exact", "best_of_size"), 6)


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@query(
    " UNION ALL ".join(
        f"""SELECT 'LINEITEM' AS dataset, '{c}' AS column_name, CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value, ROUND(CAST(SUM({c}) AS DOUBLE), 2) AS sum_value,
            ROUND(AVG({c}), 4) AS mean_value, COUNT(CASE WHEN {c} < 0 THEN 1 END) AS negative_rows, COUNT(CASE WHEN {c} = 0 THEN 1 END) AS zero_rows FROM lineitem"""
        for c in NUMERIC
    )
)
def numeric_profile(t: Tables) -> DataFrame:
    out = profiling.numeric_profile(t.lineitem, "LINEITEM", NUMERIC)
    return out.withColumns({"sum_value": S.stable_round(F.col("sum_value"), 2), "mean_value": S.stable_round(F.col("mean_value"), 4)})


@query(
    """SELECT 'LINEITEM' AS dataset, CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows
       FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
)
def duplicate_profile(t: Tables) -> DataFrame:
    return profiling.duplicate_profile(t.lineitem, "LINEITEM", ["l_orderkey", "l_linenumber"])


# --- readiness ---------------------------------------------------------------------------------

READY = {
    "r": """SELECT * FROM (VALUES ('o_orderkey', 'mandatory'), ('o_orderkey', 'unique'), ('o_orderstatus', 'allowed_values'), ('o_totalprice', 'value_range'), ('o_orderpriority', 'pattern'), ('o_custkey', 'unique'), ('o_clerk', 'mandatory')) v(c, k)""",
    "f": """SELECT COUNT(CASE WHEN o_orderkey IS NULL THEN 1 END) = 0 AS p1, COUNT(*) = COUNT(DISTINCT o_orderkey) AS p2, COUNT(CASE WHEN o_orderstatus NOT IN ('F','O') THEN 1 END) = 0 AS p3,
                   COUNT(CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 1 END) = 0 AS p4, COUNT(CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$') THEN 1 END) = 0 AS p5,
                   COUNT(*) = COUNT(DISTINCT o_custkey) AS p6, (COUNT(*) - COUNT(o_custkey)) * 100.0::DOUBLE / COUNT(*) AS key_null_pct, COUNT(DISTINCT o_orderkey) * 100.0::DOUBLE / COUNT(*) AS uniq FROM orders""",
    "g": """SELECT COUNT(*) AS gaps FROM (SELECT w - LAG(w) OVER (ORDER BY w) AS g FROM (SELECT DISTINCT CAST(DATE_TRUNC('week', o_orderdate) AS DATE) AS w FROM orders)) WHERE g // 7 > 2""",
    "s": """SELECT 'ORDERS' AS dataset, CAST(GREATEST(0, 20 - 5 * (CASE WHEN p1 THEN 1 ELSE 2 END)) AS INT) AS score_completeness,
                   CAST(ROUND((CAST(p2 AS INT) + CAST(p3 AS INT) + CAST(p4 AS INT) + CAST(p5 AS INT) + CAST(p6 AS INT)) / 5.0::DOUBLE * 20, 0) AS INT) AS score_consistency,
                   CAST(ROUND(25 - key_null_pct / 4, 0) AS INT) AS score_joinability, CAST(CASE WHEN gaps = 0 THEN 15 ELSE GREATEST(5, 15 - 2 * gaps) END AS INT) AS score_temporal,
                   CAST(ROUND(1 * 10.0::DOUBLE / 6, 0) AS INT) AS score_documentation, CASE WHEN uniq >= 100 THEN 10 WHEN uniq >= 95 THEN 8 WHEN uniq >= 80 THEN 6 ELSE 3 END AS score_grain
            FROM f, g""",
}


def order_profile(t: Tables) -> DataFrame:
    """One row of profile numbers for the orders table."""
    rules = checks.dq_rules(t.orders, RULES)
    passed = F.col("status") == "PASS"
    mandatory = F.col("rule_type") == "mandatory"
    a = rules.agg(
        F.lit("ORDERS").alias("dataset"),
        F.count_if(mandatory).alias("mandatory_rules"),
        F.count_if(mandatory & ~passed).alias("mandatory_failed"),
        F.count_if(~mandatory).alias("other_rules"),
        F.count_if(~mandatory & passed).alias("other_passed"),
    )
    columns = t.orders.columns
    known = sum(c.upper() in GLOSSARY for c in columns)
    return a.withColumns(
        {
            "n_keys": F.lit(1),
            "key_null_pct": t.orders.agg(F.count_if(F.col("o_custkey").isNull()) * 100.0 / F.count("*")).scalar(),
            "grain_uniqueness_pct": t.orders.agg(F.count_distinct("o_orderkey") * 100.0 / F.count("*")).scalar(),
            "temporal_gaps": temporal_gaps(t.orders, "o_orderdate").agg(F.count("*")).scalar(),
            "has_date": F.lit(True),
            "n_columns": F.lit(len(columns)),
            "n_documented": F.lit(known),
        }
    )


SCORES = ["dataset", "score_completeness", "score_consistency", "score_joinability", "score_temporal", "score_documentation", "score_grain", "enterprise_score", "readiness_label"]
LABEL_SQL = """SELECT *, score_completeness + score_consistency + score_joinability + score_temporal + score_documentation + score_grain AS enterprise_score,
    CASE WHEN score_completeness + score_consistency + score_joinability + score_temporal + score_documentation + score_grain >= 80 THEN 'ENTERPRISE READY'
         WHEN score_completeness + score_consistency + score_joinability + score_temporal + score_documentation + score_grain >= 60 THEN 'CONDITIONAL' ELSE 'NOT READY' END AS readiness_label FROM {0}"""


@query(extra=READY, sql=LABEL_SQL.format("s"))
def readiness_score(t: Tables) -> DataFrame:
    return profiling.readiness_score(order_profile(t)).select(*SCORES)


JOIN_REPORT = {
    "l": "SELECT DISTINCT o_orderkey AS a FROM orders",
    "m": "SELECT DISTINCT l_orderkey AS b FROM lineitem",
    "x": "SELECT COUNT(*) AS left_count, COUNT(b) AS matched_count FROM l LEFT JOIN m ON a = b",
    "y": "SELECT *, matched_count * 100.0::DOUBLE / left_count AS rate FROM x",
}


@query(
    extra=JOIN_REPORT,
    sql="""SELECT 'ORDERKEY' AS join_key, 'ORDERS' AS dataset_a, 'o_orderkey' AS column_a, 'LINEITEM' AS dataset_b, 'l_orderkey' AS column_b, left_count, matched_count, ROUND(rate, 6) AS match_rate_pct,
                  ROUND(100 - rate, 6) AS unmatched_pct, CASE WHEN 100 - rate <= 20 THEN 'PASS' ELSE 'FAIL' END AS status, 'LIVE' AS method FROM y""",
)
def join_validation_report(t: Tables) -> DataFrame:
    return rounded(order_line_report(t), 6)


def order_line_report(t: Tables) -> DataFrame:
    return profiling.join_validation_report(
        "orderkey", ("ORDERS", t.orders, "o_orderkey"), ("LINEITEM", t.lineitem, "l_orderkey")
    )


@query(
    extra=READY
    | JOIN_REPORT
    | {"lv": "SELECT s.* REPLACE (CAST(ROUND(y.rate / 100 * 25, 0) AS INT) AS score_joinability) FROM s, y"},
    sql=LABEL_SQL.format("lv"),
)
def readiness_score_live(t: Tables) -> DataFrame:
    scores = profiling.readiness_score(order_profile(t)).select(*SCORES)
    return profiling.readiness_score_live(scores, order_line_report(t)).select(*SCORES)


# --- relations ---------------------------------------------------------------------------------

SHARED = {"orders": {"o_orderkey": "sku", "o_custkey": "cus_idt"}, "lineitem": {"l_orderkey": "sku", "l_suppkey": "upc"}, "customer": {"c_custkey": "cus_idt", "c_nationkey": "upc"}}


def shared_inventory(t: Tables) -> DataFrame:
    """Inventory of three tables whose key columns carry shared names, counted value by value at any size."""
    parts = [
        profiling.column_inventory(
            t.table(name).select(*[F.col(c).alias(n) for c, n in columns.items()]), name.upper(), list(columns.values()), ["SKU"], exact_up_to=None
        )
        for name, columns in SHARED.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


INVENTORY_SQL = " UNION ALL ".join(
    f"SELECT '{table.upper()}' AS dataset, '{alias}' AS column_name, COUNT(DISTINCT {column}) AS distinct_count, COUNT(DISTINCT {column}) = COUNT(*) AS is_pk_candidate, 0.0::DOUBLE AS null_pct FROM {table}"
    for table, columns in SHARED.items()
    for column, alias in columns.items()
)
MATRIX_SQL = """SELECT a.column_name AS column_normalized, a.dataset AS dataset_a, a.null_pct AS null_pct_a, a.distinct_count AS distinct_a, b.dataset AS dataset_b, b.null_pct AS null_pct_b, b.distinct_count AS distinct_b,
                       CASE WHEN a.column_name IN ('sku', 'upc') THEN 'BUSINESS_MAPPING' ELSE 'DIRECT' END AS match_type, CASE WHEN a.column_name IN ('sku', 'upc') THEN 'HOMOLOGATION NEEDED' ELSE 'JOIN READY' END AS join_recommendation
                FROM inv a JOIN inv b ON a.column_name = b.column_name AND a.dataset < b.dataset"""


@query(extra={"inv": INVENTORY_SQL}, sql=MATRIX_SQL)
def relationship_matrix(t: Tables) -> DataFrame:
    return profiling.relationship_matrix(shared_inventory(t))


@query(
    extra={"inv": INVENTORY_SQL, "m": MATRIX_SQL},
    sql="""SELECT UPPER(column_normalized) AS join_key, dataset_a, dataset_b, distinct_a AS left_count, LEAST(distinct_a, distinct_b) AS matched_count,
                  ROUND(LEAST(distinct_a, distinct_b) * 100.0::DOUBLE / distinct_a, 6) AS match_rate_pct, ROUND(100 - LEAST(distinct_a, distinct_b) * 100.0::DOUBLE / distinct_a, 6) AS unmatched_pct,
                  'ESTIMATED' AS status, 'CARDINALITY_ESTIMATE' AS method FROM m""",
)
def join_estimate_report(t: Tables) -> DataFrame:
    return rounded(profiling.join_estimate_report(profiling.relationship_matrix(shared_inventory(t))), 6)


@query(
    extra={"inv": INVENTORY_SQL},
    sql="""SELECT 'DIM_PRODUCT' AS target_dimension, column_name AS column_normalized, dataset, null_pct, distinct_count, is_pk_candidate,
                  CASE WHEN is_pk_candidate THEN 'PRIMARY KEY' WHEN column_name = 'upc' THEN 'FOREIGN KEY' ELSE 'ATTRIBUTE' END AS suggested_role FROM inv WHERE column_name IN ('sku', 'upc')""",
)
def dimension_candidates(t: Tables) -> DataFrame:
    return profiling.dimension_candidates(shared_inventory(t), ["UPC"])


@query(
    extra={"inv": INVENTORY_SQL},
    sql="""SELECT UPPER(column_name) AS column_name, STRING_AGG(DISTINCT dataset, ', ' ORDER BY dataset) AS datasets, COUNT(DISTINCT dataset) AS n_datasets,
                  CASE WHEN column_name = 'sku' THEN 'Stock keeping unit' ELSE '[TO BE DEFINED]' END AS business_name, CASE WHEN column_name = 'sku' THEN 'DOCUMENTED' ELSE 'TO BE DEFINED' END AS documentation_status
           FROM inv GROUP BY column_name""",
)
def glossary_report(t: Tables) -> DataFrame:
    glossary = config_frame(t.spark, [("SKU", "Stock keeping unit")], "column_name string, business_name string")
    return profiling.glossary_report(shared_inventory(t), glossary)


STORE_SCORES = " UNION ALL ".join(
    f"""SELECT 'STORES' AS source, '{c}' AS column_name, COUNT(*) AS total_rows, 0.0::DOUBLE AS null_pct, COUNT(DISTINCT {c}) AS distinct_count, ROUND(LN(1 + COUNT(DISTINCT {c})), 4) AS d1_score FROM stores"""
    for c in ("chain", "format", "region", "store_id")
)


@query(roles=("stores",), extra={"s": STORE_SCORES}, sql="SELECT source, column_name, total_rows, null_pct, distinct_count, d1_score FROM s")
def d1_score(t: Tables) -> DataFrame:
    return profiling.column_scores(t.stores, "STORES", ["chain", "format", "region", "store_id"]).drop("cardinality_class")


@query(
    roles=("stores",),
    extra={"s": STORE_SCORES},
    sql="""SELECT column_name, distinct_count, CASE WHEN distinct_count <= 15 THEN 'CHANNEL_LIKE' WHEN distinct_count <= 200 THEN 'CHAIN_LIKE' ELSE 'TOO_GRANULAR' END AS cardinality_class FROM s""",
)
def cardinality_class(t: Tables) -> DataFrame:
    out = profiling.column_scores(t.stores, "STORES", ["chain", "format", "region", "store_id"])
    return out.select("column_name", "distinct_count", "cardinality_class")


@query(roles=("stores",), sql="SELECT region, chain, format, COUNT(*) AS n_rows FROM stores GROUP BY ALL")
def hierarchy_profile(t: Tables) -> DataFrame:
    return profiling.hierarchy_profile(t.stores, ["region", "chain", "format"])
