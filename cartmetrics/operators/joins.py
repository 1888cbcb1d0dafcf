"""Joins with guarded cardinality: a lookup must not change the number of fact rows.

Lookups here first make the right side unique, by a check or by an aggregate, so row counts hold by
construction. No broadcast hint is given on data; see ``cartmetrics.session``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import norm_key

# --- one row per key ---------------------------------------------------------------------------


def first_row_dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by the remaining columns.

    ``min`` over a struct combines before the shuffle, so a key that holds a third of all rows
    costs one row per task; a row_number window would sort it in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranks, *rest)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def key_conflicts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in another column, with the first and the last of these rows: the audit
    before a deduplication. Repeated equal rows are no conflict."""
    rest = F.struct(*[c for c in df.columns if c not in keys])
    out = df.groupBy(*keys).agg(F.min(rest).alias("first_row"), F.max(rest).alias("last_row"), F.count("*").alias("n_rows"))
    return out.filter(~F.col("first_row").eqNullSafe(F.col("last_row")))


def unique_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, and an error where rows of a key differ. The check runs with the aggregate
    itself, on every key that is read, and needs no pass of its own."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"), F.max(F.struct(*rest)).alias("_last"))
    named = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    stop = F.raise_error(F.concat(F.lit("conflicting rows for key "), named))
    row = F.when(F.col("_row").eqNullSafe(F.col("_last")), F.col("_row")).otherwise(stop)
    return best.select(*keys, row.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def _one_row(df: DataFrame, keys: Sequence[str], on_conflict: str) -> DataFrame:
    if on_conflict not in ("first", "error"):
        raise ValueError("on_conflict is 'first' or 'error'")
    return first_row_dedup(df, keys) if on_conflict == "first" else unique_row(df, keys)


def min_per_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per non-NULL key with the column-wise minimum; values may come from different rows."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(c) for c in columns])


# --- lookups -----------------------------------------------------------------------------------


def mapping_left_join(
    fact: DataFrame, mapping: DataFrame, fact_key: str, map_key: str, columns: Sequence[str], prefix: str = "",
    on_conflict: str = "error",
) -> DataFrame:
    """Left join of a mapping on normalized text keys.

    The mapping is collapsed to one row per key and its columns are renamed before the join, so the
    fact keeps its row count and no name is ambiguous. Where rows of a key differ, the job fails ("error"), or
    ``on_conflict="first"`` takes the first; ``key_conflicts`` lists them.
    """
    names = {c: f"{prefix}{c}" for c in columns}
    taken = set(names.values()) & set(fact.columns)
    if taken:
        raise ValueError(f"columns exist on both sides: {sorted(taken)}")
    right = mapping.select(
        norm_key(F.col(map_key)).alias("_map_key"), *[F.col(c).alias(n) for c, n in names.items()]
    ).filter(F.col("_map_key").isNotNull())
    right = _one_row(right, ["_map_key"], on_conflict)
    return fact.join(right, norm_key(fact[fact_key]) == right["_map_key"], "left").drop("_map_key")


def product_dedup_join(
    fact: DataFrame, products: DataFrame, fact_key: str, product_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join of a product dimension collapsed to one row per id."""
    dim = min_per_key(products, product_key, columns).withColumnRenamed(product_key, "_product_key")
    return fact.join(dim, fact[fact_key] == dim["_product_key"], "left").drop("_product_key")


def ean_bridge_join(fact: DataFrame, items: DataFrame, fact_key: str, ean: str = "sku_ean_cod") -> DataFrame:
    """Product code of the fact -> bar code -> product: the smallest product id per bar code."""
    bridge = min_per_key(items.filter(F.trim(ean) != ""), ean, ["mat_idt", "mat_lcl_dsc"])
    bridge = bridge.select(F.col(ean), F.col("mat_idt"), F.col("mat_lcl_dsc").alias("si_description"))
    return fact.join(bridge, fact[fact_key] == bridge[ean], "left")


def lookup_on(
    fact: DataFrame, dim: DataFrame, pairs: Mapping[str, str], columns: Sequence[str], null_safe: bool = False,
    on_conflict: str = "first",
) -> DataFrame:
    """Left join on several natural-key columns (fact column -> dimension column).

    A NULL key matches nothing unless ``null_safe`` asks for it; ``on_conflict`` as in mapping_left_join.
    """
    right = dim.select(*[F.col(d).alias(f"_dim_{d}") for d in dict.fromkeys(pairs.values())], *columns)
    right = _one_row(right, [f"_dim_{d}" for d in dict.fromkeys(pairs.values())], on_conflict)

    def equal(f: str, d: str) -> Column:
        left, other = fact[f], right[f"_dim_{d}"]
        return left.eqNullSafe(other) if null_safe else left == other

    on = reduce(lambda a, b: a & b, [equal(f, d) for f, d in pairs.items()])
    return fact.join(right, on, "left").drop(*[c for c in right.columns if c.startswith("_dim_")])


def star_inner_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Inner join of dimensions, each on its (fact column -> dimension column) pairs; a composite
    key may share a column such as the business unit between dimensions. A dimension is made unique
    on its key first, so that no fact row is multiplied."""
    out = fact
    for i, (dim, pairs) in enumerate(dims):
        right = dim.select(
            *[F.col(d).alias(f"_k{i}_{d}") for d in pairs.values()],
            *[c for c in dim.columns if c not in pairs.values()],
        )
        right = first_row_dedup(right, [f"_k{i}_{d}" for d in pairs.values()])
        on = reduce(lambda a, b: a & b, [out[f] == right[f"_k{i}_{d}"] for f, d in pairs.items()])
        out = out.join(right, on, "inner").drop(*[f"_k{i}_{d}" for d in pairs.values()])
    return out


def computed_key_join(
    fact: DataFrame, dim: DataFrame, fact_key: Column, dim_key: Column, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join on expressions, computed once per side so Spark can hash them."""
    left = fact.withColumn("_left_key", fact_key)
    right = first_row_dedup(dim.select(dim_key.alias("_right_key"), *columns), ["_right_key"])
    return left.join(right, left["_left_key"] == right["_right_key"], how).drop("_left_key", "_right_key")


def period_bridge_join(fact: DataFrame, bridge: DataFrame, date_col: str) -> DataFrame:
    """Week-ending date -> assigned month through a bridge (fecha_fin, fecha); inner, as a week
    without a month belongs to no report. A week in several months goes to the first."""
    bridge = first_row_dedup(bridge, ["fecha_fin"])
    return fact.join(bridge, fact[date_col] == bridge["fecha_fin"], "inner").drop("fecha_fin")


# --- customers ---------------------------------------------------------------------------------


def customer_dictionary(dictionary: DataFrame, keys: Sequence[str] = ("old_cus_idt",)) -> DataFrame:
    """One row per old id (and organisation): the smallest new id, NULLs last."""
    order = [F.col("new_cus_idt").isNull(), F.col("new_cus_idt")]
    return first_row_dedup(dictionary.select(*keys, "new_cus_idt"), keys, order)


def one_hop_customer_harmonization(fact: DataFrame, dictionary: DataFrame, customer: str) -> DataFrame:
    one = customer_dictionary(dictionary)
    joined = fact.join(one, fact[customer] == one["old_cus_idt"], "left")
    return joined.withColumn("harmonized_cus_idt", F.coalesce("new_cus_idt", customer)).drop(
        "old_cus_idt", "new_cus_idt"
    )


def two_hop_customer_harmonization(
    fact: DataFrame, dictionary: DataFrame, customer: str, org: str = "sal_org_cod", prefix: str = ""
) -> DataFrame:
    """Old id -> new id -> newer id inside one sales organisation; an id that is not in the
    dictionary stays. ``cliente_id`` carries the prefix of the business unit."""
    base = customer_dictionary(dictionary, ["old_cus_idt", org])

    def hop(n: int) -> DataFrame:
        return base.select(
            F.col("old_cus_idt").alias(f"_old{n}"), F.col(org).alias(f"_org{n}"), F.col("new_cus_idt").alias(f"_new{n}")
        )

    first, second = hop(1), hop(2)
    out = fact.join(first, (fact[customer] == first["_old1"]) & (fact[org] == first["_org1"]), "left")
    out = out.withColumn("_hop1", F.when(F.col("_old1").isNotNull(), F.col("_new1")).otherwise(F.col(customer)))
    out = out.join(second, (out["_hop1"] == second["_old2"]) & (out[org] == second["_org2"]), "left")
    out = out.withColumn("cliente", F.coalesce("_new2", "_hop1"))
    out = out.withColumn("cliente_id", F.concat(F.lit(prefix), F.col("cliente")))
    return out.drop("_old1", "_org1", "_new1", "_hop1", "_old2", "_org2", "_new2")


# --- matching ----------------------------------------------------------------------------------


def cascade_match(products: DataFrame, items: DataFrame) -> DataFrame:
    """Match store products to bar codes: by internal id, then the rest by import id, then none.

    Products carry (int_id, import_id, so_name, so_brand). Each tier is an equi-join on a bar-code
    table unique per code; leftovers go on by null test of the same join, so products are read once
    per tier and never collected.
    """
    bridge = min_per_key(items.filter(F.trim("sku_ean_cod") != ""), "sku_ean_cod", ["mat_idt", "mat_lcl_dsc"])

    def side(n: int) -> DataFrame:
        return bridge.select(
            F.col("sku_ean_cod").alias(f"_ean{n}"), F.col("mat_idt").alias(f"_mat{n}"), F.col("mat_lcl_dsc").alias(f"_dsc{n}")
        )

    one, two = side(1), side(2)
    out = products.join(one, products["int_id"] == one["_ean1"], "left")
    # The second key is NULL for rows that tier one matched, so they cannot match again.
    out = out.withColumn("_second", F.when(F.col("_ean1").isNull(), F.col("import_id")))
    out = out.join(two, out["_second"] == two["_ean2"], "left")
    tier = F.when(F.col("_ean1").isNotNull(), 1).when(F.col("_ean2").isNotNull(), 2).otherwise(3)
    return out.select(
        *products.columns,
        F.coalesce("_ean1", "_ean2").alias("sku_ean_cod"),
        F.coalesce("_mat1", "_mat2").alias("mat_idt"),
        F.coalesce("_dsc1", "_dsc2").alias("si_description"),
        tier.alias("match_priority"),
        F.when(tier == 1, "EXACT_INT_ID").when(tier == 2, "EXACT_IMPORT_ID").otherwise("UNMATCHED").alias("match_method"),
        F.when(tier == 1, 1.0).when(tier == 2, 0.9).otherwise(0.0).alias("match_confidence"),
        F.when(tier == 3, "NEEDS_REVIEW").otherwise("CONFIRMED").alias("review_status"),
    )


def name_brand_match(unmatched: DataFrame, items: DataFrame) -> DataFrame:
    """Third tier: exact name and brand. A proposal for review, never a confirmed match."""
    keyed = items.select(
        norm_key(F.col("mat_lcl_dsc")).alias("_name"), norm_key(F.col("brand")).alias("_brand"), "mat_idt"
    )
    best = keyed.groupBy("_name", "_brand").agg(F.min("mat_idt").alias("proposed_mat_idt"))
    on = (norm_key(unmatched["so_name"]) == best["_name"]) & (norm_key(unmatched["so_brand"]) == best["_brand"])
    return unmatched.join(best, on, "inner").drop("_name", "_brand").withColumns(
        {"match_method": F.lit("NAME_BRAND"), "review_status": F.lit("NEEDS_REVIEW")}
    )


def unmatched_anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct left keys without a partner. A NULL key has no partner either, so it is listed."""
    keys = left.select(left_key).distinct()
    return keys.join(right, keys[left_key] == right[right_key], "left_anti")


def bridge_match_rate(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, by: Sequence[str]
) -> DataFrame:
    """Share of left rows whose key exists on the right, per group.

    Left rows are counted per (group, key) before the join, so the join sees distinct keys only.
    """
    counted = left.groupBy(*by, left_key).agg(F.count("*").alias("_n"))
    keys = right.select(F.col(right_key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    joined = counted.join(keys, counted[left_key] == keys["_key"], "left")
    matched = F.sum(F.when(F.col("_key").isNotNull(), F.col("_n")).otherwise(0))
    return joined.groupBy(*by).agg(
        F.sum("_n").alias("total_rows"),
        matched.alias("matched_rows"),
        (matched / F.sum("_n") * 100).alias("match_pct"),
    )


def single_row_cross_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side. The right row comes as a scalar subquery, which fails
    when there is more than one row."""
    row = right.select(F.struct(*right.columns)).scalar()
    return left.withColumns({c: row.getField(c) for c in right.columns})


def wape_actuals_join(forecast: DataFrame, actuals: DataFrame, keys: Sequence[str], keep_unjudged: bool = False) -> DataFrame:
    """Official forecast rows with reportable, positive actuals. With keep_unjudged all forecast rows stay, and is_judged
    marks those."""
    real = actuals.filter(F.col("is_reportable") & (F.col("actual_units") > 0))
    if keep_unjudged:
        judged = F.coalesce(F.col("is_official_version") & F.col("is_reportable"), F.lit(False))
        return forecast.join(real, list(keys), "left").withColumn("is_judged", judged)
    return forecast.filter(F.col("is_official_version")).join(real, list(keys), "inner")
