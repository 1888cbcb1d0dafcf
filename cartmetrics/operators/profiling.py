"""Profiles of tables and columns.

Every column is counted value by value, in its own type and whatever its number of values. A caller that names a bound
gets estimates instead: one scan sums up rows, NULLs and a distinct-count sketch, which merge without shuffling values,
and only columns that the sketch finds to have few values are then counted value by value; of the others, keys mostly,
only the rows of the heaviest hash buckets are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import safe_divide
from cartmetrics.operators.series import temporal_gaps


#: Hash buckets that a column's values are counted in, and the heaviest of them whose values are told apart.
BUCKETS, HEAVY = 65_536, 64
#: A distinct-count sketch has 2^12 registers and a standard error of 1.6 %; five errors are taken as its range.
SKETCH_BITS = 12
SKETCH_SPREAD = 5 * 1.04 / 2 ** (SKETCH_BITS / 2)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n_rows) with values as text. For columns with few distinct values: every value is shuffled,
    once per task that has it."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))


def whole_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n_rows) as value_counts has them, at any number of distinct values: each column is grouped
    in its own type, and only distinct values become text."""
    parts = [
        df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n_rows"))
        .select(F.lit(c).alias("column_name"), F.col("value").cast("string").alias("value"), "n_rows")
        for c in columns
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def heavy_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n_rows) of the values in the HEAVY most frequent of BUCKETS hash buckets of each column.

    Counts are exact. A value with more rows than the lightest kept bucket can't be missing; of a column whose values
    are all rare, some of the values come back. Buckets are counted first, values of the others are never shuffled.
    """
    bucket = {c: F.pmod(F.xxhash64(F.col(c), F.isnull(c)), F.lit(BUCKETS)).cast("int") for c in columns}
    cells = [F.struct(F.lit(c).alias("column_name"), bucket[c].alias("value")) for c in columns]
    sizes = df.select(F.inline(F.array(*cells))).groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
    kept: dict[str, list[int]] = {c: [] for c in columns}
    for r in _top(sizes, HEAVY).collect():
        kept[r["column_name"]].append(r["value"])
    cells = [
        F.when(bucket[c].isin(*kept[c]), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
        for c in columns if kept[c]
    ]
    if not cells:
        return value_counts(df.limit(0), columns)
    found = df.select(F.inline(F.array_compact(F.array(*cells))))
    return found.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))


def _top(counts: DataFrame, n: int) -> DataFrame:
    """Rank of the n most frequent values per column. The rank filter lets Spark cut each task to n
    rows per column before the shuffle, so no task gets all values of a column."""
    order = W.partitionBy("column_name").orderBy(F.desc("n_rows"), F.asc_nulls_last("value"))
    return counts.withColumn("value_rank", F.row_number().over(order)).filter(F.col("value_rank") <= n)


def column_summaries(df: DataFrame, columns: Sequence[str], exact_up_to: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Summaries, value counts, and the names of the columns whose counts are whole.

    Summaries: column_name, total_rows, null_rows, distinct_count (NULL is a value) and distinct_is_exact. All columns are
    counted whole, unless exact_up_to is given: then value counts are whole for columns with at most so many values, from
    which their exact distinct counts come, too, and heavy_value_counts for the others, whose distinct count is the
    estimate of a sketch. Rows, NULLs and sketches are from one scan, which returns one row of numbers to the driver.
    """
    if exact_up_to is None:
        counts = whole_value_counts(df, columns)
        filled = F.col("value").isNotNull()
        sums = counts.groupBy("column_name").agg(
            F.sum("n_rows").alias("total_rows"), F.sum(F.when(filled, 0).otherwise(F.col("n_rows"))).alias("null_rows"), F.count("*").alias("distinct_count")
        )
        names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
        zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        out = names.join(sums, "column_name", "left").select("column_name", zero("total_rows"), zero("null_rows"), zero("distinct_count"), F.lit(True).alias("distinct_is_exact"))
        return out, counts, list(columns)
    sketch = lambda c: F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), F.lit(SKETCH_BITS))
    facts = [x for i, c in enumerate(columns) for x in (F.count(c).alias(f"n{i}"), F.coalesce(F.hll_sketch_estimate(sketch(c)), F.lit(0)).alias(f"d{i}"))]
    row = df.agg(F.count("*").alias("rows"), *facts).first()
    few = [c for i, c in enumerate(columns) if row[f"d{i}"] <= exact_up_to]
    many = [c for c in columns if c not in few]
    frames = ([value_counts(df, few)] if few else []) + ([heavy_value_counts(df, many)] if many else [])
    counts = reduce(lambda a, b: a.unionByName(b), frames)
    known = [(c, row["rows"], row["rows"] - row[f"n{i}"], min(int(row[f"d{i}"]), row[f"n{i}"]) + (row["rows"] > row[f"n{i}"]), c in few) for i, c in enumerate(columns)]
    out = df.sparkSession.createDataFrame(known, "column_name string, total_rows long, null_rows long, _sketched long, distinct_is_exact boolean")
    if few:
        exact = frames[0].groupBy("column_name").agg(F.count("*").alias("_exact"))
        out = out.join(exact, "column_name", "left").withColumn("_sketched", F.when(F.col("distinct_is_exact"), F.coalesce("_exact", F.lit(0))).otherwise(F.col("_sketched")))
    return out.select("column_name", "total_rows", "null_rows", F.col("_sketched").alias("distinct_count"), "distinct_is_exact"), counts, few


# Column names that mark a shared dimension.
DIMENSION_KEYWORDS = {
    "DIM_PRODUCT": (
        "upc", "sku", "int_id", "cbu_code", "descripcion", "marca", "product_id", "cod_producto", "ean", "gtin",
    ),
    "DIM_CUSTOMER": (
        "cadena", "chain", "subchain", "format", "canal", "customer_id", "cliente", "retailer", "store_id", "tienda",
    ),
    "DIM_DATE": (
        "fecha", "fecha_proceso", "fecha_venta", "fecha_cierre", "day_id", "anio", "mes", "year_id", "dt", "date",
        "week", "semana", "periodo", "period", "year", "month",
    ),
    "DIM_BRAND": ("marca", "brand", "categoria", "subcategoria", "category", "subcategory", "negocio", "business"),
    "DIM_MARKETING": (
        "campana", "campaign", "medio", "media", "plataforma", "platform", "objetivo", "objective", "formato",
    ),
}


def dimension_class(name: Column, keywords: Mapping[str, Sequence[str]] = DIMENSION_KEYWORDS) -> Column:
    """First dimension whose keyword list holds the column name."""
    chain = reduce(lambda e, kv: e.when(F.lower(name).isin(*kv[1]), kv[0]), keywords.items(), F)
    return chain.otherwise("FACT / MEASURE")


def null_flag(pct: Column) -> Column:
    return F.when(pct > 5, "HIGH").when(pct > 1, "WARN").otherwise("OK")


def column_inventory(
    df: DataFrame, dataset: str, columns: Sequence[str], glossary: Sequence[str] = (),
    keywords: Mapping[str, Sequence[str]] = DIMENSION_KEYWORDS, top: int = 5, exact_up_to: int | None = None,
    confirm_keys: bool = False,
) -> DataFrame:
    """One row per column: type, NULLs, distinct values, key candidate, top values, dimension.

    Every column is counted value by value, and all that is returned is exact. If exact_up_to is given, columns with more
    values have estimated distinct counts (see column_summaries), and one whose estimate reaches the number of rows is a
    key candidate; with confirm_keys these columns, and no others, are counted value by value.
    """
    per_column, counts, few = column_summaries(df, columns, exact_up_to)
    filled = F.col("null_rows") == 0
    unique = filled & (F.col("distinct_count") == F.col("total_rows"))
    near = filled & (F.col("distinct_count") >= F.col("total_rows") * (1 - SKETCH_SPREAD))
    is_key = F.when(F.col("distinct_is_exact"), unique).otherwise(near)
    if confirm_keys:
        open_keys = [r["column_name"] for r in per_column.filter(~F.col("distinct_is_exact") & near).collect()]
        for c in open_keys:
            exact = df.groupBy(c).agg(F.lit(1)).agg(F.count("*")).scalar()
            per_column = per_column.withColumns(
                {
                    "distinct_count": F.when(F.col("column_name") == c, exact).otherwise(F.col("distinct_count")),
                    "distinct_is_exact": F.col("distinct_is_exact") | (F.col("column_name") == c),
                }
            )
    samples = _top(counts.filter(F.col("value").isNotNull()), top).groupBy("column_name").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("value_rank", "value"))), lambda v: v["value"]), " | ")
        .alias("sample_values")
    )
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    type_of = reduce(lambda e, c: e.when(F.col("column_name") == c, types[c]), columns, F)
    null_pct = safe_divide(F.col("null_rows") * 100.0, F.col("total_rows"), 0.0)
    known = F.upper("column_name").isin(*[g.upper() for g in glossary]) if glossary else F.lit(False)
    return per_column.join(samples, "column_name", "left").select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        type_of.alias("data_type"),
        "total_rows",
        "null_rows",
        null_pct.alias("null_pct"),
        null_flag(null_pct).alias("null_flag"),
        "distinct_count",
        "distinct_is_exact",
        is_key.alias("is_pk_candidate"),
        "sample_values",
        dimension_class(F.col("column_name"), keywords).alias("dimension_class"),
        known.alias("in_glossary"),
    )


def domain_profile(df: DataFrame, dataset: str, keys: Sequence[str], top: int, exact_up_to: int | None = None) -> DataFrame:
    """Most frequent values of every business key with their share of all rows.

    Counts are exact, and all values of a key are ranked. If exact_up_to is given, a key with more values lists those of
    its heaviest hash buckets only (see heavy_value_counts), which hold every value that is frequent.
    """
    summaries, counts, _ = column_summaries(df, keys, exact_up_to)
    rows = _top(counts, top).join(summaries.select("column_name", "total_rows"), "column_name")
    return rows.select(
        F.lit(dataset).alias("dataset"),
        "column_name",
        F.coalesce("value", F.lit("(null)")).alias("value"),
        F.col("n_rows").alias("frequency"),
        safe_divide(F.col("n_rows") * 100.0, F.col("total_rows")).alias("coverage_pct"),
    )


def temporal_profile(df: DataFrame, dataset: str, raw: str, date: Column) -> DataFrame:
    """Range and number of dates, values that did not parse, and gaps of more than two weeks."""
    dated = df.select(F.col(raw).alias("_raw"), date.alias("_date"))
    stats = dated.agg(
        F.min("_date").alias("date_min"),
        F.max("_date").alias("date_max"),
        F.count_distinct("_date").alias("distinct_dates"),
        F.count_if(F.col("_date").isNull() & F.col("_raw").isNotNull()).alias("failed_casts"),
    )
    gaps = temporal_gaps(dated, "_date").agg(F.count("*")).scalar()
    return stats.select(F.lit(dataset).alias("dataset"), "*", gaps.alias("temporal_gaps"))


def uniqueness_class(pct: Column) -> Column:
    return F.when(pct >= 100, "PERFECT").when(pct >= 95, "HIGH").when(pct >= 80, "MEDIUM").otherwise("LOW")


#: Combinations of one scan of sketches and of one exact count. A combination is left to its sketch only if five
#: standard errors on either side can't make it the best.
SKETCH_BATCH, EXACT_BATCH = 256, 16


def _sketched_rows(df: DataFrame, combos: Sequence[tuple[str, ...]]) -> list[int]:
    """Estimated distinct rows of each combination: one scan fills a sketch for each, with nothing to shuffle but these."""

    def sketch(combo: tuple[str, ...]) -> Column:
        key = F.xxhash64(*combo, *[F.isnull(c) for c in combo])
        return F.hll_sketch_estimate(F.hll_sketch_agg(key, F.lit(SKETCH_BITS)))

    out: list[int] = []
    for at in range(0, len(combos), SKETCH_BATCH):
        part = combos[at : at + SKETCH_BATCH]
        out += df.agg(*[F.coalesce(sketch(c), F.lit(0)).alias(f"s{i}") for i, c in enumerate(part)]).first()
    return out


def combination_counts(df: DataFrame, combos: Sequence[tuple[str, ...]]) -> DataFrame:
    """(i, distinct_rows, total_rows) of each combination, exact. Each is grouped by itself over its own columns: no row
    is copied per combination, and a task holds the groups of one combination in its share of the rows, no more."""
    parts = [
        df.groupBy(*combo).agg(F.count("*").alias("_n"))
        .agg(F.lit(i).alias("i"), F.count("*").alias("distinct_rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"))
        for i, combo in enumerate(combos)
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _distinct_rows(df: DataFrame, combos: Sequence[tuple[str, ...]]) -> list[tuple[int, int]]:
    """(distinct rows, rows) of each combination, exact."""
    found = combination_counts(df, combos).collect() if combos else []
    return [(r["distinct_rows"], r["total_rows"]) for r in sorted(found, key=lambda r: r["i"])]


def grain_detection(
    df: DataFrame, dataset: str, declared: Sequence[str], pool: Sequence[str], max_size: int = 5, every: bool = False
) -> DataFrame:
    """Uniqueness of the declared grain and, if that is not perfect, of combinations of up to max_size columns.

    The search climbs level by level, smallest combinations first, whether or not a perfect one exists, and ends when
    a level reaches the distinct rows of all columns together, which no combination can exceed. Each level takes one
    scan, which fills a distinct-count sketch per combination. Exact counts follow, in the order of the combinations,
    for those that can still be the level's best by their sketch. Supersets of the declared grain are left out, and
    so are combinations whose columns' distinct values multiply to no more than the best so far. With `every` none is
    left out or left to a sketch but supersets of the declared grain: all are counted exactly, level by level, up to the
    first perfect one, whose followers are not reported.

    Rows: the declared grain, and every combination tried. distinct_rows is exact where is_exact, else the sketch's
    estimate; only exact rows can be PERFECT. best_of_size marks the first combination with the most distinct rows
    of its size, if these are more than those of all smaller ones; is_best the best of all. NULL counts as a value.
    An empty table has no distinct rows; its grain is then perfect as declared.
    """
    candidates = list(dict.fromkeys([*declared, *pool]))
    most, total = _distinct_rows(df, [tuple(declared if every and declared else candidates)])[0]
    found: list[dict] = []

    def report(source: str, combo: tuple[str, ...], distinct: int, exact: bool) -> None:
        found.append({"source": source, "combo": combo, "distinct": min(distinct, total), "exact": exact, "first": False})

    if declared:
        report("DECLARED", tuple(declared), most if every else _distinct_rows(df, [tuple(declared)])[0][0], True)
    best, singles = -1, {}
    for size in range(1, min(max_size, len(candidates)) + 1):
        if best == (total if every else most) or (found and found[0]["source"] == "DECLARED" and found[0]["distinct"] == total):
            break
        level = [c for c in combinations(candidates, size) if not (declared and set(declared) <= set(c))]
        if every:
            counts: list[int] = []
            for at in range(0, len(level), EXACT_BATCH):
                counts += [d for d, _ in _distinct_rows(df, level[at : at + EXACT_BATCH])]
                if total in counts:
                    counts = counts[: counts.index(total) + 1]
                    break
            for combo, distinct in zip(level, counts):  # noqa: B905
                report("AUTO", combo, distinct, True)
            if max(counts, default=-1) > best:
                best = max(counts)
                found[len(found) - len(counts) + counts.index(best)]["first"] = True
            continue
        level = [c for c in level if size == 1 or prod(singles[x] for x in c) * (1 + SKETCH_SPREAD) ** size > best]
        sketched = dict(zip(level, _sketched_rows(df, level), strict=True))
        singles |= {c[0]: max(n, 1) for c, n in sketched.items() if size == 1}
        top = max(sketched.values(), default=0) * (1 - SKETCH_SPREAD)
        finalists = [c for c in level if sketched[c] * (1 + SKETCH_SPREAD) >= max(top, best)]
        exact: dict[tuple[str, ...], int] = {}
        for at in range(0, len(finalists), EXACT_BATCH):
            part = finalists[at : at + EXACT_BATCH]
            exact |= {c: d for c, (d, _) in zip(part, _distinct_rows(df, part), strict=True)}
            if max(exact.values()) == most:
                break
        for combo in level:
            report("AUTO", combo, exact.get(combo, sketched[combo]), combo in exact)
        if exact and max(exact.values()) > best:
            best = max(exact.values())
            winner = next(c for c in finalists if exact.get(c) == best)
            next(f for f in found if f["source"] == "AUTO" and f["combo"] == winner)["first"] = True
    ranked = [i for i, f in enumerate(found) if f["source"] == "DECLARED" or f["first"]]
    top = max(ranked, key=lambda i: found[i]["distinct"], default=None)
    shift = 0 if declared else 1
    rows = [
        (i + shift, " x ".join(f["combo"]), len(f["combo"]), f["source"], f["distinct"], f["exact"], f["distinct"] * 100.0 / max(total, 1), f["first"], i == top)
        for i, f in enumerate(found)
    ]
    out = df.sparkSession.createDataFrame(
        rows,
        "try_no int, candidate_grain string, combo_size int, source string, distinct_rows long, is_exact boolean, "
        "uniqueness_pct double, best_of_size boolean, is_best boolean",
    )
    grade = uniqueness_class(F.when(~F.col("is_exact"), F.least("uniqueness_pct", F.lit(99.0))).otherwise(F.col("uniqueness_pct")))
    return out.select(
        F.lit(dataset).alias("dataset"), "try_no", "candidate_grain", "combo_size", "source", "distinct_rows", "is_exact",
        "uniqueness_pct", grade.alias("confidence"), "best_of_size", "is_best",
    )


def numeric_profile(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    stats = {
        "min_value": lambda c: F.min(c),
        "max_value": lambda c: F.max(c),
        "sum_value": lambda c: F.sum(c),
        "mean_value": lambda c: F.avg(c),
        "negative_rows": lambda c: F.count_if(F.col(c) < 0),
        "zero_rows": lambda c: F.count_if(F.col(c) == 0),
    }
    wide = df.agg(*[f(c).alias(f"{s}__{i}") for i, c in enumerate(columns) for s, f in stats.items()])
    kinds = {s: "long" if s.endswith("rows") else "double" for s in stats}
    rows = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(c).alias("column_name"),
            *[F.col(f"{s}__{i}").cast(kinds[s]).alias(s) for s in stats],
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def duplicate_profile(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows, from one count per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.lit(dataset).alias("dataset"),
        F.sum("_n").alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        (F.sum("_n") - F.count("*")).alias("duplicate_rows"),
    )


# --- readiness ---------------------------------------------------------------------------------


def readiness_score(profile: DataFrame) -> DataFrame:
    """Six dimensions (20 + 20 + 25 + 15 + 10 + 10 points) from one profile row per dataset.

    Columns: dataset, mandatory_rules, mandatory_failed, other_rules, other_passed, n_keys,
    key_null_pct, has_date, temporal_gaps, n_columns, n_documented, grain_uniqueness_pct.
    """
    c = F.col
    ten = safe_divide(c("n_documented") * 10.0, c("n_columns"), 0.0)
    parts = {
        "score_completeness": F.when(c("mandatory_rules") > 0, F.greatest(F.lit(0), 20 - 5 * c("mandatory_failed"))).otherwise(15),
        "score_consistency": F.when(c("other_rules") > 0, F.round(c("other_passed") / c("other_rules") * 20)).otherwise(10),
        "score_joinability": F.when(
            c("n_keys") > 0, F.greatest(F.lit(0.0), F.round(25 - c("key_null_pct") / 4))
        ).otherwise(5),
        "score_temporal": F.when(~c("has_date"), 0)
        .when(c("temporal_gaps") == 0, 15)
        .otherwise(F.greatest(F.lit(5), 15 - 2 * c("temporal_gaps"))),
        "score_documentation": F.round(ten),
        "score_grain": F.when(c("grain_uniqueness_pct").isNull(), 0)
        .when(c("grain_uniqueness_pct") >= 100, 10)
        .when(c("grain_uniqueness_pct") >= 95, 8)
        .when(c("grain_uniqueness_pct") >= 80, 6)
        .otherwise(3),
    }
    out = profile.withColumns({k: v.cast("int") for k, v in parts.items()})
    return with_readiness_label(out)


def with_readiness_label(scores: DataFrame) -> DataFrame:
    names = ("completeness", "consistency", "joinability", "temporal", "documentation", "grain")
    total = reduce(lambda a, b: a + b, [F.col(f"score_{n}") for n in names])
    label = F.when(total >= 80, "ENTERPRISE READY").when(total >= 60, "CONDITIONAL").otherwise("NOT READY")
    return scores.withColumns({"enterprise_score": total, "readiness_label": label})


def readiness_score_live(scores: DataFrame, joins: DataFrame) -> DataFrame:
    """Joinability replaced by the mean live match rate of the joins a dataset takes part in."""
    live = joins.filter(F.col("method") == "LIVE")
    sides = live.select(F.col("dataset_a").alias("dataset"), "match_rate_pct").unionByName(
        live.select(F.col("dataset_b").alias("dataset"), "match_rate_pct")
    )
    mean = sides.groupBy("dataset").agg(F.avg("match_rate_pct").alias("_rate"))
    out = scores.join(mean, "dataset", "left")
    live_score = F.round(F.col("_rate") / 100 * 25).cast("int")
    out = out.withColumn("score_joinability", F.coalesce(live_score, F.col("score_joinability"))).drop("_rate")
    return with_readiness_label(out)


# --- relations between datasets ----------------------------------------------------------------

# Column names that need a conversion before they join.
TRANSFORM_KINDS = {
    "DATE_TRANSFORM": ("fecha", "day_id", "anio", "year_id"),
    "BUSINESS_MAPPING": ("cadena", "chain", "sku", "cbu_code", "int_id", "upc"),
}


def relationship_matrix(inventory: DataFrame, kinds: Mapping[str, Sequence[str]] = TRANSFORM_KINDS) -> DataFrame:
    """Columns that two datasets share by name, and what a join on them needs.

    The inventory has one row per dataset and column, so the self join is on metadata.
    """
    named = inventory.withColumn("column_normalized", F.lower(F.trim("column_name")))

    def side(letter: str) -> DataFrame:
        return named.select(
            "column_normalized",
            F.col("dataset").alias(f"dataset_{letter}"),
            F.col("null_pct").alias(f"null_pct_{letter}"),
            F.col("distinct_count").alias(f"distinct_{letter}"),
        )

    pairs = side("a").join(side("b"), "column_normalized").filter(F.col("dataset_a") < F.col("dataset_b"))
    kind = reduce(lambda e, kv: e.when(F.col("column_normalized").isin(*kv[1]), kv[0]), kinds.items(), F).otherwise("DIRECT")
    advice = (
        F.when(F.col("match_type") == "DIRECT", "JOIN READY")
        .when(F.col("match_type") == "DATE_TRANSFORM", "TRANSFORM NEEDED")
        .otherwise("HOMOLOGATION NEEDED")
    )
    return pairs.withColumn("match_type", kind).withColumn("join_recommendation", advice)


def join_validation_report(
    key: str, a: tuple[str, DataFrame, str], b: tuple[str, DataFrame, str], max_unmatched_pct: float = 20.0
) -> DataFrame:
    """Live match rate of one shared key between two datasets given as (name, rows, column)."""
    (name_a, df_a, col_a), (name_b, df_b, col_b) = a, b
    left = df_a.select(F.col(col_a).alias("_a")).filter(F.col("_a").isNotNull()).distinct()
    right = df_b.select(F.col(col_b).alias("_b")).filter(F.col("_b").isNotNull()).distinct()
    counts = left.join(right, F.col("_a") == F.col("_b"), "left").agg(
        F.count("*").alias("left_count"), F.count("_b").alias("matched_count")
    )
    rate = safe_divide(F.col("matched_count") * 100.0, F.col("left_count"), 0.0)
    return counts.select(
        F.lit(key.upper()).alias("join_key"),
        F.lit(name_a).alias("dataset_a"), F.lit(col_a).alias("column_a"),
        F.lit(name_b).alias("dataset_b"), F.lit(col_b).alias("column_b"),
        "left_count", "matched_count",
        rate.alias("match_rate_pct"),
        (100 - rate).alias("unmatched_pct"),
        F.when(100 - rate <= max_unmatched_pct, "PASS").otherwise("FAIL").alias("status"),
        F.lit("LIVE").alias("method"),
    )


def join_estimate_report(matrix: DataFrame) -> DataFrame:
    """Match rates estimated from distinct counts, for datasets that cannot be read live."""
    matched = F.least("distinct_a", "distinct_b")
    rate = safe_divide(matched * 100.0, F.col("distinct_a"), 0.0)
    return matrix.select(
        F.upper("column_normalized").alias("join_key"), "dataset_a", "dataset_b",
        F.col("distinct_a").alias("left_count"), matched.alias("matched_count"),
        rate.alias("match_rate_pct"), (100 - rate).alias("unmatched_pct"),
        F.lit("ESTIMATED").alias("status"), F.lit("CARDINALITY_ESTIMATE").alias("method"),
    )


def dimension_candidates(
    inventory: DataFrame, business_keys: Sequence[str], keywords: Mapping[str, Sequence[str]] = DIMENSION_KEYWORDS
) -> DataFrame:
    """Columns that can feed a dimension, once per dimension, with their likely role."""
    name = F.lower("column_name")
    hits = F.array_compact(F.array(*[F.when(name.isin(*words), dim) for dim, words in keywords.items()]))
    role = (
        F.when(F.col("is_pk_candidate"), "PRIMARY KEY")
        .when(name.isin(*[k.lower() for k in business_keys]), "FOREIGN KEY")
        .otherwise("ATTRIBUTE")
    )
    return inventory.select(
        F.explode(hits).alias("target_dimension"), name.alias("column_normalized"), "dataset", "null_pct",
        "distinct_count", "is_pk_candidate", role.alias("suggested_role"),
    )


def glossary_report(inventory: DataFrame, glossary: DataFrame) -> DataFrame:
    """Every column name with its datasets and whether the glossary (column_name, business_name)
    documents it."""
    names = inventory.groupBy(F.upper("column_name").alias("column_name")).agg(
        F.array_join(F.array_sort(F.collect_set("dataset")), ", ").alias("datasets"),
        F.count_distinct("dataset").alias("n_datasets"),
    )
    known = glossary.groupBy(F.upper(F.trim("column_name")).alias("column_name")).agg(F.min("business_name").alias("_name"))
    return names.join(known, "column_name", "left").select(
        "column_name",
        "datasets",
        "n_datasets",
        F.coalesce("_name", F.lit("[TO BE DEFINED]")).alias("business_name"),
        F.when(F.col("_name").isNotNull(), "DOCUMENTED").otherwise("TO BE DEFINED").alias("documentation_status"),
    )


# --- column scores -----------------------------------------------------------------------------


def d1_score(null_pct: Column, distinct: Column) -> Column:
    """Filled and diverse columns score high."""
    return F.round((1 - null_pct / 100) * F.log1p(distinct), 4)


def cardinality_class(distinct: Column, channel_max: int = 15, chain_max: int = 200) -> Column:
    return (
        F.when(distinct <= channel_max, "CHANNEL_LIKE").when(distinct <= chain_max, "CHAIN_LIKE").otherwise("TOO_GRANULAR")
    )


def column_scores(df: DataFrame, source: str, columns: Sequence[str]) -> DataFrame:
    """Null share, distinct values (NULL is none), score and class of candidate columns; see column_summaries."""
    per_column, _, _ = column_summaries(df, columns)
    values = F.col("distinct_count") - (F.col("null_rows") > 0).cast("long")
    null_pct = safe_divide(F.col("null_rows") * 100.0, F.col("total_rows"), 0.0)
    return per_column.withColumn("distinct_count", values).select(
        F.lit(source).alias("source"), "column_name", "total_rows", null_pct.alias("null_pct"), "distinct_count",
        d1_score(null_pct, F.col("distinct_count")).alias("d1_score"),
        cardinality_class(F.col("distinct_count")).alias("cardinality_class"),
    )


def hierarchy_profile(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    return df.groupBy(*levels).agg(F.count("*").alias("n_rows"))
