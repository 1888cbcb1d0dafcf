"""Joins, standardization, series, models, catalogs and sinks on small frames."""

from __future__ import annotations

import datetime as dt
import itertools
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartmetrics.functions import labels
from cartmetrics.functions import scalars
from cartmetrics.operators import catalogs, joins, kpi, models, profiling, quality_aggs, series, sets, std
from cartmetrics.sources import readers, sinks
from cartmetrics.streaming.ingest import stream_checkpoint, stream_csv_ingest


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def day(text):
    return dt.date.fromisoformat(text)


# --- joins -------------------------------------------------------------------------------------


def test_mapping_join_keeps_rows_with_duplicate_mapping(spark):
    fact = spark.createDataFrame([(" a ", 1), ("A", 2), ("b", 3), (None, 4)], "k string, n int")
    mapping = spark.createDataFrame([("a", "first"), ("A ", "second"), ("c", "x"), (None, "null")], "key string, label string")
    out = joins.mapping_left_join(fact, mapping, "k", "key", ["label"], on_conflict="first")
    assert rows(out.select("n", "label"), "n") == [(1, "first"), (2, "first"), (3, None), (4, None)]
    with pytest.raises(Exception, match="conflicting rows for key A"):
        joins.mapping_left_join(fact, mapping, "k", "key", ["label"]).collect()
    with pytest.raises(ValueError):
        joins.mapping_left_join(fact.withColumn("label", F.lit(1)), mapping, "k", "key", ["label"])


def test_customer_chain_goes_two_hops_only_inside_the_organisation(spark):
    dictionary = spark.createDataFrame(
        [("A", "B", "1"), ("B", "C", "1"), ("C", "D", "1"), ("X", "X", "1"), ("B", "Z", "1"), ("A", "Q", "2")],
        "old_cus_idt string, new_cus_idt string, sal_org_cod string",
    )
    fact = spark.createDataFrame([("A", "1"), ("A", "2"), ("X", "1"), ("N", "1")], "cus string, sal_org_cod string")
    out = joins.two_hop_customer_harmonization(fact, dictionary, "cus", prefix="00")
    assert rows(out.select("cus", "sal_org_cod", "cliente", "cliente_id"), "cus", "sal_org_cod") == [
        ("A", "1", "C", "00C"),
        ("A", "2", "Q", "00Q"),
        ("N", "1", "N", "00N"),
        ("X", "1", "X", "00X"),
    ]


def test_cascade_takes_the_first_tier(spark):
    items = spark.createDataFrame(
        [("m2", "E1", "two"), ("m1", "E1", "one"), ("m3", "E3", "three"), ("m4", None, "four"), ("m5", " ", "five")],
        "mat_idt string, sku_ean_cod string, mat_lcl_dsc string",
    )
    products = spark.createDataFrame(
        [("E1", "E3", "n1", "b"), ("X", "E3", "n2", "b"), ("X2", "E9", "n3", "b"), (None, None, "n4", "b")],
        "int_id string, import_id string, so_name string, so_brand string",
    )
    out = joins.cascade_match(products, items).select("so_name", "mat_idt", "match_priority", "match_confidence", "review_status")
    assert rows(out, "so_name") == [
        ("n1", "m1", 1, 1.0, "CONFIRMED"),
        ("n2", "m3", 2, 0.9, "CONFIRMED"),
        ("n3", None, 3, 0.0, "NEEDS_REVIEW"),
        ("n4", None, 3, 0.0, "NEEDS_REVIEW"),
    ]


def test_first_row_dedup_on_a_hot_key(spark):
    hot = spark.range(20000).select(F.lit("hot").alias("k"), (20000 - F.col("id")).alias("v"), F.col("id").alias("w"))
    one = joins.first_row_dedup(hot.unionByName(spark.createDataFrame([("cold", 5, 6)], "k string, v long, w long")), ["k"], [F.col("v")])
    assert rows(one, "k") == [("cold", 5, 6), ("hot", 1, 19999)]


# --- standardization ---------------------------------------------------------------------------


def test_crosswalk_first_canonical_wins(spark):
    data = {"own": {"ALPHA": {"variants": ["alpha fs", "DAIRY"]}}, "special": {"_MULTI": {"variants": ["DAIRY", "Alpha FS"]}}}
    listed = readers.crosswalk_rows(data, {"own": "OWN", "special": "NONE"})
    frame = readers.config_frame(spark, listed, "variant string, canonical string, owner string, priority int")
    raw = spark.createDataFrame([("dairy",), (" Alpha FS ",), ("new one",), (None,)], "marca string")
    out = std.brand_std(raw, "marca", frame)
    assert set(rows(out.select("marca", "marca_std"))) == {
        ("dairy", "ALPHA"), (" Alpha FS ", "ALPHA"), ("new one", "NEW ONE"), (None, None),
    }
    with pytest.raises(ValueError):
        readers.crosswalk_rows({}, {"own": "OWN"})


@pytest.mark.parametrize(
    "label,level,channel,region_type,region,detail",
    [
        ("TOTAL MEXICO AUTOSERVICIOS SCANNING", "TOTAL", "AUTOSERVICIO_SCANNING", "NATIONAL", "TOTAL_MEXICO", None),
        ("CANAL TRADICIONAL AREA 2.1", "DETAIL", "TRADICIONAL", "AREA", "AREA_2", "AREA_2_1_CONTINENTAL"),
        ("MODERNO AREA 10", "DETAIL", "MODERNO_TOTAL", "AREA", "AREA 10", None),
        ("MODERNO AREA 1_MT", "DETAIL", "MODERNO_TOTAL", "AREA", "AREA_1", None),
        ("PROXIMIDAD VDM ZONA II", "DETAIL", "PROXIMIDAD", "VDM", "VDM", "VDM_ZONA_2"),
        ("PROXIMIDAD VDM ZONA IV", "DETAIL", "PROXIMIDAD", "VDM", "VDM", "VDM_ZONA_4"),
        ("AUTOS SCANNING  GUADALAJARA.", "DETAIL", "AUTOSERVICIO_SCANNING", "CITY", "GUADALAJARA", None),
        ("C. PROXIMIDAD AREAS 3 + 4 + 5 + 6", "TOTAL", "PROXIMIDAD", "AREA", "AREA_3_6", None),
        ("SOMEWHERE", "DETAIL", "SIN_CLASIFICAR", "CITY", "SOMEWHERE", None),
    ],
)
def test_market_labels(spark, label, level, channel, region_type, region, detail):
    out = std.market_label_columns(spark.createDataFrame([(label,)], "m string"), "m").first()
    got = (out["agg_level"], out["canal_lvl2"], out["region_type"], out["region_std"], out["region_detail"])
    assert got == (level, channel, region_type, region, detail)


def test_suffix_is_only_removed_at_the_end(spark):
    out = spark.createDataFrame([("A_MTX B_MT",)], "m string").select(labels.clean_market_label(F.col("m"))).first()[0]
    assert out == "A MTX B"


def test_scenarios_cannot_be_added_up(spark):
    plan = spark.createDataFrame([("ACTUAL", 1.0), ("IBP_FORECAST", 2.0)], "scenario string, valor double")
    with pytest.raises(ValueError):
        std.scenario_guard(plan, "scenario", [], ["valor"])
    assert len(rows(std.scenario_guard(plan, "scenario", ["scenario"], ["valor"]))) == 2


def test_not_in_drops_null_codes(spark):
    df = spark.createDataFrame([("ZINT",), ("OK",), (None,)], "code string")
    assert rows(std.code_exclusion_filter(df, {"code": ["ZINT"]})) == [("OK",)]


def test_missing_contract_column(spark):
    with pytest.raises(ValueError, match="b"):
        std.select_contract_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


# --- KPI ---------------------------------------------------------------------------------------


def test_distinct_products_are_not_added_up(spark):
    std_rows = spark.createDataFrame(
        [(day("2024-01-01"), "B", "C", u, "S1", 10.0, 2.0, 1.0) for u in ("W", "E")] + [(day("2024-01-01"), None, "C", "W", "S2", 9.0, 9.0, 9.0)],
        "fecha_month date, marca_std string, canal_std string, cbu string, sku_ean_cod string, revenue_mxn double, volume_liter double, volume_kgr double",
    )
    out = kpi.sell_in_kpi_master(std_rows).first()
    assert (out["si_sku_count"], out["si_sku_count_by_cbu"], out["si_revenue_mxn"], out["si_avg_price_mxn_per_litre"]) == (1, 2, 20.0, 5.0)


def test_metric_aliases_fill_in(spark):
    facts = spark.createDataFrame([("a", "NUM_DIST", 5.0), ("b", "NUMERIC_DISTRIBUTION", 7.0), ("b", "NUM_DIST", 1.0)], "k string, metric_name string, metric_value double")
    out = kpi.metric_pivot(facts, ["k"])
    assert rows(out.select("k", "nls_numeric_dist", "nls_units"), "k") == [("a", 5.0, None), ("b", 7.0, None)]


def test_metrics_without_a_kpi_are_kept(spark):
    facts = spark.createDataFrame([("a", "U", 2.0), ("a", "NEW METRIC", 3.0), ("b", None, 4.0)], "k string, metric_name string, metric_value double")
    out = kpi.metric_pivot(facts, ["k"])
    assert rows(out.select("k", "nls_units", F.col("other_metrics")["NEW METRIC"]), "k") == [("a", 2.0, 3.0), ("b", None, None)]
    warned = kpi.unmapped_metrics(facts).collect()
    assert [(r["check_id"], r["metric"], r["status"]) for r in warned] == [("W3_unmapped_metric:NEW METRIC", 1.0, "WARNING")]


def test_master_refuses_samples(spark):
    one = spark.range(1)
    with pytest.raises(ValueError):
        kpi.kpi_master_join(one, one, one, one, input_mode="SAMPLE")


# --- series and models -------------------------------------------------------------------------


def weekly(spark, values, key="k"):
    start = day("2024-01-01")
    data = [(key, start + dt.timedelta(weeks=w), float(v)) for w, v in values]
    return spark.createDataFrame(data, "key string, week_start date, spend double")


def test_adstock_decays_over_missing_weeks(spark):
    out = series.adstock(weekly(spark, [(0, 100), (1, 0), (4, 10)]), ["key"], "week_start", "spend", 0.5)
    assert [round(r["adstock"], 6) for r in out.orderBy("week_start").collect()] == [100.0, 50.0, 10 + 100 * 0.5**4]


def test_gaps_and_streaks(spark):
    gaps = series.temporal_gaps(weekly(spark, [(0, 1), (1, 1), (3, 1), (7, 1)]), "week_start")
    assert [r["gap_weeks"] for r in gaps.collect()] == [4]
    fva = spark.createDataFrame(
        [("k", p, f, a) for p, (f, a) in enumerate([(2.0, 1.0), (2.0, 1.0), (2.0, 1.0), (1.0, 1.0), (0.0, 1.0), (0.0, 1.0), (3.0, 1.0)])],
        "key string, p int, forecasted_units double, actual_units double",
    )
    out = series.consecutive_miss_streak(fva, ["key"], "p").orderBy("p").collect()
    assert [r["miss_streak"] for r in out] == [1, 2, 3, 0, 1, 2, 1]
    assert [r["forecast_review"] for r in out] == [False, False, True, False, False, False, False]


def test_growth_follows_the_calendar(spark):
    data = [("k", day("2023-01-01"), 10.0), ("k", day("2023-03-01"), 20.0), ("k", day("2024-01-01"), 15.0), ("k", day("2024-02-01"), 9.0)]
    out = series.growth_to_earlier(spark.createDataFrame(data, "key string, m date, v double"), ["key"], "m", "v")
    assert [r["growth"] for r in out.orderBy("m").collect()] == [None, None, 0.5, None]


def test_decay_fit_finds_the_decay(spark):
    rng = np.random.default_rng(1)
    spend = rng.integers(0, 100, 60).astype(float)
    stock = np.zeros(60)
    for i in range(60):
        stock[i] = spend[i] + (0.7 * stock[i - 1] if i else 0)
    start = day("2023-01-02")
    data = [("k", start + dt.timedelta(weeks=i), float(spend[i]), float(3 * stock[i] + 5)) for i in range(60)]
    df = spark.createDataFrame(data, "key string, w date, spend double, units double")
    out = models.adstock_decay_fit(df, ["key"], "w", "spend", "units").first()
    assert out["decay_rate"] == pytest.approx(0.7) and out["correlation"] == pytest.approx(1.0)


def test_decay_fit_without_variation_gives_no_row(spark):
    df = spark.createDataFrame([("k", day("2024-01-01"), 1.0, 1.0), ("k", day("2024-01-08"), 0.0, 1.0)], "key string, w date, spend double, units double")
    assert models.adstock_decay_fit(df, ["key"], "w", "spend", "units").count() == 0


def test_hill_fit_recovers_the_curve(spark):
    x = np.linspace(1, 200, 40)
    k = x.mean() * 0.5
    data = [("k", float(v), float(7 * v**2 / (k**2 + v**2))) for v in x]
    out = models.hill_fit(spark.createDataFrame(data, "key string, x double, y double"), ["key"], "x", "y").first()
    assert (out["hill_alpha"], round(out["hill_k"], 6), round(out["scale"], 6)) == (2.0, round(float(k), 6), 7.0)


def test_regression_matches_least_squares(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 6))
    y = 3 + x @ np.arange(1, 7) + rng.normal(scale=0.1, size=80)
    names = [f"f{i}" for i in range(6)]
    data = [("k", *map(float, x[i]), float(y[i])) for i in range(80)] + [("k", *[None] * 6, 1.0)]
    df = spark.createDataFrame(data, "key string, " + ", ".join(f"{n} double" for n in names) + ", y double")
    out = models.mmm_regression(df, ["key"], names, "y").first()
    want = np.linalg.lstsq(np.column_stack([np.ones(80), x]), y, rcond=None)[0]
    assert [out["intercept_coef"], *[out[f"{n}_coef"] for n in names]] == pytest.approx(list(want), rel=1e-6)
    assert (out["n_rows"], out["matrix_rank"]) == (80, 7) and out["r2"] > 0.99


# --- profiling, sets, catalogs -----------------------------------------------------------------


def test_grain_stops_at_the_first_perfect_combination(spark):
    df = spark.createDataFrame([(i // 4, i % 4, i % 2, None if i % 3 else i) for i in range(16)], "a int, b int, c int, d int")
    out = profiling.grain_detection(df, "T", [], ["a", "b", "c", "d"]).orderBy("try_no").collect()
    best = next(r for r in out if r["is_best"])
    assert (best["candidate_grain"], best["confidence"], best["is_exact"], best["distinct_rows"]) == ("a x b", "PERFECT", True, 16)
    # d has one value more than a third of the rows, NULL among them
    assert [r["candidate_grain"] for r in out if r["best_of_size"]] == ["d", "a x b"] and max(r["combo_size"] for r in out) == 2
    want = {"a": 4, "b": 4, "c": 2, "d": 7}
    assert {r["candidate_grain"]: r["distinct_rows"] for r in out if r["combo_size"] == 1} == want


def test_grain_beyond_many_columns(spark):
    names = [f"c{i}" for i in range(14)]
    df = spark.createDataFrame([(*[i % 2] * 13, i) for i in range(6)], ", ".join(f"{n} int" for n in names))
    out = profiling.grain_detection(df, "T", [], names).orderBy("try_no").collect()
    assert len(out) == 14 and (out[-1]["candidate_grain"], out[-1]["confidence"], out[-1]["is_best"]) == ("c13", "PERFECT", True)
    twice = df.drop("c13")
    got = profiling.grain_detection(twice, "T", ["c0", "c1"], names[:13]).collect()
    assert {r["confidence"] for r in got} == {"LOW"} and max(r["combo_size"] for r in got) == 2


def test_grain_goes_on_without_a_perfect_combination(spark):
    rows = [(i // 10, i % 10, i % 2, i // 50, 7) for i in range(100)]
    df = spark.createDataFrame([*rows, rows[0]], "a int, b int, c int, d int, e int")
    names = ["a", "b", "c", "d", "e"]
    for declared in ([], ["a", "c"]):
        out = profiling.grain_detection(df, "T", declared, names).collect()
        best = next(r for r in out if r["is_best"])
        assert (best["candidate_grain"], best["distinct_rows"], best["confidence"]) == ("a x b", 100, "HIGH")
    rng = np.random.default_rng(4)
    for _ in range(2):
        data = rng.integers(0, [2, 3, 4, 5], size=(40, 4)).tolist()
        data.append(data[0])
        out = profiling.grain_detection(spark.createDataFrame(data, "a int, b int, c int, d int"), "T", ["a", "b"], ["c", "d"]).collect()
        best = next(r for r in out if r["is_best"])
        every = [c for n in range(1, 5) for c in itertools.combinations(range(4), n) if not {0, 1} < set(c)]
        assert best["distinct_rows"] == max(len({tuple(r[i] for i in c) for r in data}) for c in every)


def test_grain_with_one_repeated_line(spark, small_dir):
    lines = spark.read.parquet(f"{small_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").cache()
    rows = [tuple(r) for r in lines.collect()]
    out = profiling.grain_detection(lines.union(lines.limit(1)), "T", [], lines.columns).collect()
    rows.append(rows[0])
    counts = {n: {c: len({tuple(r[i] for i in c) for r in rows}) for c in itertools.combinations(range(4), n)} for n in (1, 2, 3, 4)}
    for r in out:
        want = counts[r["combo_size"]][tuple(lines.columns.index(x) for x in r["candidate_grain"].split(" x "))]
        assert r["distinct_rows"] == want if r["is_exact"] else abs(r["distinct_rows"] / want - 1) < 0.08
    best = next(r for r in out if r["is_best"])
    assert best["distinct_rows"] == len(set(rows)) < len(rows) and best["confidence"] == "HIGH"
    by_size = {r["combo_size"]: r["distinct_rows"] for r in out if r["best_of_size"]}
    assert all(by_size[n] == max(counts[n].values()) for n in by_size) and by_size[2] == counts[2][(0, 2)]
    empty = profiling.grain_detection(lines.limit(0), "T", ["l_orderkey"], ["l_partkey"]).collect()
    assert [(r["candidate_grain"], r["distinct_rows"]) for r in empty] == [("l_orderkey", 0)]
    lines.unpersist()


def test_grain_counts_every_combination(spark):
    rng = np.random.default_rng(5)
    data = [tuple(None if v == 0 else v for v in r) for r in rng.integers(0, [3, 4, 5, 40], size=(60, 4)).tolist()]
    df = spark.createDataFrame([*data, data[0]], "a int, b int, c int, d int")
    out = [tuple(r) for r in profiling.grain_detection(df, "T", ["a", "b"], ["c", "d"], every=True).select("try_no", "candidate_grain", "distinct_rows", "is_exact").orderBy("try_no").collect()]
    combos = [c for n in range(1, 5) for c in itertools.combinations(range(4), n) if not {0, 1} <= set(c)]
    want = [(i, " x ".join("abcd"[j] for j in c), len({tuple(r[j] for j in c) for r in data}), True) for i, c in enumerate([(0, 1), *combos])]
    assert out == want and len(out) == 12
    # c and d are perfect together: a x b, declared, all single columns, and a x c to c x d
    lines = spark.createDataFrame([(i % 2, i % 3, i // 5, i % 5) for i in range(40)], "a int, b int, c int, d int")
    tried = profiling.grain_detection(lines, "T", ["a", "b"], ["c", "d"], every=True).orderBy("try_no").collect()
    assert [r["candidate_grain"] for r in tried] == ["a x b", "a", "b", "c", "d", "a x c", "a x d", "b x c", "b x d", "c x d"]
    assert [r["candidate_grain"] for r in tried if r["is_best"]] == ["c x d"] and tried[-1]["confidence"] == "PERFECT"
    sure = profiling.grain_detection(lines, "T", ["c", "d"], ["a"], every=True).collect()
    assert [(r["candidate_grain"], r["is_best"]) for r in sure] == [("c x d", True)]
    assert [r["distinct_rows"] for r in profiling.grain_detection(df.limit(0), "T", ["a"], ["b"], every=True).collect()] == [0]


def test_combinations_are_counted_without_copies_of_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, 5, 2)], "a int, b int, c int")
    out = profiling.combination_counts(df, [("a",), ("a", "b"), ("b", "c")])
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(0, 2, 3), (1, 2, 3), (2, 3, 3)]


def test_overlap_counts(spark):
    a = spark.createDataFrame([("x",), ("Y ",), (None,)], "v string")
    b = spark.createDataFrame([("y",), ("z",)], "v string")
    out = sets.jaccard_overlap(a, b, "v", "v").first()
    assert (out["in_both"], out["left_only"], out["right_only"], out["overlap_pct"]) == (1, 1, 1, 33.33)


def test_scd_keeps_history(spark):
    dim = spark.createDataFrame(
        [("1", "One", "A", day("2020-01-01"), None, True), ("2", "Two", "A", day("2020-01-01"), None, True), ("3", "Three", "A", day("2020-01-01"), None, True)],
        "brand_id string, brand_name string, category string, effective_date date, expiry_date date, is_current boolean",
    )
    updates = spark.createDataFrame([("1", "One", "B"), ("2", "Zwei", "A"), ("4", "Four", "C")], "brand_id string, brand_name string, category string")
    out = catalogs.dim_brand_scd(dim, updates, F.lit("2024-03-01").cast("date"))
    got = rows(out.select("brand_id", "brand_name", "category", "effective_date", "expiry_date", "is_current"), "brand_id", "effective_date")
    assert got == [
        ("1", "One", "A", day("2020-01-01"), day("2024-02-29"), False),
        ("1", "One", "B", day("2024-03-01"), None, True),
        ("2", "Zwei", "A", day("2020-01-01"), None, True),
        ("3", "Three", "A", day("2020-01-01"), None, True),
        ("4", "Four", "C", day("2024-03-01"), None, True),
    ]


def test_scd_settles_repeated_updates_and_stops_on_different_ones(spark):
    schema = "brand_id string, brand_name string, category string"
    dim = spark.createDataFrame([("1", "One", "A", day("2020-01-01"), None, True)], schema + ", effective_date date, expiry_date date, is_current boolean")
    as_of = F.lit("2024-03-01").cast("date")
    same = spark.createDataFrame([("1", "One", "B"), ("1", "One", "B"), (None, "x", "y")], schema)
    out = catalogs.dim_brand_scd(dim, same, as_of).collect()
    assert len(out) == 2 and sum(r["is_current"] for r in out) == 1
    with pytest.raises(Exception, match="conflicting rows for key 1"):
        catalogs.dim_brand_scd(dim, spark.createDataFrame([("1", "One", "B"), ("1", "One", "C")], schema), as_of).collect()


def test_inventory_by_sketches(spark):
    rng = np.random.default_rng(8)
    data = [(i, f"k{i % 7000}", int(rng.integers(3)) if i % 10 else None, "hot" if i % 3 == 0 else f"v{i}") for i in range(20_000)]
    df = spark.createDataFrame(data, "id int, part string, flag int, mixed string").repartition(6)
    exact = {r["column_name"]: r for r in profiling.column_inventory(df, "T", df.columns).collect()}
    rough = {r["column_name"]: r for r in profiling.column_inventory(df, "T", df.columns, exact_up_to=100).collect()}
    want = {c: len({r[i] for r in data}) for i, c in enumerate(df.columns)}
    assert {c: r["distinct_count"] for c, r in exact.items()} == want and all(r["distinct_is_exact"] for r in exact.values())
    assert exact["id"]["is_pk_candidate"] and not exact["part"]["is_pk_candidate"] and rough["id"]["is_pk_candidate"] and not rough["mixed"]["is_pk_candidate"]
    assert [rough[c]["distinct_is_exact"] for c in ("id", "flag")] == [False, True] and rough["flag"]["distinct_count"] == 4
    assert all(abs(rough[c]["distinct_count"] / want[c] - 1) < 0.08 for c in want)
    assert rough["mixed"]["sample_values"].startswith("hot | ") and rough["flag"]["null_rows"] == 2000
    sure = {r["column_name"]: r for r in profiling.column_inventory(df, "T", df.columns, exact_up_to=100, confirm_keys=True).collect()}
    assert sure["id"]["distinct_is_exact"] and sure["id"]["distinct_count"] == 20_000 and not sure["part"]["distinct_is_exact"]
    top = profiling.domain_profile(df, "T", ["mixed"], 3, exact_up_to=100).orderBy(F.desc("frequency")).first()
    assert (top["value"], top["frequency"]) == ("hot", sum(r[3] == "hot" for r in data)) and top["coverage_pct"] == pytest.approx(top["frequency"] / 200)
    empty = profiling.column_inventory(df.limit(0), "T", df.columns).collect()
    assert {(r["total_rows"], r["distinct_count"]) for r in empty} == {(0, 0)}


def test_inventory_query_counts_every_value(spark, tmp_path):
    from cartmetrics.plans import REGISTRY

    n = 100_500
    keys = spark.range(n).withColumn("id", F.greatest("id", F.lit(1)))
    keys.select(F.col("id").alias("p_partkey"), F.lit("x").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("SMALL").alias("p_type"), F.lit(5).alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    got = {r["column_name"]: r for r in REGISTRY["column_inventory"](spark, str(tmp_path)).collect()}
    key = got["mat_idt"]
    assert (key["total_rows"], key["distinct_count"], key["is_pk_candidate"]) == (n, n - 1, False)
    assert key["sample_values"] == "1 | 10 | 100 | 1000 | 10000" and "distinct_is_exact" not in key


def test_whole_inventory_is_exact(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (2, None, None)], "i int, s string, e double")
    got = {r["column_name"]: r for r in profiling.column_inventory(df, "T", df.columns, exact_up_to=None).collect()}
    assert {c: (r["distinct_count"], r["null_rows"], r["sample_values"]) for c, r in got.items()} == {"i": (2, 0, "2 | 1"), "s": (2, 1, "a"), "e": (1, 3, None)}
    by_sketch = {r["column_name"]: r for r in profiling.column_inventory(df, "T", df.columns).collect()}
    assert got == by_sketch
    empty = profiling.column_inventory(df.limit(0), "T", df.columns, exact_up_to=None).collect()
    assert {(r["total_rows"], r["distinct_count"], r["is_pk_candidate"]) for r in empty} == {(0, 0, True)}


def test_several_distinct_counts_without_copying_rows(spark, small_dir):
    from cartmetrics.plans import REGISTRY

    for name in ("sell_out_kpi", "market_panel_thresholds", "dq_rules"):
        plan = REGISTRY[name](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan, name


def test_regression_leaves_dependent_features_out(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=50)
    data = [("k", float(v), float(2 * v + 1), 4.0, float(3 * v + rng.normal() * 0.01)) for v in x] + [("few", 1.0, 3.0, 4.0, 2.0), ("few", 2.0, 5.0, 4.0, 5.0)]
    out = {r["key"]: r for r in models.mmm_regression(spark.createDataFrame(data, "key string, a double, b double, c double, y double"), ["key"], ["a", "b", "c"], "y").collect()}
    want = np.polyfit(x, [r[4] for r in data[:50]], 1)
    assert [out["k"]["a_coef"], out["k"]["intercept_coef"]] == pytest.approx(list(want)) and (out["k"]["b_coef"], out["k"]["c_coef"], out["k"]["matrix_rank"]) == (0, 0, 2)
    assert (out["few"]["a_coef"], out["few"]["intercept_coef"], out["few"]["r2"], out["few"]["matrix_rank"]) == pytest.approx((3.0, -1.0, 1.0, 2))


def test_decay_fit_takes_the_decay_that_made_the_series(spark):
    rng = np.random.default_rng(6)
    data = []
    for key, decay in (("slow", 0.8), ("fast", 0.2)):
        a = 0.0
        for week in range(150):
            spend = float(rng.random() < 0.3) * float(rng.integers(1, 50))
            a = spend + decay * a
            data.append((key, dt.date(2020, 1, 6) + dt.timedelta(days=7 * week), spend, 5 + 2 * a))
    data += [("flat", dt.date(2020, 1, 6) + dt.timedelta(days=7 * w), 1.0, 3.0) for w in range(9)]
    df = spark.createDataFrame(data, "key string, week date, spend double, units double")
    out = {r["key"]: r for r in models.adstock_decay_fit(df, ["key"], "week", "spend", "units").collect()}
    assert {k: r["decay_rate"] for k, r in out.items()} == {"slow": 0.8, "fast": 0.2} and out["slow"]["correlation"] == pytest.approx(1)
    stock = [r["adstock"] for r in series.adstock(df.filter("key = 'slow'"), ["key"], "week", "spend", 0.8).orderBy("week").collect()]
    assert stock == pytest.approx([(r[3] - 5) / 2 for r in data[:150]])


SEED = "source_cbu string, mrkt_dsc_shrt string, canal_lvl1 string, canal_lvl2 string, canal_std string, agg_level string, region_type string, region_std string, region_detail string, review_status string"


def _many_keys(spark, folder):
    """Orders, lines and customers with more values in a column than were counted exactly before."""
    n = 100_500
    keys = spark.range(n)
    keys.select(F.col("id").alias("o_orderkey"), (F.col("id") % 100_300).alias("o_custkey")).write.parquet(f"{folder}/orders.parquet")
    keys.select(F.greatest("id", F.lit(1)).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey")).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(100_400).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_dimension_candidates_count_every_value(spark, tmp_path):
    from cartmetrics.plans import REGISTRY

    got = {(r["dataset"], r["column_normalized"]): (r["distinct_count"], r["suggested_role"]) for r in REGISTRY["dimension_candidates"](spark, _many_keys(spark, tmp_path)).collect()}
    assert got == {
        ("ORDERS", "sku"): (100_500, "PRIMARY KEY"), ("LINEITEM", "sku"): (100_499, "ATTRIBUTE"), ("LINEITEM", "upc"): (7, "FOREIGN KEY"), ("CUSTOMER", "upc"): (25, "FOREIGN KEY"),
    }


def test_join_estimates_count_every_value(spark, tmp_path):
    from cartmetrics.plans import REGISTRY

    got = {(r["dataset_a"], r["dataset_b"], r["join_key"]): (r["left_count"], r["matched_count"]) for r in REGISTRY["join_estimate_report"](spark, _many_keys(spark, tmp_path)).collect()}
    assert got == {("LINEITEM", "ORDERS", "SKU"): (100_499, 100_499), ("CUSTOMER", "ORDERS", "CUS_IDT"): (100_400, 100_300), ("CUSTOMER", "LINEITEM", "UPC"): (25, 7)}


def test_domain_profile_ranks_every_value(spark):
    """130,001 values of a key: ten with two rows, a NULL with three, the others with one each."""
    df = spark.range(130_000).select(F.col("id").cast("string").alias("k")).union(spark.range(10).select((F.col("id") + 500).cast("string"))).union(spark.createDataFrame([(None,)] * 3, "k string"))
    got = [(r["value"], r["frequency"]) for r in profiling.domain_profile(df, "T", ["k"], 15).orderBy(F.desc("frequency"), "value").collect()]
    assert got == [("(null)", 3), *[(str(500 + i), 2) for i in range(10)], ("0", 1), ("1", 1), ("10", 1), ("100", 1)]


def test_market_catalog_has_its_columns_and_stops_on_conflicts(spark):
    def row(label, channel, status="CONFIRMED"):
        return ("EDP", label, "L1", channel, channel, "DETAIL", "AREA", "AREA 1", None, status)

    live = spark.createDataFrame([("EDP", " Modern 1"), ("EDP", "MODERN 1"), ("EDP", "new"), ("PB", "modern 1")], "source_cbu string, mrkt_dsc_shrt string")
    seed = spark.createDataFrame([row("modern 1", "MODERN SCANNING"), row("MODERN 1 ", "MODERN SCANNING"), row("gone", "X")], SEED)
    reference = spark.createDataFrame([("EDP", "NEW"), ("IBP", "north")], "source_cbu string, mrkt_dsc_shrt string")
    out = catalogs.market_catalog(live, seed, reference, "2024-01-01")
    assert tuple(out.columns) == catalogs.MARKET_COLUMNS and len(out.columns) == 20
    got = {(r["source_cbu"], r["mrkt_dsc_shrt_norm"]): r for r in out.collect()}
    assert {k: r["promoted"] for k, r in got.items()} == {("EDP", "MODERN 1"): "YES", ("EDP", "NEW"): "PENDING", ("PB", "MODERN 1"): "PENDING", ("IBP", "NORTH"): "REFERENCE"}
    known = got["EDP", "MODERN 1"]
    assert (known["is_scanning"], known["confirmation_status"], known["catalog_version"], known["notes"]) == ("YES", "CONFIRMED", "v1", None)
    audit = {r["check_id"]: (r["metric"], r["status"]) for r in catalogs.market_key_audit(seed).collect()}
    assert audit == {"M12": (0.0, "PASS"), "M12W": (1.0, "WARNING")}
    conflict = seed.union(spark.createDataFrame([row("gone", "Y"), row("modern 1", "OTHER")], SEED))
    assert {r["check_id"]: r["metric"] for r in catalogs.market_key_audit(conflict).collect()} == {"M12": 2.0, "M12W": 0.0}
    with pytest.raises(Exception, match="conflicting rows for key EDP"):
        catalogs.market_catalog(live, conflict).collect()
    assert catalogs.market_catalog(live, conflict, on_conflict="first").count() == 3


def test_channel_catalog_is_normalized_and_has_the_key_of_the_dimension(spark):
    schema = "source_system string, source_column string, source_value string, gran_canal_grp string, channel_standard string, chain_standard string, format_standard string, business_route string, mapping_status string, notes string"
    seed = spark.createDataFrame([("waste ", "CANAL", " dtt", "dtt", "tradicional", None, "f", "commercial", "confirmed", "n"), ("WASTE", "CANAL", "x", "DTT", "TRADICIONAL", None, "F", "COMMERCIAL", "PENDING", None)], schema)
    out = catalogs.channel_catalog(seed, "2024-01-01").collect()
    assert len(out) == 1 and (out[0]["source_system"], out[0]["source_value"], out[0]["format_standard"]) == ("WASTE", "DTT", "F")
    assert out[0]["channel_key"] == std.dim_channel(seed).first()["channel_key"] and str(out[0]["catalog_date"]) == "2024-01-01"


def test_units_without_a_factor_have_no_volume(spark):
    df = spark.createDataFrame([("waters ", 3.0, 2), ("EDP", 3.0, 2), ("other", 3.0, 2), (None, 3.0, 2)], "u string, n double, s int")
    assert [r[0] for r in df.select(scalars.volume_by_unit_factor(F.col("u"), F.col("n"), F.col("s"))).collect()] == [6.0, pytest.approx(0.6), None, None]


def test_check_log_is_appended(spark, tmp_path):
    from cartmetrics.operators import checks

    results = checks.run_checks(spark.range(5).withColumn("k", F.lit(None).cast("string")), "t", [checks.check_not_empty(), checks.check_null_key("k"), checks.check_negative("id")])
    target = str(tmp_path / "dq_log")
    for run in ("r1", "r2"):
        sinks.append_check_log(checks.check_log(results, "SILVER", run, {"t": 5}), target)
    log = spark.read.parquet(target)
    assert tuple(log.columns) == checks.LOG_COLUMNS and log.count() == 6
    got = {r["check_name"]: r for r in log.filter("batch_id = 'r2'").collect()}
    bad = got["B2_null_key:k"]
    assert (bad["check_type"], bad["check_result"], bad["actual_value"], bad["row_count"], bad["pipeline_layer"]) == ("NULL_RATE", "ERROR", 5.0, 5, "SILVER")
    assert bad["error_message"] and got["B1_not_empty"]["error_message"] is None and got["B1_not_empty"]["check_type"] == "ROW_COUNT" and bad["check_timestamp"] is not None


def test_facts_are_read_once_or_twice(spark, small_dir):
    from cartmetrics.plans import REGISTRY

    for name, most in (("cold_start_prior", 1), ("performance_log", 2), ("monthly_mart", 2), ("sell_in_consolidated", 1), ("metric_pivot", 3)):
        plan = REGISTRY[name](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
        table = "event_id" if name == "metric_pivot" else "l_orderkey|l_partkey"
        reads = [line for line in plan.splitlines() if "Relation" in line and any(c in line for c in table.split("|"))]
        assert len(reads) <= most, (name, len(reads))


def test_champions_follow_all_forecasts(spark, small_dir):
    """Baselines count the brands of every forecast, judged or not, and the facts are read twice at most."""
    from cartmetrics.plans import REGISTRY
    from cartmetrics.sources.roles import Tables

    log = {r["channel"]: r for r in REGISTRY["performance_log"](spark, small_dir).collect()}
    brands = Tables(spark, small_dir).forecast.groupBy("channel_type").agg(F.count_distinct("brand_key")).collect()
    assert {c: r["wape_baseline"] for c, r in log.items()} == {c: pytest.approx(n / 200) for c, n in brands}
    assert {(r["model_name"], r["model_version"], r["recall_baseline"]) for r in log.values()} == {("demand_modern", "v1", 0.8), ("demand_traditional", "v1", 0.8)}


def test_unjudged_forecasts_stay_if_asked_for(spark):
    forecast = spark.createDataFrame(
        [("a", 1, 2.0, True), ("b", 1, 3.0, False), ("c", 1, 4.0, True), ("c", 2, 5.0, None), (None, 1, 6.0, True)],
        "brand_key string, period_key int, forecasted_units double, is_official_version boolean",
    )
    actuals = spark.createDataFrame(
        [("a", 1, 4.0, True), ("a", 1, 1.0, True), ("b", 1, 1.0, True), ("c", 1, 0.0, True), ("c", 2, 1.0, True), (None, 1, 1.0, True)],
        "brand_key string, period_key int, actual_units double, is_reportable boolean",
    )
    keys = ["brand_key", "period_key"]
    every = joins.wape_actuals_join(forecast, actuals, keys, keep_unjudged=True)
    one = joins.wape_actuals_join(forecast, actuals, keys)
    assert sorted(map(tuple, every.filter("is_judged").select(*one.columns).collect())) == sorted(map(tuple, one.collect()))
    assert every.count() == 6
    kept = quality_aggs.wape(every, ["period_key"], more=[F.count_distinct("brand_key").alias("brands")], where=F.col("is_judged"))
    got = {r["period_key"]: tuple(r)[1:] for r in kept.collect()}
    assert got == {1: (pytest.approx(3 / 5), 1, 2, 3), 2: (None, 0, 0, 1)}


def test_cold_start_deals_more_tasks_for_more_lines(spark, small_dir, monkeypatch):
    from cartmetrics.plans import REGISTRY, decision_plans

    few = REGISTRY["cold_start_prior"](spark, small_dir)
    want = rows(few, "upc")
    monkeypatch.setattr(decision_plans, "ROWS_OF_A_TASK", 100, raising=False)
    many = REGISTRY["cold_start_prior"](spark, small_dir)
    dealt = [line for line in many._jdf.queryExecution().executedPlan().toString().splitlines() if "week_start" in line and "REPARTITION_BY_NUM" in line]
    assert dealt and all(", 60)" in line for line in dealt) and rows(many, "upc") == want


# --- sources and sinks -------------------------------------------------------------------------


def test_typed_csv_by_position(spark, tmp_path):
    (tmp_path / "m.csv").write_text("key,REGION,region\nA,,NORTH\nB,,SOUTH\n")
    out = readers.read_typed_csv(spark, str(tmp_path / "m.csv"), "key string, region_old string, region_std string")
    assert rows(out.select("key", "region_std"), "key") == [("A", "NORTH"), ("B", "SOUTH")]


def test_mapping_must_be_unique(spark, tmp_path):
    schema = "source_value string, label string, mapping_status string"
    (tmp_path / "m.csv").write_text("v,l,s\na,1,CONFIRMED\n A,2,PENDING\nb,3,CONFIRMED\n")
    ok = readers.read_mapping_unique(spark, str(tmp_path / "m.csv"), schema, "source_value", "CONFIRMED")
    assert rows(ok.select("source_value"), "source_value") == [("A",), ("B",)]
    with pytest.raises(ValueError, match="not unique"):
        readers.read_mapping_unique(spark, str(tmp_path / "m.csv"), schema, "source_value")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_mapping_unique(spark, str(tmp_path / "none.csv"), schema, "source_value")


def test_yaml_crosswalk(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("own:\n  ALPHA:\n    variants: [a1, A2]\nother:\n  BETA:\n    variants: [b1]\n")
    out = readers.read_mapping_yaml(spark, str(tmp_path / "c.yaml"), {"own": "OWN", "other": "COMPETITOR"})
    assert rows(out.select("variant", "canonical", "owner"), "variant") == [
        ("A1", "ALPHA", "OWN"), ("A2", "ALPHA", "OWN"), ("ALPHA", "ALPHA", "OWN"), ("B1", "BETA", "COMPETITOR"), ("BETA", "BETA", "COMPETITOR"),
    ]


def test_batch_ids_are_text_and_lost_batches_are_replaced(spark, tmp_path):
    raw = spark.createDataFrame([("1", "x"), ("2", "y")], "a string, b string")
    target = str(tmp_path / "bronze")
    assert sinks.ingest_append_batch(raw, target, "001") == "APPENDED"
    assert sinks.ingest_append_batch(raw.limit(1), target, "1") == "APPENDED"
    assert sorted(r[0] for r in sinks.read_batches(spark, target).select("_batch_id").collect()) == ["001", "001", "1"]
    # A job that died left a part of its batch and no commit record.
    raw.limit(1).write.parquet(f"{target}/_batch_id=half")
    assert sinks.ingest_append_batch(raw, target, "half") == "APPENDED"
    assert sinks.read_batches(spark, target).where("_batch_id = 'half'").count() == 2
    assert sinks.ingest_append_batch(raw, target, "half") == "SKIPPED_DUPLICATE_BATCH"


def test_joins_keep_one_row_per_fact(spark):
    fact = spark.createDataFrame([(1, "2020-01-05")], "k int, d string")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    assert joins.star_inner_join(fact, [(dim, {"k": "id"})]).count() == 1
    bridge = spark.createDataFrame([("2020-01-05", "2020-01-01"), ("2020-01-05", "2020-02-01")], "fecha_fin string, fecha string")
    assert joins.period_bridge_join(fact, bridge, "d").count() == 1


def test_batch_is_loaded_once(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("a,b\n1,x\n2,y\n")
    raw = readers.read_strings_csv(spark, str(tmp_path / "raw.csv"), ["a", "b"])
    target = str(tmp_path / "bronze")
    assert sinks.ingest_append_batch(raw, target, "b1") == "APPENDED"
    assert sinks.ingest_append_batch(raw, target, "b1") == "SKIPPED_DUPLICATE_BATCH"
    assert sinks.ingest_append_batch(raw, target, "b2") == "APPENDED"
    out = spark.read.parquet(target)
    assert out.count() == 4 and {r[0] for r in out.select("_source_file_name").distinct().collect()} == {"raw.csv"}
    assert dict(out.dtypes)["a"] == "string"


def test_write_table_overwrites(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    sinks.write_table(df, target, ["p"])
    sinks.write_table(df.filter("id < 4"), target, ["p"])
    assert spark.read.parquet(target).count() == 4


def test_catalog_table_keeps_types(spark, tmp_path):
    target = str(tmp_path / "cat")
    sinks.write_catalog_table(spark.createDataFrame([("a", 1)], "n string, c int"), target, "2024-01-01 00:00:00")
    assert dict(spark.read.parquet(target).dtypes) == {"n": "string", "c": "int", "run_at": "timestamp"}


def test_stream_loads_each_file_once(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    target, shared, source = str(tmp_path / "bronze"), str(tmp_path / "shared"), f"drop-{uuid.uuid4().hex}"
    (folder / "one.csv").write_text("a\n1\n2\n")
    stream_csv_ingest(spark, str(folder), ["a"], target, source, checkpoint=shared).awaitTermination()
    (folder / "two.csv").write_text("a\n3\n")
    stream_csv_ingest(spark, str(folder), ["a"], target, source, checkpoint=shared).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(target).select("a"), "a")] == ["1", "2", "3"]


def stream(spark, folder, target, shared, source="drop"):
    stream_csv_ingest(spark, str(folder), ["a"], str(target), source, checkpoint=str(shared)).awaitTermination()


def test_a_lost_checkpoint_neither_skips_nor_repeats_files(spark, tmp_path):
    folder, target = tmp_path / "drop", tmp_path / "bronze"
    folder.mkdir()
    (folder / "a.csv").write_text("a\n1\n2\n")
    stream(spark, folder, target, tmp_path / "c1")
    (folder / "b.csv").write_text("a\n3\n")
    stream(spark, folder, target, tmp_path / "c2")  # a new checkpoint lists a.csv again
    (folder / "c.csv").write_text("a\n4\n")
    stream(spark, folder, target, tmp_path / "c2")
    stream(spark, folder, target, tmp_path / "c3")
    out = sinks.read_batches(spark, str(target))
    assert rows(out.select("a", "_source_file_name"), "a") == [("1", "a.csv"), ("2", "a.csv"), ("3", "b.csv"), ("4", "c.csv")]
    assert {r["file"].rsplit("/", 1)[1] for r in sinks.commit_log(spark, str(target)).collect()} == {"a.csv", "b.csv", "c.csv"}


def test_streams_of_one_name_do_not_share_a_checkpoint(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "one.csv").write_text(f"a\n{name}\n")
        stream(spark, tmp_path / name, tmp_path / f"to_{name}", tmp_path / "shared")
    assert [[r["a"] for r in sinks.read_batches(spark, str(tmp_path / f"to_{n}")).collect()] for n in ("x", "y")] == [["x"], ["y"]]


def test_what_was_not_committed_is_not_read(spark, tmp_path):
    target = str(tmp_path / "bronze")
    raw = spark.createDataFrame([("1",), ("2",)], "a string")
    sinks.ingest_append_batch(raw, target, "done")
    raw.limit(1).write.parquet(f"{target}/_batch_id=lost")
    assert sinks.read_batches(spark, target).count() == 2


def test_ingest_into_a_table_by_name_and_with_any_id(spark):
    target = f"ingest_{uuid.uuid4().hex}"
    raw = spark.createDataFrame([("1", "x")], "a string, b string")
    ids = ["it's", 'a "quoted" id', "x=1/y", "'); DROP TABLE t; --"]
    try:
        assert [sinks.ingest_append_batch(raw if i % 2 else raw.select("b", "a"), target, batch) for i, batch in enumerate(ids)] == ["APPENDED"] * 4
        assert [sinks.ingest_append_batch(raw, target, batch) for batch in ids] == ["SKIPPED_DUPLICATE_BATCH"] * 4
        assert rows(sinks.read_batches(spark, target).select("a", "b", "_batch_id"), "_batch_id") == sorted(("1", "x", batch) for batch in ids)
        with pytest.raises(ValueError, match="columns"):
            sinks.ingest_append_batch(raw.withColumnRenamed("b", "c"), target, "other")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
        spark.sql(f"DROP TABLE IF EXISTS {target}__commits")


def test_checkpoint_folder_of_the_call_comes_first():
    class Session:
        def __init__(self, setting):
            self.setting, self.conf = setting, self

        def get(self, key, default):
            return self.setting or default

    assert stream_checkpoint(Session("/shared/"), "s") == "/shared/streams/s"
    assert stream_checkpoint(Session("/shared/"), "s", "/mine") == "/mine/streams/s"
    assert stream_checkpoint(Session(None), "s", "/mine") == "/mine/streams/s"
    with pytest.raises(ValueError):
        stream_checkpoint(Session(None), "s")


def test_read_source_pushes_columns_and_filters(spark, small_dir):
    df = readers.read_source(spark, f"{small_dir}/lineitem.parquet", ["l_quantity", "l_shipdate"])
    plan = std.period_filter(df.withColumn("q", F.col("l_quantity")), "l_quantity", 10.0)
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(l_quantity,10.0)" in text and "l_partkey" not in text.split("ReadSchema")[-1]


def test_conflicting_lookup_rows_are_listed_or_stop_the_job(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("x",)], "k string")
    mapping = spark.createDataFrame([("A", "one"), ("a ", "two"), ("b", "three"), ("b", "three")], "key string, label string")
    first = joins.mapping_left_join(fact, mapping, "k", "key", ["label"], on_conflict="first")
    assert sorted(tuple(r) for r in first.collect()) == [("a", "one"), ("b", "three"), ("x", None)]
    with pytest.raises(Exception, match="conflicting rows for key A"):
        joins.mapping_left_join(fact, mapping, "k", "key", ["label"], on_conflict="error").collect()
    clean = mapping.filter("key <> 'a '")
    assert joins.mapping_left_join(fact, clean, "k", "key", ["label"], on_conflict="error").count() == 3
    with pytest.raises(ValueError):
        joins.lookup_on(fact, mapping, {"k": "key"}, ["label"], on_conflict="last")
    named = mapping.selectExpr("upper(trim(key)) AS key", "label")
    assert [(r["key"], r["n_rows"]) for r in joins.key_conflicts(named, ["key"]).collect()] == [("A", 2)]


def test_segment_rules_in_sql(spark):
    df = spark.createDataFrame([("x", 1), ("xy", 5), (None, 5), ("z", 9)], "a string, n int")
    rules = [
        ("a LIKE 'x%' AND n BETWEEN 2 AND 6 OR a IS NULL", "FIRST"),
        ({"a": ["X"]}, "SECOND"),
        (F.col("n") > 8, F.concat(F.lit("n"), "n")),
    ]
    out = std.ordered_case(df, rules, "s").collect()
    assert [r["s"] for r in out] == ["SECOND", "FIRST", "FIRST", "n9"]
