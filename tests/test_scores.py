"""Boundaries of the KPI rules, scores, actions and texts."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartmetrics.plans.decision_plans import RATIONALE_TEXTS
from cartmetrics.functions import scalars as S
from cartmetrics.operators import decisions, mart, quality_aggs, series


def day(text):
    return dt.date.fromisoformat(text)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_waste_rate_boundaries(spark):
    data = [(100.0, 1000.0), (0.0, 0.0), (100.0, None), (None, 1000.0), (1200.0, 1000.0), (0.0, 1000.0)]
    df = spark.createDataFrame(data, "w double, s double").coalesce(1)
    rule = S.waste_rate(F.col("w"), F.col("s"))
    assert rows(df.select(*rule.values())) == [
        (0.1, False, None),
        (None, False, "SELL_IN_ZERO"),
        (None, False, "SELL_IN_NULL"),
        (None, False, "WASTE_NULL"),
        (1.2, True, "WASTE_EXCEEDS_SELL_IN"),
        (0.0, False, None),
    ]


def test_sell_ratio_boundaries(spark):
    data = [(800.0, 1000.0), (500.0, 0.0), (1200.0, 1000.0), (2000.0, 1000.0), (1000.0, 1000.0), (1500.0, 1000.0), (None, 1.0), (1.0, None)]
    df = spark.createDataFrame(data, "o double, i double").coalesce(1)
    rule = S.sell_ratio(F.col("o"), F.col("i"))
    assert rows(df.select(*rule.values())) == [
        (0.8, True, None),
        (None, False, "SELL_IN_ZERO"),
        (1.2, True, "RATIO_ABOVE_1_PRIOR_INVENTORY"),
        (2.0, True, "RATIO_EXCEEDS_1_5"),
        (1.0, True, None),
        (1.5, True, "RATIO_ABOVE_1_PRIOR_INVENTORY"),
        (None, False, "SELL_OUT_NULL"),
        (None, False, "SELL_IN_ZERO"),
    ]


GQS = list(S.GROWTH_WEIGHTS)


def gqs(spark, values):
    df = spark.createDataFrame([values], ", ".join(f"{k} double" for k in GQS))
    out = S.growth_quality_score({k: F.col(k) for k in GQS})
    return tuple(df.select(*out.values()).first())


def test_growth_quality_missing_parts(spark):
    assert gqs(spark, (75.0, 70.0, 80.0, 85.0, 70.0)) == (75.5, "HIGH", 0)
    assert gqs(spark, (None, 70.0, 80.0, 85.0, 70.0))[1:] == ("MEDIUM", 1)
    score, confidence, missing = gqs(spark, (None, None, 80.0, 85.0, 70.0))
    assert (confidence, missing) == ("LOW", 2)
    assert score == pytest.approx((0.20 * 80 + 0.15 * 85 + 0.15 * 70) / 0.5, abs=0.051)
    assert gqs(spark, (None, None, None, 85.0, 70.0)) == (None, "NULL", 3)
    assert gqs(spark, (500.0, 500.0, 500.0, 500.0, 500.0))[0] == 100.0


def test_weights_sum_to_one():
    assert sum(S.GROWTH_WEIGHTS.values()) == pytest.approx(1.0)
    assert sum(S.RISK_WEIGHTS.values()) == pytest.approx(1.0)


def risk(spark, values, brands=3):
    names = list(S.RISK_WEIGHTS)
    df = spark.createDataFrame([(*values, brands)], ", ".join(f"{k} double" for k in names) + ", n int")
    out = S.competitive_risk_score({k: F.col(k) for k in names}, F.col("n"))
    return tuple(df.select(*out.values()).first())


def test_competitive_risk(spark):
    assert risk(spark, (100.0,) * 5)[0] == 100.0
    assert risk(spark, (0.0,) * 5) == (0.0, "FULL", 0)
    score, confidence, _ = risk(spark, (80.0, None, 70.0, 50.0, 40.0))
    assert score == pytest.approx((0.3 * 80 + 0.2 * 70 + 0.15 * 50 + 0.1 * 40) / 0.75, abs=0.051)
    assert confidence == "PARTIAL"
    assert risk(spark, (80.0, None, None, None, 40.0)) == (None, "NULL", 3)
    assert risk(spark, (80.0,) * 5, brands=1)[:2] == (None, "NO_COMPETITIVE_CONTEXT")
    assert risk(spark, (100.0, 0.0, 0.0, 0.0, 0.0))[0] > risk(spark, (0.0, 100.0, 0.0, 0.0, 0.0))[0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-50, 150)), min_size=5, max_size=5))
def test_growth_quality_matches_plain_rule(spark, values):
    score, _, missing = gqs(spark, tuple(values))
    present = [(v, w) for v, w in zip(values, S.GROWTH_WEIGHTS.values()) if v is not None]
    if missing > 2:
        assert score is None
    else:
        plain = sum(v * w for v, w in present) / sum(w for _, w in present)
        assert score == pytest.approx(min(100.0, max(0.0, plain)), abs=0.0501)


def history(spark, values):
    return spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "key string, period int, score double")


@pytest.mark.parametrize("values,last", [([70.0, 72.0, 68.0, 74.0], 71.0), ([70.0, 72.0], 71.0), ([75.0], None), ([10.0, 70.0, 72.0, 68.0, 74.0], 71.0)])
def test_rolling_score(spark, values, last):
    out = series.rolling_score(history(spark, values), ["key"], "period", "score").orderBy("period").collect()
    assert out[-1]["score_4w_avg"] == last


def test_rolling_score_of_nothing(spark):
    assert series.rolling_score(spark.createDataFrame([], "key string, period int, score double"), ["key"], "period", "score").count() == 0


def test_score_spread(spark):
    wide = spark.createDataFrame([(float(v),) for v in range(40, 90)], "score double")
    narrow = spark.createDataFrame([(float(v),) for v in range(60, 71)], "score double")
    assert not quality_aggs.score_distribution(wide, "score").first()["needs_recalibration"]
    assert quality_aggs.score_distribution(narrow, "score").first()["needs_recalibration"]


def test_alert_needs_two_periods(spark):
    out = series.consecutive_alert(history(spark, [71.0, 60.0, 80.0, 75.0, None, 90.0]), ["key"], "period", "score")
    assert [r["alert_flag"] for r in out.orderBy("period").collect()] == [False, False, False, True, False, False]


ACTION_SCHEMA = (
    "gqs_4w_avg double, waste_risk_category string, waste_adjusted_roi double, share_change_pp double, "
    "consecutive_forecast_misses int, weeks_of_history int, price_index_vs_category double"
)


@pytest.mark.parametrize(
    "row,expected",
    [
        ((85.0, "HIGH", 2.4, 1.2, 0, 12, 1.0), ("INCREASE", "WASTE_REVIEW", "INCREASE + WASTE_REVIEW", True)),
        ((68.0, "LOW", 1.3, 0.2, 4, 12, 1.0), ("MAINTAIN", "FORECAST_REVIEW", "MAINTAIN + FORECAST_REVIEW", False)),
        ((32.0, "HIGH", 0.6, -2.1, 0, 12, 1.0), ("REDUCE", "WASTE_REVIEW", "REDUCE + WASTE_REVIEW", False)),
        ((82.0, "LOW", 2.1, 1.5, 0, 12, 1.0), ("INCREASE", None, "INCREASE", False)),
        ((82.0, "HIGH", 2.1, 1.5, 5, 2, 1.0), ("WATCH", None, "WATCH", False)),
        ((None, "HIGH", 2.1, 1.5, 0, 12, 1.0), ("WATCH", None, "WATCH", False)),
        ((76.0, "HIGH", 1.6, 0.0, 3, 12, 1.0), ("INCREASE", "WASTE_REVIEW + FORECAST_REVIEW", "INCREASE + WASTE_REVIEW + FORECAST_REVIEW", True)),
        ((65.0, "LOW", 1.2, -0.6, 0, 12, 1.2), ("MAINTAIN", "PRICE_REVIEW", "MAINTAIN + PRICE_REVIEW", False)),
        ((55.0, "LOW", 0.9, 0.0, 0, 12, 1.0), ("OPTIMIZE", None, "OPTIMIZE", False)),
        ((80.0, "LOW", 2.0, None, 0, 12, 1.0), ("INCREASE", None, "INCREASE", False)),
    ],
)
def test_actions(spark, row, expected):
    out = decisions.recommend(spark.createDataFrame([row], ACTION_SCHEMA))
    assert tuple(out.select("primary_action", "secondary_action", "action_compound", "conflict_flag").first()) == expected


def test_every_action_has_a_valid_text(spark):
    schema = "action_compound string, brand string, gqs double, roi double, share double, risk double, limit double, price double, misses int, weeks int, need int"
    data = [(a, "Alpha", 82.0, 2.4, -2.1, 0.72, 0.70, 1.2, 4, 2, 4) for a in [*RATIONALE_TEXTS, "REDUCE + PRICE_REVIEW"]]
    slots = {
        "brand_name": "brand", "gqs_score_4w_avg": "gqs", "roi": "roi", "share_change_pp": "share", "waste_risk_score": "risk",
        "waste_risk_threshold": "limit", "price_index": "price", "consecutive_forecast_misses": "misses",
        "weeks_of_history": "weeks", "min_weeks_required": "need",
    }
    out = decisions.render_rationale(spark.createDataFrame(data, schema), slots, RATIONALE_TEXTS).collect()
    assert all(r["rationale_valid"] and "{" not in r["rationale"] for r in out), out
    by_action = {r["action_compound"]: r["rationale"] for r in out}
    assert "72%" in by_action["INCREASE + WASTE_REVIEW"] and "70%" in by_action["INCREASE + WASTE_REVIEW"]
    assert "1.20" in by_action["MAINTAIN + PRICE_REVIEW"]
    assert by_action["REDUCE + PRICE_REVIEW"] == by_action["REDUCE"]
    missing = decisions.render_rationale(spark.createDataFrame([("WATCH", None, None, None, None, None, None, None, None, 2, 4)], schema), slots, RATIONALE_TEXTS)
    assert missing.first()["rationale_valid"] is False


def test_owner_list_must_not_be_empty():
    with pytest.raises(ValueError):
        S.owner_type(F.lit("x"), [])


def test_dates_from_codes(spark):
    df = spark.createDataFrame([("20250131",), ("202502",), ("20251340",), ("x",), (None,)], "d string").coalesce(1)
    got = [r[0] and r[0].isoformat() for r in df.select(S.date_from_int(F.col("d"))).collect()]
    assert got == ["2025-01-31", "2025-02-01", None, None, None]


def test_empty_inputs_do_not_divide_by_zero(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert quality_aggs.grain_fanout_ratio(empty, ["k"]).first()["rows_per_key"] is None
    assert quality_aggs.score_distribution(empty, "v").first()["mean"] is None


def test_share_change_follows_the_calendar(spark):
    rows = [("b", "2024-01-01", 1, 10.0), ("b", "2024-02-01", 2, 12.0), ("b", "2024-05-01", 5, 15.0)]
    df = spark.createDataFrame(rows, "k string, m string, p int, share double").withColumn("m", F.to_date("m"))
    by_month = series.share_change(df, ["k"], "p", "share", "m").orderBy("p").collect()
    assert [r["share_change_pp"] for r in by_month] == [None, 2.0, None]
    by_row = series.share_change(df, ["k"], "p", "share").orderBy("p").collect()
    assert [r["share_change_pp"] for r in by_row] == [None, 2.0, 3.0]


def test_round_score_is_not_tipped_by_noise(spark):
    got = spark.range(1).select(S.round_score(F.lit(67.44999999999999)), S.round_score(F.lit(67.4499))).first()
    assert tuple(got) == (67.5, 67.4)


# --- weekly competitive risk -------------------------------------------------------------------

PANEL = "brand_key string, channel_key string, week_end date, n_brands int, value_share double, numeric_distribution double, weighted_distribution double, price_index_vs_category double"


def weekly(first, weeks, share, missing=(), brand="B"):
    start = dt.date.fromisoformat(first)
    return [(brand, "C", start + dt.timedelta(days=7 * i), 3, share(i), 50.0, 40.0, 1.0) for i in range(weeks) if i not in missing]


def test_weekly_risk_looks_back_13_and_52_weeks(spark):
    rows = weekly("2023-01-01", 60, lambda i: 30.0 - 0.1 * i, missing=(10,))
    got = {(r["week_end"] - dt.date(2023, 1, 1)).days // 7: r for r in mart.weekly_competitive_risk(spark.createDataFrame(rows, PANEL)).collect()}
    assert not got[12]["has_history"] and got[13]["has_history"] and not got[23]["has_history"] and got[24]["has_history"]
    # 13 weeks: share -1.3, so 100 * (3 + 1.3) / 6; other changes are zero; the year is known from week 52 on
    parts = {"share_loss": (71.6667, 0.30), "price_gap": (50.0, 0.25), "num_dist": (50.0, 0.20), "wgt_dist": (50.0, 0.15)}
    want = sum(v * w for v, w in parts.values()) / 0.9
    assert got[30]["competitive_risk_score"] == pytest.approx(round(want, 1)) and got[30]["competitive_risk_confidence"] == "PARTIAL"
    assert got[55]["competitive_risk_confidence"] == "FULL" and got[55]["competitive_risk_score"] > got[30]["competitive_risk_score"]
    assert got[23]["competitive_risk_confidence"] == "NULL" and got[23]["competitive_risk_score"] is None  # week 10 is missing


def test_months_take_the_last_week_known(spark):
    panel = spark.createDataFrame(weekly("2023-01-01", 30, lambda i: 30.0 - 0.1 * i) + weekly("2023-01-01", 40, lambda i: 9.0, brand="D"), PANEL)
    months = spark.createDataFrame([(b, "C", day(f"2023-{m:02d}-01")) for b in "BD" for m in range(1, 13)] + [("X", "C", day("2023-05-01"))], "brand_key string, channel_key string, fecha_month date")
    got = {(r["brand_key"], r["fecha_month"].month): r for r in mart.with_competitive_risk(months, panel).collect()}
    scores = {(r["brand_key"], r["week_end"]): r["competitive_risk_score"] for r in mart.weekly_competitive_risk(panel).collect()}
    assert len(got) == 25 and got["B", 5]["competitive_risk_score"] == scores["B", dt.date(2023, 5, 28)] is not None
    assert got["B", 5]["nielsen_lag_weeks"] == 0 and got["B", 8]["nielsen_lag_weeks"] == 5  # the panel of B ends on 23 July
    assert got["B", 8]["competitive_risk_score"] == scores["B", dt.date(2023, 7, 23)]
    assert got["B", 9]["nielsen_lag_weeks"] is None and got["B", 9]["competitive_risk_score"] is None  # ten weeks are too old
    assert got["X", 5]["nielsen_lag_weeks"] is None and got["D", 10]["competitive_risk_score"] == scores["D", dt.date(2023, 10, 1)]


def test_growth_of_brand_and_channel_without_gaps_or_copies(spark):
    rows = [("A", "C", m, f"{y}-{m:02d}-01", 100.0 * (y - 2021) + m) for y in (2022, 2023) for m in (1, 2)]
    rows += [("N", "C", 1, "2023-01-01", 50.0), ("A", "Z", 1, "2023-01-01", 5.0)]
    base = spark.createDataFrame([(b, c, k, day(d), r) for b, c, k, d, r in rows], "brand_key string, channel_key string, period_key int, fecha_month date, revenue double")
    got = {(r["brand_key"], r["channel_key"], str(r["fecha_month"])): r for r in mart.with_growth(base).collect()}
    assert len(got) == 6
    assert got["A", "C", "2023-01-01"]["sell_out_growth"] == pytest.approx(201 / 101 - 1)
    assert got["N", "C", "2023-01-01"]["market_category_growth_pct"] == pytest.approx((251 / 101 - 1) * 100) and got["N", "C", "2023-01-01"]["sell_out_growth"] is None
    assert got["A", "C", "2022-01-01"]["market_category_growth_pct"] is None and got["A", "Z", "2023-01-01"]["market_adjusted_growth"] is None
    plan = mart.with_growth(base)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_mart_reads_the_facts_twice_and_has_all_columns(spark, small_dir):
    from cartmetrics.plans.decision_plans import mart_rows
    from cartmetrics.sources.roles import Tables

    frame = mart_rows(Tables(spark, small_dir))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) <= 2
    wanted = "brand_name channel_name channel_type region_key fiscal_period recommendation_rationale recommendation_version sell_out_coverage_pct nielsen_lag_weeks computed_at source_pipeline_run_id"
    assert set(wanted.split()) <= set(frame.columns)
    texts = {"WATCH": "{brand_name}: {weeks_of_history} weeks, score {gqs_score_4w_avg}"}
    base = spark.createDataFrame([("A", "C", 1, day("2023-01-01"), 10.0, 1.0, 1.0, 1.0, 5.0, 5.0, 1.0, 1.0, 1.0)], "brand_key string, channel_key string, period_key int, fecha_month date, revenue double, units double, forecast_units double, actual_units double, value_share double, volume_share double, numeric_distribution double, weighted_distribution double, price_index_vs_category double")
    on = "brand_key string, channel_key string, fecha_month date, "
    none = [spark.createDataFrame([], on + c) for c in ("sell_in_units double, waste_units double, waste_cost double, waste_risk_score double", "investment_spend double")]
    row = mart.monthly_mart(base, *none, spark.createDataFrame([], PANEL), templates=texts).first()
    assert row["recommendation_rationale"].startswith("A: 4 weeks") and row["region_key"] == 0 and row["fiscal_period"] == "FY2023-P01" and row["competitive_risk_score"] is None
