"""Exact percentiles against NumPy, for values that are hard to bin."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartmetrics.operators import quality_aggs, series
from cartmetrics.operators.percentiles import percentiles

POINTS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


def kinds():
    rng = np.random.default_rng(5)
    yield "thousandths", np.arange(1001) / 1000
    yield "normal", rng.normal(size=3000) * 1e3
    yield "heavy tail", np.concatenate([rng.normal(size=2000) * 1e-9, [1e300, -1e300, 1e12]])
    yield "one value", np.full(700, -3.25)
    yield "repeated", rng.choice([0.1, 0.2, 0.3, 50.0], size=2001)
    yield "close together", 1e6 + rng.random(2500) * 1e-6
    yield "two rows", np.array([1.0, 2.0])
    yield "one row", np.array([7.5])


@pytest.mark.parametrize(("name", "values"), list(kinds()), ids=lambda x: x if isinstance(x, str) else "")
def test_equal_numpy(spark, name, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = list(percentiles(frame, "v", POINTS).first())
    assert got == pytest.approx(list(np.quantile(values, POINTS)), rel=1e-12, abs=1e-18)


def test_values_that_do_not_count(spark):
    rows = [(1.0,), (2.0,), (4.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)]
    assert list(percentiles(spark.createDataFrame(rows, "v double"), "v", [0.5, 0.75]).first()) == [2.0, 3.0]
    assert list(percentiles(spark.createDataFrame(rows[3:], "v double"), "v", [0.5]).first()) == [None]
    assert percentiles(spark.createDataFrame([], "v int"), F.col("v") * 2, [0.5]).collect()[0][0] is None


def test_scores_and_changes_are_not_rounded(spark):
    frame = spark.createDataFrame([("k", i, i / 1000) for i in range(1001)], "key string, period int, score double")
    out = quality_aggs.score_distribution(frame, "score").first()
    assert (out["p10"], out["p25"], out["p75"]) == pytest.approx((0.1, 0.25, 0.75))
    assert out["iqr"] == pytest.approx(0.5) and out["needs_recalibration"]
    moved = series.month_over_month_change(frame.withColumn("score", F.col("score") * F.col("period")), ["key"], "period", "score").first()
    want = np.abs(np.diff([i * i / 1000 for i in range(1001)]))
    assert moved["p90_change"] == pytest.approx(np.quantile(want, 0.9)) and moved["n_changes"] == 1000


def test_no_task_gets_all_values(spark):
    """Values are shuffled by value; windows run per bin, not over all values."""
    plan = percentiles(spark.range(1000).select(F.col("id").cast("double").alias("v")), "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("v#" not in line or "id#" in line for line in windows)
