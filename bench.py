"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores). Every query runs once after a
warm-up on the same session; the full result is produced and dropped by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartmetrics.plans import REGISTRY  # noqa: E402
from cartmetrics.session import build_session  # noqa: E402

HEADLINE = [
    "sell_in_std",
    "sell_out_std",
    "media_std",
    "market_facts_std",
    "sell_in_kpi",
    "sell_in_kpi_master",
    "sell_out_kpi",
    "investment_kpi",
    "metric_pivot",
    "market_kpi_master",
    "kpi_master_join",
    "all_source_full_join",
    "mapping_left_join",
    "ean_bridge_join",
    "cascade_match",
    "two_hop_customer_harmonization",
    "brand_std",
    "market_label_classify",
    "fact_waste",
    "sell_out_checks",
    "dq_rules",
    "column_inventory",
    "grain_detection",
    "duplicate_key_audit",
    "period_lags",
    "temporal_gaps",
    "lag_rolling_features",
    "adstock",
    "adstock_decay_fit",
    "hill_fit",
    "mmm_regression",
    "monthly_mart",
    "render_rationale",
    "portfolio_scorecard",
]


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("sell_out_kpi", "monthly_mart"):
        run(REGISTRY[name], spark, folder)
    times = {name: run(REGISTRY[name], spark, folder) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
