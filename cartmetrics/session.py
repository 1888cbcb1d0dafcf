"""Session settings for the engine.

Joins carry no broadcast hints on data: Catalyst broadcasts a side only when its size is under
``autoBroadcastJoinThreshold``, AQE re-checks with the real shuffle size, and both fall back to a
sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key (NULL keys of a left join too) even when that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "cartmetrics", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """Create a session. A cluster sets its own master and partitions; local runs pass them."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
