"""Raw file drops as a stream: each micro-batch goes through the batch ingest, which keeps a log of files."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartmetrics.sources.sinks import commit_log, ingest_append_batch


def stream_checkpoint(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """Checkpoint folder of a stream: under ``folder``, or else under the shared folder that the session names.

    A stream must find its checkpoint again on the next run, so there is no temporary default.
    """
    root = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint folder")
    return f"{root.rstrip('/')}/streams/{name}"


def stream_csv_ingest(
    spark: SparkSession, folder: str, names: Sequence[str], target: str, source: str, environment: str = "dev",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Load new CSV files of a folder once each.

    What was loaded is known by file (path and time of change), in the commit log of the target, and not by the number
    of a micro-batch: with a new or lost checkpoint the stream lists all files again, and the log leaves out those that
    are in. A batch is named by its files, so a micro-batch that is replayed after a failure replaces what it had begun
    to write. A file that was changed is loaded again, as a new one. Every pair of folder and target has its own
    checkpoint. Files without a row leave no trace.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    files = spark.readStream.schema(schema).option("header", "true").csv(folder)
    files = files.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_modified"))

    def load(batch: DataFrame, number: int) -> None:
        known = commit_log(spark, target).select(F.col("file").alias("_file"), F.col("modified").alias("_modified"))
        fresh = batch.join(known, ["_file", "_modified"], "left_anti")
        listed = fresh.select(F.col("_file").alias("file"), F.col("_modified").alias("modified")).distinct()
        mark = listed.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("file", "modified")).alias("x")).first()
        if mark["n"]:
            batch_id = f"{source}_{mark['n']}_{mark['x'] & (2**64 - 1):016x}"
            ingest_append_batch(fresh.select(*names, "_file"), target, batch_id, environment, listed, "_file")

    place = hashlib.md5(f"{folder}|{target}".encode()).hexdigest()[:12]
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", stream_checkpoint(spark, f"{source}-{place}", checkpoint))
        .trigger(availableNow=True)
        .start()
    )
