"""Sinks. Writers keep the parallelism of the frame: no single-file output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(
    df: DataFrame, target: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """Overwrite (or append to) a table of the catalog or a path.

    Rows are shuffled by the partition columns first, so each partition gets few large files; AQE
    splits the tasks of a partition value that holds most rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_catalog_table(df: DataFrame, name: str, run_at: str) -> None:
    """Profiling result with its run time. Types are kept."""
    write_table(df.withColumn("run_at", F.lit(run_at).cast("timestamp")), name)


def _existing(spark: SparkSession, target: str) -> DataFrame | None:
    """The target as a frame, or None before its first write."""
    if "/" not in target:
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_check_log(log: DataFrame, target: str) -> None:
    """Append rows of ``checks.check_log`` to the audit trail, a table of the catalog or a path. Rows are only added."""
    if "/" in target:
        log.write.mode("append").parquet(target)
    elif log.sparkSession.catalog.tableExists(target):
        log.select(*log.sparkSession.table(target).columns).write.mode("append").insertInto(target)
    else:
        log.write.mode("append").saveAsTable(target)


#: The commit log of a target: one row per batch, or per file of a batch that was read from files.
COMMITS = "batch_id string, file string, modified timestamp, committed_at timestamp"


def commit_log(spark: SparkSession, target: str) -> DataFrame:
    """Committed batches and files of a target: a table beside it, or a folder in it that readers of the data skip."""
    log = _existing(spark, f"{target}/_commits" if "/" in target else f"{target}__commits")
    return spark.createDataFrame([], COMMITS) if log is None else log


def ingest_append_batch(
    df: DataFrame, target: str, batch_id: str, environment: str = "dev", files: DataFrame | None = None, file_column: str | None = None
) -> str:
    """Write a raw batch as text columns with audit columns; a committed batch id is skipped.

    A batch is one partition. It is replaced as a whole until its rows in the commit log are written after it, so a
    retry repairs what a lost job left half-written. ``files`` (file, modified) goes to the log with it; ``file_column``
    holds the name of a row's file, where Spark no longer knows it, and becomes the audit column. Columns go to
    an existing table by their names, which have to be the same. Ids are compared as text and may hold any character;
    read a target with ``read_batches``, which keeps them so and leaves out what was never committed.
    """
    spark = df.sparkSession
    if not commit_log(spark, target).filter(F.col("batch_id") == F.lit(batch_id)).isEmpty():
        return "SKIPPED_DUPLICATE_BATCH"
    raw = [F.col(c).cast("string").alias(c) for c in df.columns if c != file_column]
    name = F.element_at(F.split(F.col(file_column) if file_column else F.input_file_name(), "/"), -1)
    out = df.select(
        *raw,
        F.current_timestamp().alias("_ingestion_timestamp"),
        F.when(name == "", "UNKNOWN").otherwise(name).alias("_source_file_name"),
        F.lit(environment).alias("_environment"),
        F.lit(batch_id).alias("_batch_id"),
    )
    append = lambda rows: rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        append(out).partitionBy("_batch_id").parquet(target)
    elif spark.catalog.tableExists(target):
        columns = spark.table(target).columns
        if sorted(columns) != sorted(out.columns):
            raise ValueError(f"{target} has columns {columns}, the batch {out.columns}")
        append(out.select(*columns)).insertInto(target)
    else:
        append(out).partitionBy("_batch_id").saveAsTable(target)
    listed = spark.createDataFrame([(None, None)], "file string, modified timestamp") if files is None else files.select("file", "modified")
    log = listed.select(F.lit(batch_id).alias("batch_id"), "file", "modified", F.current_timestamp().alias("committed_at"))
    if "/" in target:
        log.write.mode("append").parquet(f"{target}/_commits")
    else:
        log.write.mode("append").saveAsTable(f"{target}__commits")
    return "APPENDED"


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """All committed batches of a target, with the batch id as text ("001" stays "001")."""
    if "/" in target:
        found = spark.read.parquet(target).schema
        typed = [T.StructField(f.name, T.StringType()) if f.name == "_batch_id" else f for f in found]
        rows = spark.read.schema(T.StructType(typed)).parquet(target)
    else:
        rows = spark.table(target)
    done = commit_log(spark, target).select(F.col("batch_id").alias("_batch_id")).distinct()
    return rows.join(done, "_batch_id", "left_semi").select(*rows.columns)


def capped_export(df: DataFrame, order_by: Sequence[str], n: int = 100_000) -> DataFrame:
    """First n rows in a fixed order, for previews only; facts are never cut."""
    return df.orderBy(*order_by).limit(n)
