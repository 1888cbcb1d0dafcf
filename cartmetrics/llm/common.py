"""Shared helpers: cutting lineage in the shared folder, and hashing words in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
#: Ids are broadcast up to this checked number of rows (8 MB); beyond it Spark joins by shuffle.
BROADCAST_IDS = 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in the one that driver and executors share (spark.checkpoint.dir, or the checkpoint
    folder of the Spark context). There is no local default: a step's table has to be seen by every executor."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back, so that later steps don't recompute it. Fails with a
    ValueError in a session that names no shared folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text as an array (null: empty), with built-in functions."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def semi_by_id(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of df whose id is in ids (distinct); broadcasts ids only after counting them."""
    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, column, "left_semi")


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = 4_000_000) -> Iterator[pa.Table]:
    """Slices of the batches that hold about so many characters, to bound the memory of a Python worker."""
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        edges = np.unique(np.searchsorted(np.cumsum(lengths), np.arange(chars, lengths.sum() + chars, chars)) + 1)
        start = 0
        for end in [*edges.tolist(), batch.num_rows]:
            end = min(end, batch.num_rows)
            if end > start:
                yield pa.Table.from_batches([batch.slice(start, end - start)])
                start = end


def mix(a: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def word_hashes(texts: list[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words of each text. Only A-Z are lower-cased."""
    split = [[] if t is None else (t.encode().lower() if lower else t.encode()).split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = np.empty(int(counts.sum()), dtype=object)
    flat[:] = list(chain.from_iterable(split))
    return (pd.util.hash_array(flat, categorize=False) if len(flat) else np.empty(0, np.uint64)), counts


def extend(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of sequences one word longer: grams[i] followed by words[i]."""
    return mix(grams * _STEP + words)
