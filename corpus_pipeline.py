"""A corpus pipeline of five operators; every stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmetrics.llm.common import BROADCAST_IDS, cut, semi_by_id, table
from cartmetrics.llm.mixing import mix_sources
from cartmetrics.llm.ngram_prefix import near_copy_components
from cartmetrics.llm.packing import pack_batches
from cartmetrics.llm.pii import redact_text
from cartmetrics.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, domain
from cartmetrics.llm.toxicity import fit_toxicity, known_labels, score_column

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Spark's setting for the bytes of an Arrow batch that goes to a Python worker (64 MB, if a session says nothing), and
#: the stages' value: both sides hold several copies of a batch for each running task.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def bound_batches(spark: SparkSession) -> bool:
    """Set BATCH_SETTING to BATCH_BYTES unless the session has a value of its own; returns whether it was set. Stages are
    lazy, so the value stays with the session; run() takes it back. No result depends on it."""
    unset = BATCH_SETTING not in spark.conf.getAll
    if unset:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return unset


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject: those with a score below 0.5.

    The classifier is fitted on docs and the labels of sf_dir. Null and empty texts have no hits and stay. Repeated rows
    get the same verdict each; rows without doc_id are judged like others. An empty table gives an empty result.
    """
    bound_batches(spark)
    model = fit_toxicity(docs.select("doc_id", "text"), known_labels(table(spark, sf_dir, "labels"), 5))
    return docs.select(*COLUMNS).where(score_column(*model)(F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies, linked by a similarity of `percent` of their shingles of `words` words:
    the one with the smallest doc_id. Of repeated rows of a doc_id that differ in text one is kept.

    Null and empty texts are linked with nothing and stay. Rows without doc_id stay. An empty table gives an empty
    result.
    """
    bound_batches(spark)
    docs = docs.select(*COLUMNS)
    groups = cut(near_copy_components(docs, words=words, percent=percent).select("doc_id", "component_id").where("doc_id IS NOT NULL"))
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    twice = cut(groups.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    kept = _without(docs, gone.union(twice).distinct())
    return kept if twice.isEmpty() else kept.union(semi_by_id(docs, twice, "doc_id").dropDuplicates(["doc_id"]))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = cut(ids)
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti").select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind, and n_chars of the new text.

    Null texts stay null with n_chars null, empty ones empty. Repeated rows are redacted each; an empty table gives an
    empty result.
    """
    bound_batches(spark)
    clean = docs.select(*COLUMNS).withColumn("text", redact_text(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per epoch that their source's token budget pays for.

    A null source or lang counts as an empty one. Texts without words cost nothing and come with their source's whole
    epochs; a source without tokens gives nothing. Repeated rows are taken each; an empty table gives an empty result.
    """
    mixed = mix_sources(docs.select(*COLUMNS).withColumn("domain", domain()), ["domain", "lang", "source"], MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns, epoch (the copies of a document that mixing made, from 0), n_tokens, and each row's
    bucket, batch and place.

    Null and empty texts have 0 tokens and are packed like others, as are rows without doc_id, whose equal texts are
    numbered as epochs of one. An empty table gives an empty result.
    """
    packed = pack_batches(docs, buckets=8, batch_tokens=16384, keep=COLUMNS)
    return packed.select(*COLUMNS, F.col("copy").alias("epoch"), "n_tokens", "bucket", "batch", "place")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Models and dynamic programming have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again: what pack returns."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    bounded = bound_batches(spark)
    try:
        for _, stage in STAGES:
            docs = cut(stage(spark, docs, sf_dir))
    finally:
        if bounded:
            spark.conf.unset(BATCH_SETTING)
    return docs
