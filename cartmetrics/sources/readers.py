"""Readers. Every text source gets a declared schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A configuration file is read on the driver and broadcast, so its size is checked first.
MAX_CONFIG_ROWS, MAX_CONFIG_BYTES = 50_000, 32 * 1024 * 1024


def read_source(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    jdbc: Mapping[str, str] | None = None,
    query: str | None = None,
) -> DataFrame:
    """A table of the catalog, a parquet path, or a SQL text pushed down to a JDBC database.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``jdbc`` so that executors read slices in parallel.
    """
    if jdbc is not None:
        reader = spark.read.format("jdbc").options(**jdbc)
        if query and "partitionColumn" in jdbc:
            reader = reader.option("dbtable", f"({query}) q")
        elif query:
            reader = reader.option("query", query)
        else:
            reader = reader.option("dbtable", name)
        df = reader.load()
    elif "/" in name:
        df = spark.read.parquet(name)
    else:
        df = spark.table(name)
    return df.select(*columns) if columns else df


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """CSV with header and a declared schema; a row that does not fit fails the read.

    Columns are taken by position and named by the schema, so two headers that differ only in case
    cannot hide each other.
    """
    return (
        spark.read.schema(schema)
        .options(header="true", mode="FAILFAST", enforceSchema="true", **options)
        .csv(path)
    )


def read_strings_csv(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """CSV with every column as text, for raw loads that must keep values untouched."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).options(header="true").csv(path)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Return the frame when its keys are unique, else raise with up to five examples."""
    examples = duplicate_keys(df, keys).limit(5).collect()
    if examples:
        raise ValueError(f"{label}: keys {list(keys)} are not unique, e.g. {[tuple(r) for r in examples]}")
    return df


def read_mapping_unique(
    spark: SparkSession, path: str, schema: T.StructType | str, key: str, status: str | None = None
) -> DataFrame:
    """CSV mapping that is safe to join: normalized key, optional status filter, unique on key.

    A missing file raises; an empty mapping would turn every value into NULL without notice.
    """
    df = read_typed_csv(spark, path, schema)
    if status is not None:
        df = df.filter(F.upper(F.trim("mapping_status")) == status)
    df = df.withColumn(key, F.upper(F.trim(key))).filter(F.col(key).isNotNull())
    return require_unique(df, [key], path)


def config_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small configuration rows as a broadcast frame; too many rows come back without the hint."""
    df = spark.createDataFrame(list(rows), schema)
    return F.broadcast(df) if len(rows) <= MAX_CONFIG_ROWS else df


def crosswalk_rows(data: Mapping[str, Any], sections: Mapping[str, str]) -> list[tuple[str, str, str, int]]:
    """(variant, canonical, owner, priority) rows of a parsed crosswalk.

    ``sections`` maps section names to owners. A section holds canonical names with a list of
    variants; a name is a variant of itself. The first canonical that lists a variant wins.
    """
    seen: dict[str, tuple[str, str, str, int]] = {}
    for section, owner in sections.items():
        for canonical, body in (data.get(section) or {}).items():
            name = str(canonical).strip().upper()
            variants = body.get("variants", []) if isinstance(body, Mapping) else (body or [])
            for variant in [name, *variants]:
                text = str(variant).strip().upper()
                seen.setdefault(text, (text, name, owner, len(seen)))
    if not seen:
        raise ValueError(f"crosswalk has no entries in sections {list(sections)}")
    return list(seen.values())


def read_mapping_yaml(spark: SparkSession, path: str, sections: Mapping[str, str]) -> DataFrame:
    """YAML crosswalk as rows (variant, canonical, owner, priority), unique on variant. The parser runs on the driver,
    so files of more than MAX_CONFIG_BYTES are refused before they are read."""
    import yaml  # optional dependency, only needed for YAML configuration

    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    if size > MAX_CONFIG_BYTES:
        raise ValueError(f"{path}: {size} bytes are too many for a configuration file")
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    rows = crosswalk_rows(yaml.safe_load(text), sections)
    return config_frame(spark, rows, "variant string, canonical string, owner string, priority int")
