"""Registry of queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import stable_round
from cartmetrics.plans.role_sql import with_roles
from cartmetrics.sources.roles import Tables


@dataclass(frozen=True)
class Query:
    plan: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.plan(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(
    sql: str | None = None, roles: tuple[str, ...] = (), extra: dict[str, str] | None = None, name: str | None = None
) -> Callable:
    """Register a plan under its function name, with the oracle body over the named roles."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or plan.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(plan, with_roles(roles, sql, extra) if sql else None)
        return plan

    return register


def rounded(df: DataFrame, digits: int = 4, **special: int) -> DataFrame:
    """Round double columns for stable comparison; ``special`` gives single columns their digits."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: stable_round(F.col(c), special.get(c, digits)) for c in doubles})
