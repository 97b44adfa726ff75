"""Registry of named queries: a Spark builder plus its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, ShortType


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, lambda spark, sf: finalize(fn(spark, sf)), sql)
        return fn
    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Type-stable output for the oracle compare: integers as BIGINT,
    doubles rounded to 6 places."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)
