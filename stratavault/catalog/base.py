"""Shared pieces of the query catalogue."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-02-01 00:00:00"
LOAD_3 = "2024-03-01 00:00:00"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt out evenly before a query builds wide texts from them; the same at every size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


@contextmanager
def own_database(spark: SparkSession) -> Iterator[str]:
    """A database for the stored tables of one query; it goes with all its tables once the results are stored elsewhere."""
    name = f"stratavault_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine; names and order stay."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
