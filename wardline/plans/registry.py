"""Registry of queries and of the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Six digits, and no negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def violations(df: DataFrame, bad: Column) -> DataFrame:
    """One row: how many rows were checked and how many break the invariant."""
    return df.agg(F.count("*").alias("n_rows"), F.count(F.when(bad, 1)).alias("n_violations"))
