"""Fitted statistics stored as Parquet tables: one row per named statistic."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_SCHEMA = "kind string, version int, name string, value string"


def save_state(spark: SparkSession, path: str, kind: str, version: int, state: dict) -> None:
    """``state`` is bounded by the number of columns, never by the number of rows."""
    rows = [(kind, version, name, json.dumps(value)) for name, value in state.items()]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str, kind: str, version: int) -> dict:
    rows = spark.read.parquet(path).select("kind", "version", "name", "value").collect()
    wrong = [r for r in rows if r["kind"] != kind or r["version"] != version]
    if wrong or not rows:
        raise ValueError(f"{path} does not hold a {kind} state of version {version}")
    return {r["name"]: json.loads(r["value"]) for r in rows}


def save_meta(spark: SparkSession, path: str, meta: dict) -> None:
    row = spark.range(1).select(F.lit(json.dumps(meta)).alias("value"))
    row.coalesce(1).write.mode("overwrite").text(path)


def load_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
