"""Table readers and writers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Quotes are doubled inside quoted fields, so JSON text survives a round trip.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false"}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header. Give a schema on large data: inference reads the file twice.

    Splitting into tasks is Spark's (``spark.sql.files.maxPartitionBytes``), so a large
    file needs no chunk loop. ``multi_line`` is for fields with line breaks and makes a
    file unsplittable.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, "multiLine": str(multi_line).lower()})
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_auto(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``.parquet`` is Parquet, everything else CSV; ``~`` is expanded; a missing path raises."""
    full = os.path.expanduser(path)
    if full.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, full)
    return read_csv(spark, full, schema)


def load_split_source(spark: SparkSession, folder: str, name: str, dedup: bool = True) -> DataFrame:
    table = read_auto(spark, f"{folder.rstrip('/')}/{name}")
    return dedup_rows(table) if dedup else table


def dedup_rows(df: DataFrame) -> DataFrame:
    """Fully identical rows once. The map side combines copies first, so copies do not pile up."""
    return df.dropDuplicates()


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def write_csv(df: DataFrame, path: str) -> None:
    """Times are written to the microsecond; the reader takes them as they are."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    stamp = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    df.write.options(**options, timestampNTZFormat=stamp, timestampFormat=stamp + "XXX").csv(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One write for all splits; the label stays in the row."""
    df.write.partitionBy(split_col).parquet(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "event_id") -> None:
    probabilities = [c for c in df.columns if c.startswith("prob_")]
    write_csv(df.select(id_col, "pred_label", *probabilities), path)


def write_importance(df: DataFrame, path: str, top_n: int = 30) -> None:
    """Full table as CSV plus its top features as JSON records, taken from the written table."""
    from wardline.operators.metrics import top_features

    table = df.select("feature", "importance", *[c for c in ("std",) if c in df.columns])
    write_csv(table, f"{path}/full")
    written = read_csv(df.sparkSession, f"{path}/full", table.schema)
    top_features(written, top_n).write.json(f"{path}/top")


def write_metrics(df: DataFrame, path: str) -> None:
    df.write.json(path)
