"""Small helpers shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import scratch_path


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, also where another column differs from one in case alone."""
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    lower = [c.lower() for c in df.columns]
    at = [df.columns.index(n) if n in df.columns else lower.index(n.lower()) for n in names]
    return flat.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(at, names)])


def others(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns whose names clash with none of ``names``; of equal names the first stays."""
    seen, keep = {n.lower() for n in names}, []
    for i, c in enumerate(df.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            keep.append(F.col(f"_c{i}").alias(c))
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]).select(*keep)


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings for the jobs inside; put back afterwards. Dots are written as ``__``."""
    named = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back; the shuffle files go at once."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
