"""Lookup join used by every fitted value table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest value table that is broadcast on purpose; others are left to adaptive execution.
BROADCAST_ROWS = 10_000
SALTS = 1024
#: A value that a larger share of the rows holds is heavy: there are at most 1 / HEAVY_SHARE of them.
HEAVY_SHARE = 1 / 512
HEAVY = "heavy"
NARROW = (T.NumericType, T.DatetimeType, T.BooleanType)


def with_heavy(table: DataFrame, count_col: str) -> DataFrame:
    """Marks the values that more than HEAVY_SHARE of the rows hold; ``count_col`` has the rows of each value."""
    total = table.agg(F.sum(F.col(count_col)).cast("double").alias("__total"))
    # one row
    return table.join(F.broadcast(total)).withColumn(
        HEAVY, F.coalesce(F.col(count_col).cast("double") > F.col("__total") * HEAVY_SHARE, F.lit(False))).drop("__total")


def lookup(df: DataFrame, table: DataFrame, key: str, defaults: dict, small: bool = False) -> DataFrame:
    """Attach the columns of ``table`` by ``key``, with defaults where there is no match.

    ``small`` states that the caller knows the table to hold at most BROADCAST_ROWS rows.
    Otherwise adaptive execution chooses by measured size. Where the table marks heavy values
    (``with_heavy``), of which there is a fixed number at most, rows that hold one are answered
    from a broadcast of these alone. They and rows without a key are spread by a salt, so no task
    gets all rows of a value, with or without adaptive execution.
    """
    # names of their own: both sides may come from one table
    named = lambda part, mark: part.select(F.col(key).alias(f"__{mark}key"), *[F.col(c).alias(f"__{mark}{c}") for c in defaults])
    known, columns = table.where(F.col(key).isNotNull()), df.columns
    if small:
        joined, marks = df.join(F.broadcast(named(known, "r")), F.col(key) == F.col("__rkey"), "left"), ["r"]
    else:
        asked, marks = F.col(key), ["r"]
        # Narrow columns alone, so that a salt keeps no text alive.
        narrow = [f.name for f in df.schema if isinstance(f.dataType, NARROW)] or columns
        if HEAVY in table.columns:
            df = df.join(F.broadcast(named(known.where(HEAVY), "h")), F.col(key) == F.col("__hkey"), "left")
            asked, marks = F.when(F.col("__hkey").isNull(), F.col(key)), ["h", "r"]
            known = known.where(~F.col(HEAVY))
        salt = F.when(F.col("__asked").isNull(), F.pmod(F.xxhash64(*narrow), F.lit(SALTS)) + 1).otherwise(0)
        df = df.withColumn("__asked", asked).withColumn("__salt", salt)
        # always 0, but no constant: the optimiser would take a constant out of the join keys
        right = named(known, "r").withColumn("__rsalt", F.pmod(F.xxhash64("__rkey"), F.lit(1)))
        joined = df.join(right, (F.col("__asked") == F.col("__rkey")) & (F.col("__salt") == F.col("__rsalt")), "left")
    return joined.select(*columns, *[F.coalesce(*[F.col(f"__{m}{c}") for m in marks], F.lit(v)).alias(c) for c, v in defaults.items()])
