"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import stored

#: Parts into which the links of one node are dealt.
SALTS = 8


def _with_least(links: DataFrame) -> DataFrame:
    """Links (u, v) with ``m``, the least of u and all its v; the links of a node meet in SALTS parts."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("_u"), F.least("u", "m").alias("m"), F.explode(F.array(*map(F.lit, range(SALTS)))).alias("_s"))
    salted = links.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least, (F.col("u") == F.col("_u")) & (F.col("_salt") == F.col("_s"))).select("u", "v", "m")


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Greater neighbours of each node are linked to the least of its neighbourhood."""
    return _with_least(_both(links)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, are linked to the least of them."""
    near = _with_least(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        near.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable from each node that has a link.

    ``links`` has two columns of one orderable type, in any order. Links of a node to itself and
    null ends are left out; repeated links count once; without links the result is empty. Every
    round is a table in the shared folder, so a lost executor costs one round at most.
    """
    spark = links.sparkSession
    a, b = links.columns
    now = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")

    def state(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first()

    before = state(now)
    for _ in range(most_rounds if before[0] else 0):
        now = stored(_small_star(stored(_large_star(now), "large")), "small")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
