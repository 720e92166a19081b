"""Embedding near-dedup: binary codes of rotated vectors decide which pairs are computed exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.base import pick, stored
from wardline.llm.components import components

#: Rows of a tile of estimates, and pairs computed exactly at a time.
TILE, EXACT = 256, 1 << 14


def rotation(dims: int, seed: int = 3) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated vectors, packed sign bits, correction factors) of unit vectors.

    The factor is the inner product of a rotated vector with its own code, read as a unit vector
    of equal components: dividing a product with the code by it gives an unbiased estimate.
    """
    turned = unit @ turn.T
    bits = turned >= 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return turned, np.packbits(bits, axis=1), factor


def bounds(factor: np.ndarray, threshold: float, dims: int, epsilon: float | None) -> np.ndarray:
    """By how much the estimate of a pair at ``threshold`` may fall short of it.

    A code misses its vector by the angle whose cosine is the factor, so the error is at most
    tan of that angle times the sine of the pair's angle: the bound for ``epsilon`` None, which
    loses nothing. With a number the bound is ``epsilon`` standard errors, sqrt(dims - 1) times
    smaller per unit.
    """
    certain = np.sqrt(np.maximum(1 - factor ** 2, 0)) / factor * np.sqrt(1 - threshold ** 2)
    return certain if epsilon is None else np.minimum(certain, certain * epsilon / np.sqrt(max(dims - 1, 1)))


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if (above == parent).all():
            return parent
        parent = above


def _compare(threshold: float, epsilon: float | None):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", ignore_index=True)
        vectors = np.array(frame["vector"].tolist(), np.float64)
        vectors /= np.abs(vectors).max(axis=1)[:, None]  # squares of very large or small components leave a double's range
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        dims, n = unit.shape[1], len(unit)
        turned, packed, factor = encode(unit, rotation(dims))
        # as the tasks of a block pair store them: one bit per dimension and one factor
        codes = np.unpackbits(packed, axis=1, count=dims).astype(np.float32) * 2 - 1
        least = ((threshold - bounds(factor, threshold, dims, epsilon)) * factor * np.sqrt(dims) - 1e-4).astype(np.float32)
        query, sides = turned.astype(np.float32), frame["block"].to_numpy()
        crossing = len(np.unique(sides)) > 1
        weight = frame["copies"].to_numpy()
        count, parent = np.zeros(n, np.int64), np.arange(n)
        for a in range(0, n, TILE):
            estimate = query[a:a + TILE] @ codes.T
            rows, cols = np.nonzero(estimate >= least)
            rows += a
            keep = (rows < cols) & (sides[rows] != sides[cols]) if crossing else rows < cols
            # the estimate of (row, col) uses the code of col; col < row is its mirror image
            rows, cols = rows[keep], cols[keep]
            for k in range(0, len(rows), EXACT):
                i, j = rows[k:k + EXACT], cols[k:k + EXACT]
                near = np.einsum("pd,pd->p", unit[i], unit[j]) >= threshold
                i, j = i[near], j[near]
                count += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
                parent = _roots(parent)
                apart = parent[i] != parent[j]
                for x, y in set(zip(parent[i[apart]].tolist(), parent[j[apart]].tolist())):
                    while parent[x] != x:
                        x = parent[x]
                    while parent[y] != y:
                        y = parent[y]
                    parent[max(x, y)] = min(x, y)
        linked, reps = np.flatnonzero(count), frame["rep"].to_numpy()
        return pd.DataFrame({"rep": reps[linked], "links": count[linked], "head": reps[_roots(parent)[linked]]})
    return run


def link_embeddings(vectors: DataFrame, threshold: float = 0.98, epsilon: float | None = None, block_rows: int = 4096,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept`` (the smallest id of its component).

    Vectors of equal label and length link when their cosine, in double precision, is at least
    ``threshold``. Null labels, and vectors that are null, empty, zero or hold a null or
    non-finite component, link with nothing. Equal vectors of a label are compared once and
    count with their number. Rows of one id are rows of their own; a row of null id links with
    nothing and is kept. Other columns are not read; an empty table gives an empty one.

    The vectors of a label are dealt into blocks; each pair of blocks is a task that returns
    counts and one link per linked vector, never pairs.
    """
    rows = pick(vectors, id_col, vector_col, label_col).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.col(label_col).alias("label"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0),
        F.lit(False))
    marked = rows.withColumn("usable", usable).withColumn("a", F.xxhash64(F.lit(1), "label", "vector")).withColumn(
        "b", F.xxhash64(F.lit(2), "label", "vector"))
    reps = stored(marked.where("usable").groupBy("a", "b").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("vector").alias("vector")).withColumn("dims", F.size("vector")), "vectors")

    sizes = stored(reps.groupBy("label", "dims").agg(F.ceil(F.count("*") / block_rows).alias("blocks")), "sizes")
    dealt = reps.join(sizes, ["label", "dims"]).withColumn("blocks", F.col("blocks").cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).select(
        "label", "dims", "low", "high", "rep", "copies", "block", "vector")
    found = stored(tasks.groupBy("label", "dims", "low", "high").applyInPandas(
        _compare(threshold, epsilon), "rep long, links long, head long"), "found")
    joined = components(found.select("rep", "head"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))

    classes = stored(reps.select("a", "b", "rep", "copies").join(links, "rep", "left").join(
        joined, F.col("rep") == F.col("node"), "left").select(
        F.col("a").alias("_a"), F.col("b").alias("_b"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id")), "classes")
    told = marked.where("usable").select("id", "a", "b").join(
        classes, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).select("id", "n_links", "component_id")
    alone = marked.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return told.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
