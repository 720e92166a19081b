"""Selection and principal components over wide sparse vectors.

Nothing of the size columns x columns is ever made: mutual information comes from the non-zero
cells, components from block power iteration, of which only columns x components matrices leave
the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions.hashing import SEED
from wardline.operators.trees import PART, part_row, tree_sum
from wardline.session import cut_lineage

#: Columns of the block beyond the components asked for, and passes over the rows.
EXTRA, PASSES = 10, 12


def presence_information(rows: DataFrame, y: str, names: list[str], indices: str = "indices") -> DataFrame:
    """(feature, importance): mutual information in nats of the label with whether a cell is filled.

    ``indices`` are the distinct filled columns of a row. Only filled cells are counted, by column
    and label, and combine before the shuffle; empty cells are what is left of each label.
    """
    spark = rows.sparkSession
    labels = rows.groupBy(F.col(y).alias("y")).agg(F.count("*").cast("double").alias("ny"))
    total = labels.agg(F.sum("ny").alias("n"))
    filled = rows.select(F.explode(indices).alias("i"), F.col(y).alias("y")).groupBy("i", "y").agg(F.count("*").cast("double").alias("c"))
    # names by labels: bounded by the vocabulary
    grid = spark.range(len(names)).select(F.col("id").cast("int").alias("i")).join(F.broadcast(labels))
    cells = grid.join(filled.withColumnRenamed("y", "_y"), (grid["i"] == filled["i"]) & F.col("y").eqNullSafe(F.col("_y")), "left").select(
        grid["i"], "ny", F.coalesce("c", F.lit(0.0)).alias("c"))
    held = cells.groupBy("i").agg(F.sum("c").alias("nb"))
    full = cells.join(held, "i").join(F.broadcast(total))
    part = lambda c, b: F.when(c > 0, c / F.col("n") * F.log(c * F.col("n") / (b * F.col("ny")))).otherwise(0.0)
    both = part(F.col("c"), F.col("nb")) + part(F.col("ny") - F.col("c"), F.col("n") - F.col("nb"))
    table = full.groupBy("i").agg(F.sum(both).alias("importance"))
    named = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("i") + 1)
    return table.select(named.alias("feature"), "importance")


def _csr(batch: pa.RecordBatch, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of the filled cells of the columns taken."""
    i, v = (pa.concat_arrays([batch.column(k)]) for k in (0, 1))
    sizes = i.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    column, value = (x.flatten().to_numpy(zero_copy_only=False) for x in (i, v))
    own = taken[column]
    return np.repeat(np.arange(batch.num_rows), sizes)[own], column[own], value[own]


def _times(row: np.ndarray, column: np.ndarray, value: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    out = np.zeros((n, right.shape[1]))
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    if len(first):
        out[row[first]] = np.add.reduceat(right[column] * value[:, None], first, axis=0)
    return out


def _gathered(rows: DataFrame, taken: np.ndarray, k: int, right: np.ndarray | None, mean: np.ndarray | None) -> np.ndarray:
    """Without ``right`` the sums of the columns and the rows; with it X'(X - mean) right, mean taken from both sides."""
    shared, width = rows.sparkSession.sparkContext.broadcast((right, mean)), len(taken)
    size = width + 1 if right is None else width * k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, centre = shared.value
        total = np.zeros(size)
        for batch in batches:
            row, column, value = _csr(batch, taken)
            if block is None:
                total[:-1] += np.bincount(column, value, width)
                total[-1] += batch.num_rows
                continue
            away = _times(row, column, value, block, batch.num_rows) - centre @ block
            order = np.argsort(column, kind="stable")
            held = total.reshape(width, k)
            if len(order):
                own = column[order]
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                held[own[first]] += np.add.reduceat(away[row[order]] * value[order, None], first, axis=0)
            held -= np.outer(centre, away.sum(axis=0))
        yield part_row(TaskContext.get().partitionId(), total)

    found = tree_sum(rows.mapInArrow(run, PART), size, tasks=rows.rdd.getNumPartitions())
    shared.unpersist()
    return found if right is None else found.reshape(width, k)


def sparse_pca(rows: DataFrame, width: int, k: int, taken: np.ndarray | None = None, passes: int = PASSES,
               seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, components by column, variances) of rows (indices, values) of ``width`` columns.

    Columns not ``taken``, a mask, count as empty and have no part in a component. Divisor n - 1; the largest loading of a component is positive. A block of k + EXTRA columns goes
    through the rows ``passes`` times; the driver orthogonalises it.
    """
    rows, taken = cut_lineage(rows), np.ones(width, bool) if taken is None else taken
    sums = _gathered(rows, taken, 0, None, None)
    n = int(sums[-1])
    mean = sums[:-1] / max(n, 1)
    k = max(min(k, int(taken.sum()), n - 1), 0)
    if not k:
        return mean, np.zeros((width, 0)), np.zeros(0)
    size = min(k + EXTRA, int(taken.sum()))
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)) * taken[:, None])[0]
    for _ in range(passes):
        block = np.linalg.qr(_gathered(rows, taken, size, block, mean))[0]
    turned = _gathered(rows, taken, size, block, mean)
    small = block.T @ turned
    values, axes = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:k]
    components = block @ axes[:, order]
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(k)])
    return mean, components * np.where(signs == 0, 1, signs), values[order] / max(n - 1, 1)


def project(mean: np.ndarray, components: np.ndarray, spark):
    """Column function (indices, values) -> scores of the components."""
    shared = spark.sparkContext.broadcast((mean @ components, components))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        centre, right = shared.value
        for indices, values in batches:
            sizes = np.array([len(x) for x in indices], np.int64)
            flat = lambda s, kind: np.concatenate([*map(np.asarray, s), np.zeros(0)]).astype(kind)
            found = _times(np.repeat(np.arange(len(sizes)), sizes), flat(indices, np.int64), flat(values, float), right, len(sizes))
            yield pd.Series(list(found - centre), dtype=object)

    return scores
