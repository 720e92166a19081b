"""Splits and samples by hash order: reproducible, exact in size, without a global sort."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_hex, hash_int
from wardline.operators.ordering import (
    BUCKET_ROWS, at_or_before, class_counts, hash_cutoffs, hash_rank, with_hash,
)

VAL_SIZE = 0.15
N_FOLDS = 5


def _by_class(class_col: Column, cases: list[tuple], default: Column) -> Column:
    """CASE over the classes; ``cases`` holds (class, expression)."""
    out = default
    for label, value in reversed(cases):
        out = F.when(class_col.eqNullSafe(F.lit(label)), value).otherwise(out)
    return out


def keep_first(df: DataFrame, class_col: str, id_col: str, quotas: dict, seed=SEED,
               bucket_rows: int = BUCKET_ROWS, rows: int | None = None) -> Column:
    """Condition on ``__hash`` that holds for the first ``quota`` rows of each class in hash order."""
    keys = hash_cutoffs(df, class_col, id_col, {c: [q] for c, q in quotas.items()}, seed, bucket_rows, rows)
    cases = []
    for label, quota in quotas.items():
        key = keys.get((label, quota))
        inside = at_or_before(F.col("__hash"), F.col(id_col), key) if key else F.lit(False)
        cases.append((label, inside))
    return _by_class(F.col(class_col), cases, F.lit(False))


def stratified_split(df: DataFrame, label_col: str, id_col: str, val_size: float = VAL_SIZE,
                     seed=SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``split`` = 'train' | 'val' with equal class shares. The split itself moves no row."""
    counts = class_counts(df, label_col)
    quotas = {c: math.floor(n * val_size + 0.5) for c, n in counts.items()}
    in_val = keep_first(df, label_col, id_col, quotas, seed, bucket_rows, sum(counts.values()))
    return (
        with_hash(df, id_col, seed)
        .withColumn("split", F.when(in_val, "val").otherwise("train"))
        .drop("__hash")
    )


def stratified_kfold(df: DataFrame, label_col: str, id_col: str, k: int = N_FOLDS, out: str = "fold",
                     seed=SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fold = floor((rank - 1) * k / n_class), rank in hash order: k - 1 cut keys per class, no sort."""
    counts = class_counts(df, label_col)
    # Last rank of each fold: the largest r with (r - 1) * k < (f + 1) * n.
    edges = {c: [((f + 1) * n - 1) // k + 1 for f in range(k - 1)] for c, n in counts.items()}
    keys = hash_cutoffs(df, label_col, id_col, edges, seed, bucket_rows, sum(counts.values()))
    cases = []
    for label, ends in edges.items():
        passed = [
            (~at_or_before(F.col("__hash"), F.col(id_col), keys[label, e])).cast("int")
            for e in ends if (label, e) in keys
        ]
        cases.append((label, reduce(lambda a, b: a + b, passed, F.lit(0))))
    fold = _by_class(F.col(label_col), cases, F.lit(0))
    return with_hash(df, id_col, seed).withColumn(out, fold.cast("int")).drop("__hash")


def group_split(df: DataFrame, group_col: str, val_size: float = VAL_SIZE, seed=SEED) -> DataFrame:
    """Whole groups go to one side, decided by a hash of the group key alone."""
    in_val = hash_int(seed, F.col(group_col)) % 1000 < F.lit(int(1000 * val_size))
    return df.withColumn("split", F.when(in_val, "val").otherwise("train"))


def sample_without_replacement(df: DataFrame, id_col: str, n: int, seed=SEED) -> DataFrame:
    """n random rows: the n smallest hash keys, one TakeOrdered over all partitions."""
    key = hash_hex(seed, F.col(id_col))
    return df.orderBy(key, F.col(id_col)).limit(n)


def shuffle_batches(df: DataFrame, id_col: str, batch_size: int = 1000, epochs: int = 1, seed=SEED,
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of each epoch in a new random order, cut into batches."""
    parts = []
    for epoch in range(epochs):
        one = df.withColumn("epoch", F.lit(epoch))
        ranked = hash_rank(one, ["epoch"], id_col, "__rank", f"{seed}|{epoch}", bucket_rows)
        parts.append(ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / batch_size)).drop("__rank"))
    return reduce(DataFrame.unionByName, parts)


def head_n(df: DataFrame, id_col: str, n: int) -> DataFrame:
    return df.orderBy(id_col).limit(n)
