"""A rectified-linear network trained by back-propagation inside tasks.

An epoch is one job: every task takes the shared weights through seeded mini-batches of its own
rows with adaptive steps, and weights and step statistics are averaged over the tasks. The same
job measures the loss of the shared weights on rows that are held out, so jobs grow with the
epochs and never with the batches.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import arrays
from wardline.functions.hashing import SEED
from wardline.operators.trees import PART, part_row, tree_sum
from wardline.session import cut_lineage
from wardline.sources.state import load_meta, save_meta

#: Rows of a training task: their number alone decides into how many tasks an epoch is cut.
TASK_ROWS = 16_384
#: Decay of the two running statistics of a step, and what keeps its root from zero.
DECAY, SQUARE_DECAY, TINY = 0.9, 0.999, 1e-8
#: A held-out loss must fall by this much to count as better.
TOLERANCE = 1e-4


def size_of(layers: list[int]) -> int:
    return sum(a * b + b for a, b in zip(layers, layers[1:]))


def parts_of(flat: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, offsets) of each layer, views of the flat array."""
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def forward(flat: np.ndarray, layers: list[int], x: np.ndarray) -> list[np.ndarray]:
    """Inputs of every layer, and the probabilities."""
    parts, seen = parts_of(flat, layers), [x]
    for w, b in parts[:-1]:
        seen.append(np.maximum(seen[-1] @ w + b, 0))
    scores = seen[-1] @ parts[-1][0] + parts[-1][1]
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    seen.append(scores / scores.sum(axis=1, keepdims=True))
    return seen


def log_loss(probability: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(np.maximum(probability[np.arange(len(y)), y], 1e-15)).sum())


def gradient(flat: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the mean log loss of a batch."""
    seen = forward(flat, layers, x)
    back = seen[-1].copy()
    back[np.arange(len(y)), y] -= 1
    back /= len(y)
    found = []
    for (w, _), inputs in zip(reversed(parts_of(flat, layers)), reversed(seen[:-1])):
        found.append(np.append((inputs.T @ back).reshape(-1), back.sum(axis=0)))
        back = (back @ w.T) * (inputs > 0)
    return np.concatenate(found[::-1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return pa.concat_arrays([column]).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Perceptron:
    """Network state: layer widths, weights with the two step statistics, and what was trained."""

    layers: list[int]
    rate: float = 0.001
    batch: int = 256
    seed: int = SEED
    state: np.ndarray | None = None  # weights, running mean and running square of their gradients, steps
    steps: int = 0                   # epochs or micro-batches gone through
    last_batch: int = -1
    history: list[float] = field(default_factory=list)  # held-out loss before each epoch
    stop_epoch: int = -1             # the epoch whose weights were kept
    name: str = "perceptron"

    def __post_init__(self):
        if self.state is None:
            draw, flat = np.random.default_rng(self.seed), np.zeros(size_of(self.layers))
            for w, _ in parts_of(flat, self.layers):
                w[...] = draw.uniform(-1, 1, w.shape) * np.sqrt(6 / sum(w.shape))
            self.state = np.concatenate([flat, np.zeros(2 * len(flat) + 1)])

    @property
    def weights(self) -> np.ndarray:
        return self.state[:size_of(self.layers)]

    # --- training ---------------------------------------------------------------------

    def epoch(self, rows: DataFrame, tasks: int | None = None) -> float | None:
        """One pass over (y, x, held), in at most ``tasks`` tasks if given.

        Returns the held-out loss of the weights before it, None without held rows.
        """
        layers, rate, size, width = self.layers, self.rate, self.batch, size_of(self.layers)
        shared, number = rows.sparkSession.sparkContext.broadcast(self.state), self.steps
        seed = self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get().partitionId()
            state, draw = shared.value.copy(), np.random.default_rng([seed, number, task])
            flat, mean, square = state[:width], state[width:2 * width], state[2 * width:3 * width]
            first, learned, held_rows, held_loss = shared.value[:width], 0, 0, 0.0
            for batch in batches:
                x, y = _matrix(batch.column(1), layers[0]), batch.column(0).to_numpy()
                held = batch.column(2).to_numpy(zero_copy_only=False)
                if held.any():
                    held_rows += int(held.sum())
                    held_loss += log_loss(forward(first, layers, x[held])[-1], y[held])
                order = draw.permutation(np.flatnonzero(~held))
                for a in range(0, len(order), size):
                    at = order[a:a + size]
                    g = gradient(flat, layers, x[at], y[at])
                    state[-1] += 1
                    mean *= DECAY
                    mean += (1 - DECAY) * g
                    square *= SQUARE_DECAY
                    square += (1 - SQUARE_DECAY) * g * g
                    step = rate * np.sqrt(1 - SQUARE_DECAY ** state[-1]) / (1 - DECAY ** state[-1])
                    flat -= step * mean / (np.sqrt(square) + TINY)
                learned += len(order)
            yield part_row(task, np.concatenate([state * learned, [learned, held_rows, held_loss]]))

        total = tree_sum(rows.mapInArrow(run, PART), len(self.state) + 3, tasks=tasks)
        shared.unpersist()
        learned, held_rows, held_loss = total[-3:]
        if learned:
            self.state = total[:-3] / learned
        self.steps += 1
        return held_loss / held_rows if held_rows else None

    def prepared(self, df: DataFrame, label_col: str, held_share: float = 0.0,
                 task_rows: int = TASK_ROWS) -> tuple[DataFrame, int]:
        """(y, x, held) in random order, written once, and the number of its parts."""
        rows = df.select(F.col(label_col).cast("int").alias("y"), vector_to_array("features").alias("x"),
                         (F.rand(self.seed + 1) < held_share).alias("held"), F.rand(self.seed).alias("u"))
        parts = max(1, -(-df.count() // task_rows))
        return cut_lineage(rows.repartition(parts, "u").sortWithinPartitions("u").drop("u")), parts

    def fit(self, df: DataFrame, label_col: str, max_epochs: int = 200, patience: int = 15, held_share: float = 0.1) -> "Perceptron":
        """Epochs until the held-out loss has not fallen for ``patience`` of them; the best weights are kept."""
        rows, tasks = self.prepared(df, label_col, held_share)
        best, kept, stale = np.inf, None, 0
        for e in range(max_epochs + 1):
            before = self.state
            loss = self.epoch(rows, tasks)
            if loss is None:  # too few rows to hold any out: all epochs count
                if e == max_epochs:
                    self.state = before
                    self.stop_epoch = e
                continue
            self.history.append(loss)
            if loss < best - TOLERANCE:
                best, kept, stale, self.stop_epoch = loss, before, 0, e
            else:
                stale += 1
            if stale > patience:
                break
        if kept is not None:
            self.state = kept
        return self

    def partial_fit(self, df: DataFrame, label_col: str) -> None:
        """One pass over the rows as they are, in mini-batches; nothing is held out."""
        rows = df.select(F.col(label_col).cast("int").alias("y"), vector_to_array("features").alias("x"), F.lit(False).alias("held"))
        self.epoch(rows)

    # --- use --------------------------------------------------------------------------

    def predict(self, df: DataFrame) -> DataFrame:
        layers, shared = self.layers, df.sparkSession.sparkContext.broadcast(self.weights.copy())

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                x = np.stack(batch.to_numpy()).astype(float) if len(batch) else np.zeros((0, layers[0]))
                yield pd.Series(list(forward(shared.value, layers, x)[-1]), dtype=object)

        out = df.withColumn("probability", probability(vector_to_array("features")))
        return out.withColumn("pred", arrays.argmax(F.col("probability")))

    # --- state ------------------------------------------------------------------------

    def to_meta(self) -> dict:
        """Model-sized, as text."""
        return {**self.__dict__, "state": base64.b64encode(self.state.astype("<f8").tobytes()).decode()}

    @classmethod
    def from_meta(cls, meta: dict) -> "Perceptron":
        return cls(**{**meta, "state": np.frombuffer(base64.b64decode(meta["state"]), "<f8").copy()})

    def save(self, spark: SparkSession, path: str) -> None:
        save_meta(spark, path, self.to_meta())

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Perceptron":
        return cls.from_meta(load_meta(spark, path))
