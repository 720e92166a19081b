"""Training by mini-batches: over a table, or over the micro-batches of a stream."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import arrays
from wardline.functions.hashing import SEED
from wardline.operators.models import Classifier, Fitted
from wardline.operators.perceptron import Perceptron
from wardline.operators.sampling import shuffle_batches
from wardline.session import cut_lineage
from wardline.sources.state import save_meta

BATCH_SIZE = 1000
EPOCHS = 5


def _partial_gradients(weights: np.ndarray, k: int):
    """Per Arrow batch: the summed gradient of the logistic loss and the row count."""

    def run(batches):
        total, n = np.zeros_like(weights), 0
        for batch in batches:
            if not len(batch):
                continue
            x = np.hstack([np.stack(batch["x"].to_numpy()).astype(float), np.ones((len(batch), 1))])
            scores = x @ weights.T
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), batch["y"].to_numpy()] -= 1.0
            total += p.T @ x
            n += len(batch)
        if n:
            yield pd.DataFrame({"n": [n], "g": [total.ravel()]})

    return run


@dataclass
class SgdLogistic:
    """Multinomial logistic regression, one gradient aggregation per mini-batch.

    State is the weight matrix and the number of the last batch, both model-sized.
    """

    k: int
    width: int
    rate: float = 0.1
    decay: float = 1e-4
    weights: list = field(default_factory=list)
    steps: int = 0
    last_batch: int = -1
    name: str = "logistic"

    def __post_init__(self):
        if not self.weights:
            self.weights = np.zeros((self.k, self.width + 1)).tolist()

    def partial_fit(self, df: DataFrame, label_col: str) -> None:
        w = np.array(self.weights)
        rows = df.select(F.col(label_col).cast("int").alias("y"), vector_to_array("features").alias("x"))
        parts = rows.mapInPandas(_partial_gradients(w, self.k), "n bigint, g array<double>")
        # One row per task, added up per position.
        sums = parts.select("n", F.posexplode("g").alias("i", "g")).groupBy("i").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).collect()
        if not sums:
            return
        gradient = np.zeros(w.size)
        for r in sums:
            gradient[r["i"]] = r["g"] / r["n"]
        self.steps += 1
        step = self.rate / (1.0 + self.decay * self.steps)
        self.weights = (w - step * gradient.reshape(w.shape)).tolist()

    def to_meta(self) -> dict:
        return dict(self.__dict__)

    @classmethod
    def from_meta(cls, meta: dict) -> "SgdLogistic":
        return cls(**meta)

    def predict(self, df: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        scores = [
            F.aggregate(F.zip_with(F.array(*[F.lit(float(v)) for v in row[:-1]]), x, lambda a, b: a * b), F.lit(float(row[-1])), lambda s, v: s + v)
            for row in self.weights
        ]
        out = df.withColumn("probability", arrays.softmax(F.array(*scores)))
        return out.withColumn("pred", arrays.argmax(F.col("probability")))


def incremental_train(df: DataFrame, label_col: str, id_col: str, k: int, width: int, batch_size: int = BATCH_SIZE,
                      epochs: int = EPOCHS, rate: float = 0.1) -> SgdLogistic:
    """Epochs of shuffled mini-batches. Batches are laid out once, each then reads only its own files."""
    spark = df.sparkSession
    model = SgdLogistic(k, width, rate)
    rows = df.select(id_col, label_col, "features")
    batched = shuffle_batches(rows, id_col, batch_size, epochs)
    from wardline.session import scratch_path

    path = scratch_path(spark, "batches")
    batched.repartition("epoch", "batch").write.partitionBy("epoch", "batch").parquet(path)
    laid = spark.read.parquet(path)
    n_batches = laid.agg(F.max("batch").alias("m")).first()["m"] + 1
    for epoch in range(epochs):
        for b in range(n_batches):
            model.partial_fit(laid.where((F.col("epoch") == epoch) & (F.col("batch") == b)), label_col)
    return model


# Hidden layers and rate of the incremental network.
HIDDEN = [256, 128, 64]
RATE = 0.001


def incremental_perceptron(df: DataFrame, label_col: str, k: int, width: int, batch_size: int = BATCH_SIZE, epochs: int = EPOCHS,
                           hidden: list[int] | None = None, rate: float = RATE, state_path: str | None = None,
                           seed: int = SEED) -> Perceptron:
    """Epochs of mini-batches of a rectified-linear network, one job each however many batches there are.

    With ``state_path`` the network is stored after every epoch under its number, and a new
    call goes on from the newest stored one until ``epochs`` are done.
    """
    spark = df.sparkSession
    model = restore(spark, state_path) if state_path else None
    if model is None:
        model = Perceptron([width, *(HIDDEN if hidden is None else hidden), k], rate, batch_size, seed)
    rows, tasks = model.prepared(df, label_col)
    while model.steps < epochs:
        model.epoch(rows, tasks)
        if state_path:
            save_meta(spark, f"{state_path}/batch={model.steps}", model.to_meta())
    return model


def warm_start_mlp(classifier: Classifier, df: DataFrame, label_col: str, previous: Fitted | None) -> Fitted:
    """One more round of perceptron training, starting from the previous weights."""
    params = dict(classifier.params)
    if previous is not None:
        params["start"] = previous.parts[0]
    return Classifier("mlp", params, classifier.k, classifier.seed).fit(df, label_col)


def stream_incremental_train(spark: SparkSession, stream: DataFrame, model, label_col: str, state_path: str, checkpoint: str):
    """Every micro-batch updates the model once, a ``SgdLogistic`` or a ``Perceptron``.

    Weights and batch number are stored together under the number of the batch, so a replayed
    batch is recognised and skipped, a restart goes on from the newest stored model, and a
    crash while storing leaves the model before it.
    """
    stored = restore(spark, state_path)
    if stored is not None and stored.last_batch > model.last_batch:
        model.__dict__.update(stored.__dict__)

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= model.last_batch:
            return
        model.partial_fit(batch, label_col)
        model.last_batch = batch_id
        save_meta(spark, f"{state_path}/batch={batch_id}", model.to_meta())

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return model


def restore(spark: SparkSession, state_path: str) -> SgdLogistic | Perceptron | None:
    """The newest stored model, or None where none is stored yet."""
    try:
        states = spark.read.option("basePath", state_path).text(f"{state_path}/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = states.orderBy(F.col("batch").cast("bigint").desc()).first()
    if newest is None:
        return None
    meta = json.loads(newest["value"])
    return (Perceptron if meta.get("name") == "perceptron" else SgdLogistic).from_meta(meta)
