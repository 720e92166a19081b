"""Classifiers on MLlib behind one small interface: fit, predict, save, load.

Input rows hold ``features`` (vector), an integer label column and an id. ``predict`` adds
``probability`` (array, one value per class) and ``pred``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import arrays
from wardline.operators import metrics
from wardline.operators.leafwise import Leafwise
from wardline.operators.perceptron import Perceptron
from wardline.operators.resample import with_class_weight
from wardline.operators.sampling import stratified_kfold
from wardline.session import spread
from wardline.sources.state import load_meta, save_meta

PRIMARY = "f1_macro"

# Default parameters of each model.
DEFAULTS = {
    "random_forest": {"num_trees": 200, "max_depth": 20, "min_leaf": 4, "balanced": True},
    "gbt_ovr": {"rounds": 200, "max_depth": 8, "step": 0.05, "subsample": 0.8, "columns": "0.8", "balanced": False},
    "gbt_ovr_balanced": {"rounds": 300, "max_depth": 10, "step": 0.05, "subsample": 0.8, "columns": "0.8", "balanced": True},
    "mlp": {"hidden": [256, 128, 64], "batch": 256, "step": 0.001, "max_iter": 200, "patience": 15, "balanced": False},
    "leafwise": {"rounds": 300, "max_depth": 10, "num_leaves": 63, "step": 0.05, "subsample": 0.8, "columns": 0.8, "balanced": True},
    "logistic": {"c": 1.0, "max_iter": 2000, "balanced": True},
}

#: Models that are not MLlib's.
OWN = {"mlp": Perceptron, "leafwise": Leafwise}


def forest(label_col: str, num_trees: int = 200, max_depth: int = 20, min_leaf: int = 4,
           weight_col: str | None = None, seed: int = 42) -> RandomForestClassifier:
    est = RandomForestClassifier(
        labelCol=label_col, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, seed=seed, maxMemoryInMB=1024,
    )
    return est.setWeightCol(weight_col) if weight_col else est


@dataclass
class Fitted:
    """A trained classifier: MLlib models plus how to read probabilities from them."""

    kind: str
    k: int
    parts: list
    params: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` and ``pred``; a per-row projection, whatever the model."""
        if self.kind in OWN:
            return self.parts[0].predict(df)
        if self.kind.startswith("gbt"):
            columns = []
            for i, model in enumerate(self.parts):
                raw, prob, said = f"__raw{i}", f"__prob{i}", f"__said{i}"
                model = model.copy({model.rawPredictionCol: raw, model.probabilityCol: prob, model.predictionCol: said})
                df = model.transform(df).drop(raw, said)
                columns.append(prob)
            scores = F.array(*[vector_to_array(F.col(c))[1] for c in columns])
            out = df.withColumn("probability", arrays.normalise(scores)).drop(*columns)
        else:
            model = self.parts[0]
            model = model.copy({model.rawPredictionCol: "__raw", model.probabilityCol: "__prob", model.predictionCol: "__said"})
            out = model.transform(df).drop("__raw", "__said")
            padding = F.array_repeat(F.lit(0.0), self.k)
            out = out.withColumn("probability", F.slice(F.concat(vector_to_array("__prob"), padding), 1, self.k)).drop("__prob")
        return out.withColumn("pred", arrays.argmax(F.col("probability")))

    def save(self, spark: SparkSession, path: str) -> None:
        for i, model in enumerate(self.parts):
            if self.kind in OWN:
                model.save(spark, f"{path}/part_{i}")
            else:
                model.write().overwrite().save(f"{path}/part_{i}")
        save_meta(spark, f"{path}/meta", {"kind": self.kind, "k": self.k, "n": len(self.parts), "params": self.params})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Fitted":
        meta = load_meta(spark, f"{path}/meta")
        if meta["kind"] in OWN:
            return cls(meta["kind"], meta["k"], [OWN[meta["kind"]].load(spark, f"{path}/part_0")], meta["params"])
        reader = {
            "random_forest": RandomForestClassificationModel, "gbt_ovr": GBTClassificationModel,
            "gbt_ovr_balanced": GBTClassificationModel, "logistic": LogisticRegressionModel,
        }[meta["kind"]]
        return cls(meta["kind"], meta["k"], [reader.load(f"{path}/part_{i}") for i in range(meta["n"])], meta["params"])


@dataclass
class Classifier:
    """A named model with parameters, not yet trained."""

    kind: str
    params: dict = field(default_factory=dict)
    k: int = 3
    seed: int = 42

    def settings(self) -> dict:
        return {**DEFAULTS[self.kind], **self.params}

    def fit(self, df: DataFrame, label_col: str = "label_idx", features: str = "features") -> Fitted:
        p = self.settings()
        kept = spread(df.select(F.col(label_col).cast("double").alias("__y"), F.col(features).alias("features"))).persist()
        try:
            weight = "__w" if p.get("balanced") else None
            return self._fit(with_class_weight(kept, "__y", "__w") if weight else kept, p, weight)
        finally:
            kept.unpersist()

    def _fit(self, kept: DataFrame, p: dict, weight: str | None) -> Fitted:
        if self.kind == "random_forest":
            est = forest("__y", p["num_trees"], p["max_depth"], p["min_leaf"], weight, self.seed)
            return Fitted(self.kind, self.k, [est.fit(kept)], p)
        if self.kind.startswith("gbt"):
            return Fitted(self.kind, self.k, self._fit_one_vs_rest(kept, p, weight), p)
        if self.kind == "mlp":
            start = p.get("start")
            if start is None:
                width = kept.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
                start = Perceptron([width, *p["hidden"], self.k], p["step"], p["batch"], self.seed)
            own = Perceptron.from_meta({**start.to_meta(), "history": [], "stop_epoch": -1})
            own.fit(kept, "__y", p["max_iter"], p["patience"])
            return Fitted(self.kind, self.k, [own], {**p, "start": None})
        if self.kind == "leafwise":
            sizes = {n: p[n] for n in ("rounds", "max_depth", "num_leaves", "step", "subsample", "columns")}
            return Fitted(self.kind, self.k, [Leafwise(self.k, seed=self.seed, **sizes).fit(kept, "__y", weight)], p)
        if self.kind == "logistic":
            est = LogisticRegression(
                labelCol="__y", featuresCol="features", family="multinomial", maxIter=p["max_iter"],
                regParam=1.0 / (p["c"] * max(kept.count(), 1)), standardization=False,
            )
            est = est.setWeightCol(weight) if weight else est
            return Fitted(self.kind, self.k, [est.fit(kept)], p)
        raise ValueError(f"unknown model {self.kind}")

    def _fit_one_vs_rest(self, rows: DataFrame, p: dict, weight: str | None) -> list:
        """One binary boosting per class, trained side by side over one cached input."""
        def one(c: int):
            binary = rows.withColumn("__one", (F.col("__y") == c).cast("double"))
            est = GBTClassifier(
                labelCol="__one", featuresCol="features", maxIter=p["rounds"], maxDepth=p["max_depth"], stepSize=p["step"],
                subsamplingRate=p["subsample"], featureSubsetStrategy=p["columns"], seed=self.seed + c, maxMemoryInMB=1024,
            )
            return (est.setWeightCol(weight) if weight else est).fit(binary)

        with ThreadPoolExecutor(self.k) as pool:
            return list(pool.map(one, range(self.k)))


def build_models(names: list[str], params: dict[str, dict] | None = None, k: int = 3, seed: int = 42) -> dict[str, Classifier]:
    """Configured models by name; names that are not offered are skipped."""
    return {n: Classifier(n, (params or {}).get(n, {}), k, seed) for n in names if n in DEFAULTS}


def probability_columns(df: DataFrame, k: int) -> tuple[DataFrame, list[str]]:
    names = [f"p_{i}" for i in range(k)]
    return df.select("*", *[F.col("probability")[i].alias(n) for i, n in enumerate(names)]), names


def evaluate(predicted: DataFrame, label_col: str, k: int, names: list[str] | None = None) -> dict[str, float]:
    slim, probs = probability_columns(predicted.select(F.col(label_col).alias("y"), "pred", "probability"), k)
    table = metrics.compute_metrics(slim, k, probs, names=names)
    return {r["metric"]: r["value"] for r in table.collect()}


@dataclass
class Trained:
    model: Fitted
    metrics: dict[str, float]
    train_time: float


def train_single(name: str, classifier: Classifier, train: DataFrame, val: DataFrame, label_col: str = "label_idx") -> Trained:
    start = time.monotonic()
    model = classifier.fit(train, label_col)
    elapsed = time.monotonic() - start
    return Trained(model, evaluate(model.predict(val), label_col, classifier.k), elapsed)


def weighted_f1(table: dict[int, tuple[float, int]]) -> float:
    total = sum(n for _, n in table.values())
    return sum(f * n for f, n in table.values()) / total if total else 0.0


def fold_scores(predicted: DataFrame, label_col: str, k: int) -> dict[str, float]:
    """Accuracy, macro and weighted F1 of one fold from its k x k counts."""
    slim = predicted.select(F.col(label_col).alias("y"), "pred")
    cells = {(r["y"], r["pred"]): r["n"] for r in metrics.confusion_matrix(slim, k).collect()}
    total = sum(cells.values())
    f1, support = [], []
    for c in range(k):
        truth = sum(cells[c, p] for p in range(k))
        said = sum(cells[y, c] for y in range(k))
        f1.append(2 * cells[c, c] / (truth + said) if truth + said else 0.0)
        support.append(truth)
    return {
        "accuracy": sum(cells[c, c] for c in range(k)) / total if total else 0.0,
        "f1_macro": sum(f1) / k,
        "f1_weighted": sum(f * n for f, n in zip(f1, support)) / total if total else 0.0,
    }


def cross_validate(classifier: Classifier, df: DataFrame, label_col: str, id_col: str, folds: int = 5,
                   parallelism: int = 2) -> dict[str, float]:
    """Mean and population standard deviation of the fold scores, plus elapsed seconds."""
    start = time.monotonic()
    rows = stratified_kfold(df, label_col, id_col, folds).persist()

    def one(f: int) -> dict[str, float]:
        model = classifier.fit(rows.where(F.col("fold") != f), label_col)
        return fold_scores(model.predict(rows.where(F.col("fold") == f)), label_col, classifier.k)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(one, range(folds)))
    finally:
        rows.unpersist()
    out: dict[str, float] = {}
    for name in scores[0]:
        values = [s[name] for s in scores]
        mean = sum(values) / folds
        out[f"{name}_mean"] = mean
        out[f"{name}_std"] = (sum((v - mean) ** 2 for v in values) / folds) ** 0.5
    out["elapsed"] = time.monotonic() - start
    return out


def select_best(trained: dict[str, Trained], primary: str = PRIMARY) -> tuple[str, Fitted]:
    name = min(trained, key=lambda n: (-trained[n].metrics.get(primary, 0.0), n))
    return name, trained[name].model
