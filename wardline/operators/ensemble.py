"""Soft voting, out-of-fold stacking, and the choice of the model that scores."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions import arrays
from wardline.operators.models import Classifier, Fitted, Trained
from wardline.operators.sampling import stratified_kfold
from wardline.session import cut_lineage
from wardline.sources.state import load_meta, save_meta

STACK_FOLDS = 5


def mean_probability(columns: list[str]):
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.col(c) for c in columns])
    return F.transform(total, lambda x: x / F.lit(float(len(columns))))


def soft_vote(predictions: dict[str, DataFrame], id_col: str = "event_id") -> DataFrame | None:
    """Mean probability of separately stored prediction tables, joined by id; fewer than two give none."""
    if len(predictions) < 2:
        return None
    parts = [d.select(id_col, F.col("probability").alias(f"__p_{n}")) for n, d in predictions.items()]
    joined = reduce(lambda a, b: a.join(b, id_col), parts)
    out = joined.select(id_col, mean_probability([f"__p_{n}" for n in predictions]).alias("probability"))
    return out.withColumn("pred", arrays.argmax(F.col("probability")))


@dataclass
class VotingModel:
    """Votes inside one projection: no join, as every model reads the same row."""

    members: dict[str, Fitted]

    def predict(self, df: DataFrame) -> DataFrame:
        names = []
        for i, model in enumerate(self.members.values()):
            name = f"__vote{i}"
            df = model.predict(df).drop("pred").withColumnRenamed("probability", name)
            names.append(name)
        out = df.withColumn("probability", mean_probability(names)).drop(*names)
        return out.withColumn("pred", arrays.argmax(F.col("probability")))


def build_ensemble(members: dict[str, Fitted]) -> VotingModel | None:
    return VotingModel(members) if len(members) >= 2 else None


def _stack_features(df: DataFrame, members: list[Fitted], passthrough: bool) -> DataFrame:
    names = []
    for i, model in enumerate(members):
        name = f"__base{i}"
        df = model.predict(df).drop("pred").withColumnRenamed("probability", name)
        names.append(name)
    parts = [F.col(n) for n in names] + ([vector_to_array("features")] if passthrough else [])
    return df.withColumn("meta", F.concat(*parts)).drop(*names)


def stack_oof(bases: dict[str, Classifier], df: DataFrame, label_col: str, id_col: str, folds: int = STACK_FOLDS,
              passthrough: bool = True, parallelism: int = 3) -> DataFrame:
    """Each row once, scored by base models that never saw it: (id, label, fold, meta array).

    Probabilities are attached in the row, so the fold tables only need a union.
    """
    rows = cut_lineage(stratified_kfold(df.select(id_col, label_col, "features"), label_col, id_col, folds))

    def one(f: int) -> DataFrame:
        train, held = rows.where(F.col("fold") != f), rows.where(F.col("fold") == f)
        members = [c.fit(train, label_col) for c in bases.values()]
        return _stack_features(held, members, passthrough).select(id_col, label_col, "fold", "meta")

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(one, range(folds)))
    return reduce(DataFrame.unionByName, parts)


@dataclass
class StackingModel:
    members: dict[str, Fitted]
    final: Fitted
    passthrough: bool = True

    def predict(self, df: DataFrame) -> DataFrame:
        stacked = _stack_features(df, list(self.members.values()), self.passthrough)
        renamed = stacked.withColumnRenamed("features", "__own").withColumn("features", array_to_vector("meta"))
        return self.final.predict(renamed).drop("features", "meta").withColumnRenamed("__own", "features")


def train_stacking(bases: dict[str, Classifier], df: DataFrame, label_col: str, id_col: str, final: Classifier | None = None,
                   folds: int = STACK_FOLDS, passthrough: bool = True) -> StackingModel:
    """Final estimator on out-of-fold probabilities; base models refitted on all rows, side by side with it."""
    final = final or Classifier("logistic", k=next(iter(bases.values())).k)
    meta = cut_lineage(stack_oof(bases, df, label_col, id_col, folds, passthrough))
    with ThreadPoolExecutor(len(bases) + 1) as pool:
        top = pool.submit(final.fit, meta.withColumn("features", array_to_vector("meta")), label_col)
        members = {n: pool.submit(c.fit, df, label_col) for n, c in bases.items()}
        return StackingModel({n: m.result() for n, m in members.items()}, top.result(), passthrough)


@dataclass
class ModelSet:
    """Everything a training run leaves behind."""

    singles: dict[str, Fitted] = field(default_factory=dict)
    voting: VotingModel | None = None
    stacking: StackingModel | None = None
    best_name: str | None = None
    best_score: float = 0.0
    k: int = 3

    def choose(self, use_stacking: bool = False, use_ensemble: bool = True):
        """Stacking, then voting, then the best, then the first model."""
        if use_stacking and self.stacking:
            return self.stacking
        if use_ensemble and self.voting:
            return self.voting
        if self.best_name in self.singles:
            return self.singles[self.best_name]
        return next(iter(self.singles.values()), None)

    def predict(self, df: DataFrame, use_stacking: bool = False, use_ensemble: bool = True) -> DataFrame:
        model = self.choose(use_stacking, use_ensemble)
        if model is None:
            zero = F.array_repeat(F.lit(0.0), self.k)
            return df.withColumn("probability", zero).withColumn("pred", F.lit(0))
        return model.predict(df)

    def save(self, spark: SparkSession, path: str) -> None:
        for name, model in self.singles.items():
            model.save(spark, f"{path}/single_{name}")
        if self.stacking:
            for name, model in self.stacking.members.items():
                model.save(spark, f"{path}/stack_{name}")
            self.stacking.final.save(spark, f"{path}/stack_final")
        save_meta(spark, f"{path}/meta", {
            "best_name": self.best_name, "best_score": self.best_score, "names": list(self.singles), "k": self.k,
            "has_voting": self.voting is not None, "voting": list(self.voting.members) if self.voting else [],
            "has_stacking": self.stacking is not None, "stacking": list(self.stacking.members) if self.stacking else [],
            "passthrough": self.stacking.passthrough if self.stacking else True,
        })

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelSet":
        meta = load_meta(spark, f"{path}/meta")
        singles = {n: Fitted.load(spark, f"{path}/single_{n}") for n in meta["names"]}
        voting = VotingModel({n: singles[n] for n in meta["voting"]}) if meta["has_voting"] else None
        stacking = None
        if meta["has_stacking"]:
            members = {n: Fitted.load(spark, f"{path}/stack_{n}") for n in meta["stacking"]}
            stacking = StackingModel(members, Fitted.load(spark, f"{path}/stack_final"), meta["passthrough"])
        return cls(singles, voting, stacking, meta["best_name"], meta["best_score"], meta["k"])


def model_set(trained: dict[str, Trained], primary: str = "f1_macro", k: int = 3) -> ModelSet:
    from wardline.operators.models import select_best

    singles = {n: t.model for n, t in trained.items()}
    best, _ = select_best(trained, primary)
    return ModelSet(singles, build_ensemble(singles), None, best, trained[best].metrics.get(primary, 0.0), k)
