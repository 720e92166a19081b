"""Guided search over the published search spaces.

The first trials are seeded draws. Later ones come from densities of the parameters of good and of
other trials: of some candidates drawn like the good ones, the one that looks least like the others
is tried. A trial that is behind after a fold gets no further folds.
"""

from __future__ import annotations

import hashlib
import time
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_unit
from wardline.operators.models import Classifier, fold_scores
from wardline.operators.sampling import stratified_kfold
from wardline.session import cut_lineage

MAX_TRIALS = 50
MAX_SECONDS = 3600
SEARCH_FOLDS = 3
#: Trials before densities guide, share of trials that are good, candidates of a guided trial,
#: trials that run at the same time.
STARTUP, GOOD, CANDIDATES, ABREAST = 10, 0.25, 24, 2

# Search space as (parameter, kind, low, high).
SPACES = {
    "gbt_ovr": [
        ("n_estimators", "int", 100, 500), ("max_depth", "int", 3, 15), ("learning_rate", "log", 0.01, 0.3),
        ("subsample", "float", 0.6, 1.0), ("colsample", "float", 0.6, 1.0),
    ],
    "gbt_ovr_balanced": [
        ("n_estimators", "int", 100, 600), ("max_depth", "int", 3, 15), ("learning_rate", "log", 0.01, 0.3),
        ("num_leaves", "int", 15, 127), ("subsample", "float", 0.6, 1.0), ("colsample", "float", 0.6, 1.0),
    ],
    "leafwise": [
        ("n_estimators", "int", 100, 600), ("max_depth", "int", 3, 15), ("learning_rate", "log", 0.01, 0.3),
        ("num_leaves", "int", 15, 127), ("subsample", "float", 0.6, 1.0), ("colsample", "float", 0.6, 1.0),
    ],
    "random_forest": [
        ("n_estimators", "int", 100, 500), ("max_depth", "int", 5, 30), ("min_samples_split", "int", 2, 20),
        ("min_samples_leaf", "int", 1, 10),
    ],
}


def search_space(spark: SparkSession, kind: str, trials: int = MAX_TRIALS, seed=SEED) -> DataFrame:
    """(trial, param, value): seeded draws; an unknown model has an empty space."""
    space = SPACES.get(kind, [])
    table = spark.createDataFrame([(p, t, float(a), float(b)) for p, t, a, b in space],
                                  "param string, kind string, low double, high double")
    drawn = spark.range(trials).select(F.col("id").alias("trial")).join(F.broadcast(table))
    u = hash_unit(seed, F.lit(kind), F.col("trial"), F.col("param"))
    low, high = F.col("low"), F.col("high")
    value = (
        F.when(F.col("kind") == "int", F.least(F.floor(low + u * (high - low + 1.0)).cast("double"), high))
        .when(F.col("kind") == "log", F.exp(F.log(low) + u * (F.log(high) - F.log(low))))
        .otherwise(low + u * (high - low))
    )
    return drawn.select("trial", "param", value.alias("value"))


def to_params(kind: str, drawn: dict[str, float]) -> dict:
    """Search-space names to parameters of the trainers; every drawn value has an effect.

    MLlib limits depth to 30. Where it has no such setting, a node of fewer than
    ``min_samples_split`` rows stays whole because its sides would be too small, and the
    number of leaves is bounded by the depth.
    """
    depth = int(min(drawn["max_depth"], 30))
    if kind == "random_forest":
        least = max(int(drawn["min_samples_leaf"]), -(-int(drawn["min_samples_split"]) // 2))
        return {"num_trees": int(drawn["n_estimators"]), "max_depth": depth, "min_leaf": least}
    out = {"rounds": int(drawn["n_estimators"]), "max_depth": depth, "step": drawn["learning_rate"], "subsample": drawn["subsample"]}
    if kind == "leafwise":
        return {**out, "num_leaves": int(drawn["num_leaves"]), "columns": drawn["colsample"]}
    if "num_leaves" in drawn:
        out["max_depth"] = min(depth, int(drawn["num_leaves"]).bit_length() - 1)
    return {**out, "columns": str(round(drawn["colsample"], 6))}


def _to_unit(how: str, low: float, high: float, value: float) -> float:
    if how == "log":
        return float(np.log(value / low) / np.log(high / low))
    return (value - low) / (high - low)


def _from_unit(how: str, low: float, high: float, u: float) -> float:
    if how == "log":
        return float(low * (high / low) ** u)
    value = low + u * (high - low)
    return float(round(value)) if how == "int" else float(value)


def _log_density(at: np.ndarray, centres: np.ndarray, width: float) -> np.ndarray:
    """Of a mixture of normal bumps on [0, 1] and a flat part that counts as one bump."""
    bumps = np.exp(-0.5 * ((at[:, None] - centres[None, :]) / width) ** 2) / (width * np.sqrt(2 * np.pi))
    return np.log((bumps.sum(axis=1) + 1.0) / (len(centres) + 1.0))


def propose(kind: str, done: list[dict], trial: int, seed=SEED) -> dict[str, float]:
    """Parameters of a guided trial; ``done`` has ``drawn`` and ``score`` of the trials before it."""
    draw = np.random.default_rng(int(hashlib.md5(f"{seed}|{kind}|{trial}|guided".encode()).hexdigest()[:15], 16))
    ranked = sorted(done, key=lambda r: (-r["score"], r["trial"]))
    n_good = max(2, int(np.ceil(GOOD * len(ranked))))
    out = {}
    for name, how, low, high in SPACES[kind]:
        good, rest = (np.array([_to_unit(how, low, high, r["drawn"][name]) for r in part]) for part in (ranked[:n_good], ranked[n_good:]))
        width = float(np.clip(good.std(), 0.05, 0.3))
        flat = draw.random(CANDIDATES) < 1.0 / (n_good + 1)
        near = np.clip(good[draw.integers(0, n_good, CANDIDATES)] + draw.normal(0, width, CANDIDATES), 0, 1)
        at = np.where(flat, draw.random(CANDIDATES), near)
        best = int(np.argmax(_log_density(at, good, width) - _log_density(at, rest, max(width, 0.1))))
        out[name] = _from_unit(how, low, high, float(at[best]))
    return out


def search(kind: str, first: dict[int, dict[str, float]], trials: int, folds: int, score: Callable[[dict, int], float],
           max_seconds: float = MAX_SECONDS, seed=SEED, abreast: int = ABREAST) -> list[dict]:
    """Trials in order: ``trial``, ``drawn``, ``score`` (mean of its folds) and ``folds`` (how many it got).

    ``score(drawn, fold)`` is one job; trials of a group run side by side. After each fold only the
    better half of a group, and whoever is above the median of all finished trials at that fold, goes on.
    """
    done: list[dict] = []
    start = time.monotonic()
    with ThreadPoolExecutor(abreast) as pool:
        while len(done) < trials:
            if time.monotonic() - start > max_seconds:
                warnings.warn(f"search of {kind} ended after {len(done)} of {trials} trials: {max_seconds} s were over", stacklevel=2)
                break
            numbers = range(len(done), min(trials, len(done) + abreast))
            group = [{"trial": t, "drawn": first[t] if t < STARTUP or len(done) < 4 else propose(kind, done, t, seed), "scores": []} for t in numbers]
            going = group
            for fold in range(folds):
                for r, value in zip(going, pool.map(lambda r: score(r["drawn"], fold), going)):
                    r["scores"].append(value)
                mean = lambda r: sum(r["scores"][:fold + 1]) / (fold + 1)
                past = sorted(mean(r) for r in done if len(r["scores"]) > fold)
                bar = past[len(past) // 2] if past else -np.inf
                ranked = sorted(going, key=lambda r: -mean(r))
                going = [r for i, r in enumerate(ranked) if i < -(-len(ranked) // 2) or mean(r) >= bar]
            for r in group:
                done.append({**r, "score": sum(r["scores"]) / len(r["scores"]), "folds": len(r["scores"])})
    return done


def hyper_search(kind: str, df: DataFrame, label_col: str, id_col: str, k: int = 3, trials: int = MAX_TRIALS,
                 max_seconds: float = MAX_SECONDS, fixed: dict | None = None, seed=SEED) -> list[dict]:
    """Trials with their macro F1 over up to 3 folds, those of all folds first, best first. Empty for a model without a space.

    The folds are laid out once and stored; each fold of a trial is one training job.
    """
    if kind not in SPACES:
        return []
    first: dict[int, dict[str, float]] = {}
    for r in search_space(df.sparkSession, kind, trials, seed).collect():
        first.setdefault(r["trial"], {})[r["param"]] = r["value"]
    rows = cut_lineage(stratified_kfold(df.select(id_col, label_col, "features"), label_col, id_col, SEARCH_FOLDS))

    def score(drawn: dict[str, float], fold: int) -> float:
        model = Classifier(kind, {**to_params(kind, drawn), **(fixed or {})}, k).fit(rows.where(F.col("fold") != fold), label_col)
        return fold_scores(model.predict(rows.where(F.col("fold") == fold)), label_col, k)["f1_macro"]

    found = search(kind, first, trials, SEARCH_FOLDS, score, max_seconds, seed)
    out = [{"trial": r["trial"], "params": {**to_params(kind, r["drawn"]), **(fixed or {})}, "score": r["score"], "folds": r["folds"]}
           for r in found]
    return sorted(out, key=lambda r: (-r["folds"], -r["score"], r["trial"]))
