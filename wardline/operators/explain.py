"""Feature attribution: tree path weights, sampled contributions, permutation importance.

All three give ``(feature, importance, std)`` tables; the first two also row-level
contributions ``(id, feature, phi)`` that sum to the score minus its base.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_hex, hash_int
from wardline.operators.metrics import per_class_prf
from wardline.operators.ordering import hash_rank
from wardline.operators.sampling import sample_without_replacement
from wardline.session import cut_lineage, scratch_path, spread

# Draws of the explanation methods. All rows are explained unless ``max_rows`` asks
# for a sample.
BACKGROUND_ROWS = 100
COALITIONS = 100
REPEATS = 5
TARGET_CLASS = 1
# Leaves handled in one pass over the rows; larger models take several passes.
LEAVES_PER_PASS = 20_000
# Features on a path, at most 8, up to which the contributions of a leaf are tabulated, and cells of the table.
TABLE_BITS, TABLE_CELLS = 8, 1 << 22


def limited(df: DataFrame, id_col: str, max_rows: int | None) -> DataFrame:
    return df if max_rows is None else sample_without_replacement(df, id_col, max_rows)


# --- tree contributions --------------------------------------------------------------

def _leaves(spark, model, class_index: int, weights: list[float]) -> list[dict]:
    """Every leaf of the saved trees as value, and per feature its interval and cover share.

    Size follows the model (trees x leaves), not the data.
    """
    path = scratch_path(spark, "trees")
    model.save(path)
    table = spark.read.parquet(f"{path}/data")
    inner = "treeID" in table.columns
    node = "nodeData." if inner else ""
    tree = F.col("treeID") if inner else F.lit(0)
    rows = table.select(
        tree.alias("tree"), *[F.col(f"{node}{c}").alias(c) for c in ("id", "prediction", "impurityStats", "leftChild", "rightChild")],
        F.col(f"{node}split.featureIndex").alias("feature"), F.get(F.col(f"{node}split.leftCategoriesOrThreshold"), F.lit(0)).alias("cut"),
    ).toPandas()
    boosted = len(weights) > 0
    out: list[dict] = []
    for tree_id, nodes in rows.groupby("tree"):
        table_ = {r.id: r for r in nodes.itertuples()}
        cover = {i: (r.impurityStats[0] if boosted else float(sum(r.impurityStats))) for i, r in table_.items()}
        weight = weights[tree_id] if boosted else 1.0 / rows["tree"].nunique()
        todo = [(0, {})]
        while todo:
            i, path_ = todo.pop()
            r = table_[i]
            if r.leftChild < 0:
                value = r.prediction if boosted else r.impurityStats[class_index] / max(cover[i], 1e-12)
                out.append({"value": weight * float(value), "path": path_})
                continue
            low, high, share = path_.get(r.feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((r.leftChild, (low, min(high, r.cut))), (r.rightChild, (max(low, r.cut), high))):
                part = cover[child] / max(cover[i], 1e-12)
                todo.append((child, {**path_, r.feature: (*bounds, share * part)}))
    return out


def _split(on: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of one leaf for the features on its path; ``on``: which of them a row agrees with.

    The weighted sum over coalitions is the integral over t of a product of one linear
    factor per feature on the path, and Gauss-Legendre nodes integrate it exactly.
    """
    t, w = np.polynomial.legendre.leggauss((on.shape[1] + 1) // 2)
    t, w = (t + 1) / 2, w / 2
    factors = share[None, :, None] * (1 - t) + on[:, :, None] * t
    whole = factors.prod(axis=1, keepdims=True)
    return value * (on - share) * ((whole / factors) * w).sum(axis=2)


class _Contributions:
    """Path-dependent Shapley values of rows for some leaves.

    A row takes part in a leaf only by which features on the path it agrees with. For short paths
    the values of all such patterns are tabulated once, a row's patterns are read off the bins of
    its features between the cuts of the trees, and its values are looked up and added. Leaves of
    longer paths, or beyond TABLE_CELLS, are worked out row by row.
    """

    def __init__(self, leaves: list[dict], width: int):
        self.width, self.long = width, []
        short, cells = [], 0
        for leaf in leaves:
            if not leaf["path"]:
                continue
            m = len(leaf["path"])
            fits = m <= TABLE_BITS and cells + m * 2 ** m <= TABLE_CELLS
            cells += m * 2 ** m if fits else 0
            (short if fits else self.long).append(leaf)
        self.count = len(short)
        sizes = np.array([2 ** len(leaf["path"]) for leaf in short], np.int64)
        starts = np.cumsum(sizes) - sizes
        by_feature: dict[int, list[tuple]] = {}
        for i, leaf in enumerate(short):
            feats = list(leaf["path"])
            on = (np.arange(sizes[i])[:, None] >> np.arange(len(feats)) & 1).astype(float)
            phi = _split(on, np.array([leaf["path"][f][2] for f in feats]), leaf["value"])
            for slot, f in enumerate(feats):
                by_feature.setdefault(f, []).append((i, slot, *leaf["path"][f][:2], phi[:, slot]))
        #: per feature: its cuts, its leaves, their bit by bin (the last bin agrees with none), starts in the table, table
        self.features = {}
        for f, found in by_feature.items():
            at = np.array([x[0] for x in found])
            cuts = np.unique([b for x in found for b in x[2:4] if np.isfinite(b)])
            bits = np.zeros((len(cuts) + 2, len(found)), np.uint8)
            for j, (_, slot, low, high, _) in enumerate(found):
                first = 0 if low == -np.inf else int(np.searchsorted(cuts, low)) + 1
                bits[first:int(np.searchsorted(cuts, high)) + 1 if high < np.inf else len(cuts) + 1, j] = 1 << slot
            place = np.cumsum(sizes[at]) - sizes[at]
            self.features[f] = (cuts, at, bits, place.astype(np.int32), np.concatenate([x[4] for x in found]))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        phi = np.zeros((len(x), self.width))
        step = max(1, TABLE_CELLS // 4 // max(self.count, 1))
        for a in range(0, len(x), step):
            part = x[a:a + step]
            patterns = np.zeros((self.count, len(part)), np.uint8)
            for f, (cuts, at, bits, _, _) in self.features.items():
                # NaN and negative infinity lie in no interval
                bins = np.where(part[:, f] > -np.inf, np.searchsorted(cuts, part[:, f]), len(cuts) + 1)
                patterns[at] |= bits.T[:, bins]
            for f, (_, at, _, place, table) in self.features.items():
                phi[a:a + step, f] += table[patterns[at] + place[:, None]].sum(axis=0)
        for leaf in self.long:
            feats = list(leaf["path"])
            low, high, share = (np.array([leaf["path"][f][i] for f in feats]) for i in range(3))
            on = ((x[:, feats] > low) & (x[:, feats] <= high)).astype(float)
            phi[:, feats] += _split(on, share, leaf["value"])
        return phi


def shap_tree(model, df: DataFrame, id_col: str, feature_names: list[str], class_index: int = TARGET_CLASS,
              max_rows: int | None = None, leaves_per_pass: int = LEAVES_PER_PASS) -> tuple[DataFrame, float]:
    """(id, feature, phi) for a forest (class probability) or one boosted model (margin), and the base value."""
    spark = df.sparkSession
    if hasattr(model, "leaves"):
        leaves = model.leaves(class_index)
    else:
        weights = [float(w) for w in model.treeWeights] if type(model).__name__.startswith("GBT") else []
        leaves = _leaves(spark, model, class_index, weights)
    base = sum(leaf["value"] * float(np.prod([p[2] for p in leaf["path"].values()])) for leaf in leaves)
    rows = spread(limited(df, id_col, max_rows).select(id_col, vector_to_array("features").alias("x")))
    width = len(feature_names)
    id_type = df.schema[id_col].dataType.simpleString()
    parts = []
    for start in range(0, len(leaves), leaves_per_pass):
        shared = spark.sparkContext.broadcast(_Contributions(leaves[start:start + leaves_per_pass], width))

        def attribute(batches, shared=shared):
            for batch in batches:
                x = np.stack(batch["x"].to_numpy()).astype(float)
                yield pd.DataFrame({id_col: batch[id_col], "phi": list(shared.value(x))})

        parts.append(rows.mapInPandas(attribute, f"{id_col} {id_type}, phi array<double>"))
    names = F.array(*[F.lit(n) for n in feature_names])
    long = reduce(DataFrame.unionByName, parts).select(id_col, F.posexplode("phi").alias("pos", "phi"))
    if len(parts) > 1:
        long = long.groupBy(id_col, "pos").agg(F.sum("phi").alias("phi"))
    return long.select(id_col, F.element_at(names, F.col("pos") + 1).alias("feature"), "phi"), base


# --- sampled contributions -------------------------------------------------------------

def _score_column(predicted: DataFrame, class_index: int):
    return F.col("probability")[class_index]


def shap_sampling(model, df: DataFrame, background: DataFrame, id_col: str, feature_names: list[str],
                  class_index: int = TARGET_CLASS, max_rows: int | None = None, samples: int = COALITIONS,
                  background_rows: int = BACKGROUND_ROWS, seed=SEED) -> DataFrame:
    """(id, feature, phi, p_row, p_background) for any model.

    Per row and sample: a hash-drawn background row and feature order; features switch
    from background to row one by one, all masked rows are scored by one transform, and
    the change at each switch is the contribution.
    """
    d = len(feature_names)
    rows = spread(limited(df, id_col, max_rows).select(id_col, vector_to_array("features").alias("x")))
    ground = sample_without_replacement(background.select(id_col, "features"), id_col, background_rows)
    # At most ``background_rows`` rows from here on.
    ground = ground.select(
        (F.row_number().over(Window.orderBy(hash_hex(seed, F.col(id_col)), F.col(id_col))) - 1).cast("bigint").alias("b"),
        vector_to_array("features").alias("z"),
    )
    n_ground = min(background_rows, background.count())
    drawn = rows.select(id_col, "x", F.explode(F.sequence(F.lit(1), F.lit(samples))).alias("m"))
    drawn = drawn.withColumn("b", hash_int(seed, F.col(id_col), F.col("m")) % n_ground)
    order = F.array_sort(F.array(*[
        F.struct(hash_hex(seed, F.col(id_col), F.col("m"), F.lit(f)).alias("h"), F.lit(i).alias("f")) for i, f in enumerate(feature_names)
    ]))
    paired = drawn.join(F.broadcast(ground), "b").withColumn("order", F.transform(order, lambda s: s["f"]))
    steps = paired.select(id_col, "m", "x", "z", "order", F.explode(F.sequence(F.lit(0), F.lit(d))).alias("step"))
    masked = F.array(*[
        F.when(F.array_position("order", i) <= F.col("step"), F.col("x")[i]).otherwise(F.col("z")[i]) for i in range(d)
    ])
    scored = model.predict(steps.withColumn("features", array_to_vector(masked)))
    scored = scored.select(id_col, "m", "order", "step", _score_column(scored, class_index).alias("p"))
    path = scored.groupBy(id_col, "m").agg(
        F.first("order").alias("order"), F.sort_array(F.collect_list(F.struct("step", "p"))).alias("s"))
    names = F.array(*[F.lit(n) for n in feature_names])
    change = F.transform(F.sequence(F.lit(1), F.lit(d)), lambda i: F.struct(
        F.element_at(names, F.element_at("order", i) + 1).alias("feature"),
        (F.element_at("s", i + 1)["p"] - F.element_at("s", i)["p"]).alias("phi")))
    long = path.select(id_col, "m", F.explode(change).alias("c"), F.col("s")[d]["p"].alias("p1"), F.col("s")[0]["p"].alias("p0"))
    return long.groupBy(id_col, F.col("c.feature").alias("feature")).agg(
        F.avg("c.phi").alias("phi"), F.avg("p1").alias("p_row"), F.avg("p0").alias("p_background"))


def mean_absolute(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("feature").agg(
        F.avg(F.abs("phi")).alias("importance"), F.stddev_pop(F.abs("phi")).alias("std"))


# --- permutation -----------------------------------------------------------------------

def permutation_importance(model, df: DataFrame, id_col: str, feature_names: list[str], k: int = 3, label_col: str | None = None,
                           repeats: int = REPEATS, max_rows: int | None = None, seed=SEED) -> DataFrame:
    """(feature, importance, std): fall of macro F1 when one feature is permuted.

    Truth is the model's own prediction unless ``label_col`` is given. A permutation joins
    each row with the row of equal rank in another hash order, so it is exact and spread.
    """
    rows = model.predict(limited(df, id_col, max_rows))
    truth = F.col(label_col).cast("int") if label_col else F.col("pred")
    rows = cut_lineage(rows.select(id_col, vector_to_array("features").alias("x"), truth.alias("y"), F.col("pred").alias("pred0")))
    # whole rows are ranked and moved once; of a permutation only ids and values travel
    taking = hash_rank(rows, [], id_col, "rank", f"{seed}|rows").select("rank", "x", "y")
    names = F.array(*[F.lit(n) for n in feature_names])
    shapes = [(i, r) for i in range(len(feature_names)) for r in range(repeats)]
    ones = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.lit(r).alias("r")) for i, r in shapes])).alias("t")
    giving = rows.select(id_col, "x", ones).select("t.*", F.col("x")[F.col("t.f")].alias("value"), F.col(id_col).alias("id"))
    giving = hash_rank(giving, ["f", "r"], "id", "rank", f"{seed}|values", key=F.concat_ws("|", "f", "r", "id")).select(
        "f", "r", "rank", "value")
    swapped = taking.join(giving, "rank")
    vector = F.transform("x", lambda v, i: F.when(i == F.col("f"), F.col("value")).otherwise(v))
    predicted = model.predict(swapped.select("f", "r", "y", array_to_vector(vector).alias("features")))
    cells = predicted.groupBy("f", "r", "y", "pred").agg(F.count("*").alias("n"))
    f1 = _macro_f1(cells, ["f", "r"], k)
    before = per_class_prf(rows.select("y", F.col("pred0").alias("pred")), k).agg(F.avg("f1").alias("whole"))
    drops = f1.join(F.broadcast(before)).withColumn("fall", F.col("whole") - F.col("f1"))
    return drops.groupBy("f").agg(F.avg("fall").alias("importance"), F.stddev_pop("fall").alias("std")).select(
        F.element_at(names, F.col("f") + 1).alias("feature"), "importance", "std")


def _macro_f1(cells: DataFrame, keys: list[str], k: int) -> DataFrame:
    parts = []
    for c in range(k):
        hit = F.sum(F.when((F.col("y") == c) & (F.col("pred") == c), F.col("n")).otherwise(0))
        both = F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)) + F.sum(F.when(F.col("pred") == c, F.col("n")).otherwise(0))
        parts.append(F.coalesce(F.try_divide(2 * hit, both), F.lit(0.0)))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return cells.groupBy(*keys).agg((total / k).alias("f1"))


# --- dispatch --------------------------------------------------------------------------

def explain(model, train: DataFrame, val: DataFrame, id_col: str, feature_names: list[str],
            methods: tuple[str, ...] = ("shap", "permutation"), k: int = 3, **limits) -> DataFrame:
    """Long table (method, feature, importance, std). Tree models use their trees, others sampling.

    A boosted model is explained by the margin of its part for the target class.
    """
    out = []
    rows = {n: limits[n] for n in ("max_rows",) if n in limits}
    for method in methods:
        kind = getattr(model, "kind", "")
        if method == "shap" and (kind in ("random_forest", "leafwise") or kind.startswith("gbt")):
            part = model.parts[TARGET_CLASS if kind.startswith("gbt") else 0]
            phi, _base = shap_tree(part, val, id_col, feature_names, **rows)
            name, table = "shap_tree", mean_absolute(phi)
        elif method == "shap":
            sampled = {n: limits[n] for n in ("samples", "background_rows") if n in limits}
            name, table = "shap_sampling", mean_absolute(shap_sampling(model, val, train, id_col, feature_names, **rows, **sampled))
        elif method == "permutation":
            repeats = {n: limits[n] for n in ("repeats",) if n in limits}
            name, table = "permutation", permutation_importance(model, val, id_col, feature_names, k, **rows, **repeats)
        else:
            continue
        out.append(table.select(F.lit(name).alias("method"), "feature", "importance", "std"))
    return reduce(DataFrame.unionByName, out)


def report_importance(table: DataFrame) -> DataFrame:
    """Contributions if there are any, else permutation importance."""
    rank = F.when(F.col("method").startswith("shap"), 0).otherwise(1)
    best = table.agg(F.min(rank).alias("best"))
    return table.withColumn("rank", rank).join(F.broadcast(best)).where("rank = best").select("feature", "importance", "std")
