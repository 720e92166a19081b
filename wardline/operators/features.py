"""Scaling, encoding, interactions, selection and the feature model that joins them."""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSizeHint, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators import ordering, prep, sparsefeat, textfeat
from wardline.operators.joins import HEAVY, lookup, with_heavy
from wardline.session import cut_lineage
from wardline.sources.state import load_state, save_state

# Encoder and interaction settings.
SMOOTHING = 10.0
MIN_SAMPLES_LEAF = 20.0
TOP_INTERACTIONS = 100
MI_BINS = 10
STATE_VERSION = 1


# --- scaling -------------------------------------------------------------------

def fit_robust(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """column -> (median, interquartile range); a zero range becomes 1."""
    found = ordering.exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return {c: (q[1] or 0.0, ((q[2] or 0.0) - (q[0] or 0.0)) or 1.0) for c, q in found.items()}


def fit_standard(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """column -> (mean, population standard deviation); zero becomes 1."""
    if not cols:
        return {}
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    return {c: (row[c]["m"] or 0.0, row[c]["s"] or 1.0) for c in cols}


def scaled(df: DataFrame, col: str, stats: tuple[float, float]) -> Column:
    """A column missing from ``df`` is 0 before scaling."""
    raw = F.col(col).cast("double") if col in df.columns else F.lit(0.0)
    return ((raw - F.lit(stats[0])) / F.lit(stats[1])).alias(col)


def scale(df: DataFrame, stats: dict[str, tuple[float, float]], keep: list[str]) -> DataFrame:
    return df.select(*keep, *[scaled(df, c, s) for c, s in stats.items()])


# --- encoders ------------------------------------------------------------------

def _text_value(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(prep.UNKNOWN))


def fit_target(df: DataFrame, col: str, y: str, smoothing: float = SMOOTHING,
               min_samples: float = MIN_SAMPLES_LEAF) -> tuple[DataFrame, float]:
    """Value table (value, code) and the prior: the mean label shrunk to the prior by rarity."""
    prior = float(df.agg(F.avg(F.col(y).cast("double")).alias("p")).first()["p"] or 0.0)
    stats = df.groupBy(_text_value(col).alias("value")).agg(
        F.count("*").cast("double").alias("n"), F.avg(F.col(y).cast("double")).alias("mean")
    )
    weight = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(float(min_samples))) / F.lit(float(smoothing))))
    code = F.lit(prior) * (1.0 - weight) + F.col("mean") * weight
    return with_heavy(stats, "n").select("value", code.alias("code"), HEAVY), prior


def fit_ordinal(df: DataFrame, col: str, small_rows: int = ordering.SMALL_ROWS) -> DataFrame:
    """Value table (value, code): 0..k-1 in value order, for any number of values."""
    counts = with_heavy(df.groupBy(_text_value(col).alias("value")).agg(F.count("*").alias("n")), "n")
    values = cut_lineage(counts.select("value", HEAVY, F.lit(1).cast("bigint").alias("one")))
    ranked = ordering.running_sums(values.drop(HEAVY), [], ["value"], {"one": "rank"}, small_rows)
    heavy = values.where(HEAVY).select("value", HEAVY)  # a fixed number at most
    return ranked.join(F.broadcast(heavy), "value", "left").select(
        "value", (F.col("rank") - 1).cast("double").alias("code"), F.coalesce(HEAVY, F.lit(False)).alias(HEAVY))


def fit_low_card(df: DataFrame, cols: list[str], threshold: int = prep.HIGH_CARD_THRESHOLD) -> dict[str, list[str]]:
    """column -> sorted values. One pass over the rows for all columns; refuses a column over the threshold."""
    if not cols:
        return {}
    texts = df.select(*[_text_value(c).alias(c) for c in cols])
    found = cut_lineage(texts.unpivot([], cols, "column", "value").distinct())
    sizes = {r["column"]: r["n"] for r in found.groupBy("column").agg(F.count("*").alias("n")).collect()}
    wide = [c for c, n in sizes.items() if n > threshold + 1]
    if wide:
        raise ValueError(f"too many values for a low-cardinality column: {wide}")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in found.collect():
        out[r["column"]].append(r["value"])
    return {c: sorted(v, key=lambda s: s.encode("utf-8")) for c, v in out.items()}


def encode_values(df: DataFrame, col: str, table: DataFrame, default: float, small: bool = False) -> DataFrame:
    """Replace ``col`` by its code from a (value, code) table; unseen values get the default."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(default))
    keyed = df.withColumn("__value", _text_value(col))
    marks = [HEAVY] if HEAVY in table.columns else []
    codes = table.select(F.col("value").alias("__value"), F.col("code").alias("__code"), *marks)
    out = lookup(keyed, codes, "__value", {"__code": default}, small=small)
    return out.withColumn(col, F.col("__code")).drop("__value", "__code")


def low_card_table(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "value string, code double")


# --- interactions ----------------------------------------------------------------

def interaction_name(a: str, b: str) -> str:
    return f"inter_{a}_{b}"


def _or_zero(df: DataFrame, c: str) -> Column:
    return F.col(c).cast("double") if c in df.columns else F.lit(0.0)


def pairwise_products(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    pairs = itertools.combinations(cols, 2)
    return df.select(*keep, *[(_or_zero(df, a) * _or_zero(df, b)).alias(interaction_name(a, b)) for a, b in pairs])


def interaction_variances(df: DataFrame, cols: list[str]) -> dict[tuple[str, str], float]:
    """Sample variance of every pairwise product in one pass.

    The products of a row are unfolded and combined before the shuffle, so the plan is the
    same for any number of columns. A product with a missing factor is left out.
    """
    pairs = list(itertools.combinations(cols, 2))
    if not pairs:
        return {}
    products = F.array(*[_or_zero(df, a) * _or_zero(df, b) for a, b in pairs])
    rows = df.select(F.posexplode(products).alias("i", "p")).groupBy("i").agg(F.var_samp("p").alias("v")).collect()
    found = {r["i"]: r["v"] or 0.0 for r in rows}
    return {pair: found.get(i, 0.0) for i, pair in enumerate(pairs)}


def interaction_top_k(df: DataFrame, cols: list[str], k: int = TOP_INTERACTIONS, id_col: str | None = None,
                      first_rows: int | None = None) -> list[tuple[str, str, float]]:
    """The k products of highest variance, names breaking ties; all rows unless ``first_rows`` is given."""
    rows = df if first_rows is None else df.orderBy(id_col).limit(first_rows)
    found = interaction_variances(rows, cols)
    ranked = sorted(found.items(), key=lambda e: (-e[1], interaction_name(*e[0])))
    return [(a, b, v) for (a, b), v in ranked[:k]]


# --- selection -------------------------------------------------------------------

def mutual_information(df: DataFrame, cols: list[str], y: str, bins: int = MI_BINS) -> DataFrame:
    """(feature, importance): mutual information in nats of the binned column with the label.

    Bins come from exact quantiles, the bin being the number of cut points below the value.
    """
    cuts = ordering.exact_quantiles(df, cols, [i / bins for i in range(1, bins)])
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 reduce(lambda a, b: a + b, [(F.lit(q) < F.col(c)).cast("int") for q in cuts[c]]).alias("bin"))
        for c in cols
    ])
    joint = (
        df.select(F.explode(cells).alias("cell"), F.col(y).alias("y")).select("cell.*", "y")
        .groupBy("feature", "bin", "y").agg(F.count("*").alias("n"))
    )
    # At most bins x classes rows per feature from here on.
    by_bin = joint.groupBy("feature", "bin").agg(F.sum("n").alias("nb"))
    by_label = joint.groupBy("feature", "y").agg(F.sum("n").alias("ny"))
    total = joint.groupBy("feature").agg(F.sum("n").alias("nt"))
    full = joint.join(by_bin, ["feature", "bin"]).join(by_label, ["feature", "y"]).join(total, "feature")
    d = lambda c: F.col(c).cast("double")
    part = d("n") / d("nt") * F.log(d("n") * d("nt") / (d("nb") * d("ny")))
    return full.groupBy("feature").agg(F.sum(part).alias("importance"))


def select_by_mutual_info(df: DataFrame, cols: list[str], y: str, max_features: int) -> DataFrame:
    return mutual_information(df, cols, y).orderBy(F.desc("importance"), "feature").limit(max_features)


def select_by_model(df: DataFrame, cols: list[str], y: str, threshold: str | float = "mean",
                    max_features: int = 500, num_trees: int = 50, max_depth: int = 10, seed: int = 42,
                    assembled: bool = False) -> DataFrame:
    """(feature, importance) of a balanced forest: at least the threshold, at most ``max_features``.

    ``assembled``: the columns are already the cells of a vector ``features``.
    """
    from wardline.operators.models import forest
    from wardline.operators.resample import with_class_weight

    vectors = df.select(y, "features") if assembled else assemble(df.select(y, *cols), cols, out="features")
    rows = with_class_weight(vectors, y, "weight")
    model = forest(y, num_trees=num_trees, max_depth=max_depth, min_leaf=1, weight_col="weight", seed=seed).fit(rows)
    scores = sorted(zip(cols, model.featureImportances.toArray()), key=lambda e: (-e[1], e[0]))
    values = np.array([v for _, v in scores])
    cut = {"mean": values.mean(), "median": np.median(values)}.get(threshold, threshold)
    kept = [(c, float(v)) for c, v in scores if v >= cut][:max_features]
    return df.sparkSession.createDataFrame(kept, "feature string, importance double")


def fit_pca(df: DataFrame, cols: list[str], max_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, components by column, explained variance shares); the largest loading is positive.

    The covariance is one aggregation; only the columns-by-columns matrix reaches the driver.
    """
    vectors = assemble(df.select(*cols), cols, out="raw")
    n = min(max_features, len(cols), max(df.count() - 1, 1))
    centred = StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False).fit(vectors)
    pca = PCA(k=n, inputCol="centred", outputCol="pca").fit(centred.transform(vectors))
    components = pca.pc.toArray()
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(n)])
    return centred.mean.toArray(), components * signs, pca.explainedVariance.toArray()


def pca_project(df: DataFrame, cols: list[str], means, components, keep: list[str]) -> DataFrame:
    out = []
    for i in range(components.shape[1]):
        terms = [(_or_zero(df, c) - F.lit(float(m))) * F.lit(float(w)) for c, m, w in zip(cols, means, components[:, i])]
        out.append(reduce(lambda a, b: a + b, terms).alias(f"pca_{i}"))
    return df.select(*keep, *out)


def select_columns(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Selected columns in order, absent ones 0."""
    return df.select(*keep, *[_or_zero(df, c).alias(c) for c in cols])


# --- assembly --------------------------------------------------------------------

def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def sparse_vector(size: int):
    """Column function (indices, weights) -> sparse vector of the given size, batch by batch."""
    @F.arrow_udf(VectorUDT())
    def make(indices: pa.Array, weights: pa.Array) -> pa.Array:
        # the stored form of a sparse vector: type 0, its size, filled cells and their values
        n = len(indices)
        return pa.StructArray.from_arrays([
            pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), indices, weights],
            names=["type", "size", "indices", "values"])

    return make


@dataclass
class FeatureModel:
    """Fitted feature engineering. Value tables stay DataFrames; everything else is small."""

    id_col: str
    scaler: dict[str, tuple[float, float]]
    encoders: dict[str, tuple[DataFrame, float]]
    low_card: dict[str, list[str]]
    interactions: list[tuple[str, str]]
    text_col: str | None = None
    vocabulary: DataFrame | None = None
    vocabulary_size: int = 0
    text_options: dict = field(default_factory=dict)
    selected: list[str] | None = None
    pca: dict | None = None

    def base_columns(self) -> list[str]:
        return [*self.scaler, *self.encoders, *self.low_card]

    def interaction_columns(self) -> list[str]:
        return [interaction_name(a, b) for a, b in self.interactions]

    def text_columns(self) -> list[str]:
        return [f"tfidf_{i}" for i in range(self.vocabulary_size)] if self.vocabulary is not None else []

    def offered(self) -> list[str]:
        """Everything that selection and components choose from, in final order, first duplicate kept."""
        return list(dict.fromkeys([*self.base_columns(), *self.text_columns(), *self.interaction_columns()]))

    def scalar_columns(self) -> list[str]:
        """Named scalar outputs in final order, text excluded, first duplicate kept."""
        if self.pca and self.vocabulary is None:
            return [f"pca_{i}" for i in range(len(self.pca["components"][0]))]
        if self.selected is not None and self.vocabulary is None:
            return list(self.selected)
        return list(dict.fromkeys([*self.base_columns(), *self.interaction_columns()]))

    def feature_names(self) -> list[str]:
        """Names of the cells of the assembled vector."""
        if self.pca:
            return [f"pca_{i}" for i in range(len(self.pca["components"][0]))]
        return list(self.selected) if self.selected is not None else self.offered()

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Scalar feature columns by name plus the sparse text arrays.

        The arrays are made in the row, so only they and the encoded columns go through the
        lookups, never the text.
        """
        kept = [c for c in [self.id_col, *(keep or [])] if c in df.columns]
        used = [c for c in dict.fromkeys([*kept, *self.base_columns()]) if c in df.columns]
        text = []
        if self.vocabulary is not None:
            column = textfeat.tfidf_column(self.vocabulary, F.col(self.text_col), **self.text_options)
            df = df.select(*used, column.alias("__tfidf")).select(*used, "__tfidf.indices", "__tfidf.weights")
            text = ["indices", "weights"]
        out = df.select(*used, *text)
        for c, (table, default) in self.encoders.items():
            out = encode_values(out, c, table, default)
        for c, values in self.low_card.items():
            out = encode_values(out, c, low_card_table(df.sparkSession, values), -1.0, small=True)
        out = out.select(
            *kept, *text, *[scaled(out, c, s) for c, s in self.scaler.items()],
            *[prep.coerce_numeric(F.col(c)).alias(c) for c in [*self.encoders, *self.low_card]],
        )
        products = [(_or_zero(out, a) * _or_zero(out, b)).alias(interaction_name(a, b)) for a, b in self.interactions]
        out = out.select("*", *products)
        if self.selected is not None and not text:
            out = select_columns(out, self.selected, [*kept, *text])
        if self.pca and not text:
            out = pca_project(out, self.pca["columns"], self.pca["means"], np.array(self.pca["components"]), [*kept, *text])
        return out.select(*[c for c in out.columns if c not in text], *text)

    def assemble(self, features: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """One vector per row, its cells named by ``feature_names``; text stays sparse inside it.

        Beside text, selection slices the whole vector and components are projected from it.
        """
        kept = [self.id_col, *(keep or [])]
        if self.vocabulary is None:
            return assemble(features, self.scalar_columns()).select(*kept, "features")
        if self.pca:
            scores = sparsefeat.project(np.array(self.pca["means"]), np.array(self.pca["components"]), features.sparkSession)
            cells = self.cells(features, kept)
            return cells.select(*kept, array_to_vector(scores("indices", "values")).alias("features"))
        whole = self._whole(features).select(*kept, "features")
        if self.selected is None:
            return whole
        place = {n: i for i, n in enumerate(self.offered())}
        slicer = VectorSlicer(inputCol="features", outputCol="__picked", indices=[place[n] for n in self.selected])
        return slicer.transform(whole).select(*kept, F.col("__picked").alias("features"))

    def _whole(self, features: DataFrame) -> DataFrame:
        """``features``: everything offered as one vector."""
        inputs = self.scalar_columns()
        vector = sparse_vector(self.vocabulary_size)(
            F.coalesce("indices", F.array().cast("array<int>")), F.coalesce("weights", F.array().cast("array<double>")))
        hint = VectorSizeHint(inputCol="__text", size=self.vocabulary_size, handleInvalid="optimistic")
        features = hint.transform(features.withColumn("__text", vector))
        cut = len(self.base_columns())
        return assemble(features, inputs[:cut] + ["__text"] + inputs[cut:])

    def cells(self, features: DataFrame, kept: list[str]) -> DataFrame:
        """``kept`` with ``indices`` and ``values`` of the filled cells of everything offered, in order of columns."""
        place = {n: i for i, n in enumerate(self.offered())}
        first = len(self.base_columns())
        scalars = self.scalar_columns()
        before, after = ([c for c in scalars if (place[c] < first) == side] for side in (True, False))
        as_doubles = lambda names: F.array(*[F.col(c).cast("double") for c in names]).cast("array<double>")
        at = lambda names: F.array(*[F.lit(place[c]) for c in names]).cast("array<int>")
        text = F.coalesce("indices", F.array().cast("array<int>")), F.coalesce("weights", F.array().cast("array<double>"))
        return features.select(
            *kept, F.concat(at(before), F.transform(text[0], lambda i: (i + first).cast("int")), at(after)).alias("indices"),
            F.concat(as_doubles(before), text[1], as_doubles(after)).alias("values"))

    def save(self, spark: SparkSession, path: str) -> None:
        state = {
            "id_col": self.id_col, "scaler": self.scaler, "low_card": self.low_card,
            "encoders": {c: default for c, (_, default) in self.encoders.items()},
            "interactions": self.interactions, "text_col": self.text_col, "vocabulary_size": self.vocabulary_size,
            "text_options": self.text_options, "selected": self.selected, "pca": self.pca,
            "has_vocabulary": self.vocabulary is not None,
        }
        save_state(spark, f"{path}/state", "features", STATE_VERSION, state)
        for i, (table, _) in enumerate(self.encoders.values()):
            table.write.mode("overwrite").parquet(f"{path}/encoder_{i}")
        if self.vocabulary is not None:
            self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        s = load_state(spark, f"{path}/state", "features", STATE_VERSION)
        encoders = {
            c: (spark.read.parquet(f"{path}/encoder_{i}"), default) for i, (c, default) in enumerate(s["encoders"].items())
        }
        vocabulary = spark.read.parquet(f"{path}/vocabulary") if s["has_vocabulary"] else None
        return cls(
            id_col=s["id_col"], scaler={c: tuple(v) for c, v in s["scaler"].items()}, encoders=encoders,
            low_card=s["low_card"], interactions=[tuple(p) for p in s["interactions"]], text_col=s["text_col"],
            vocabulary=vocabulary, vocabulary_size=s["vocabulary_size"], text_options=s["text_options"],
            selected=s["selected"], pca=s["pca"],
        )


def fit_features(df: DataFrame, cols: list[str], id_col: str, y: str | None = None, text_col: str | None = None, *,
                 scaler: str = "robust", encoder: str = "target", high_card: int = prep.HIGH_CARD_THRESHOLD,
                 target_cols: list[str] | None = None, top_interactions: int = TOP_INTERACTIONS,
                 first_rows: int | None = None, text_options: dict | None = None, min_df: int = textfeat.MIN_DF,
                 max_text_features: int = textfeat.MAX_FEATURES, selection: str | None = None,
                 threshold: str | float = "mean", max_features: int = 500, pca_features: int | None = None) -> FeatureModel:
    """Fit every part of the feature model. Interactions are ranked on raw values."""
    roles = prep.profile_columns(df, cols, high_card)
    numeric = [c for c in cols if roles[c] == "numeric"]
    high = [c for c in cols if roles[c] == "high_card"]
    if target_cols is not None:
        high = [c for c in cols if c in target_cols or c in high]
    low = [c for c in cols if roles[c] == "low_card" and c not in high]
    encoders: dict[str, tuple[DataFrame, float]] = {}
    for c in high:
        if encoder == "target" and y is not None:
            encoders[c] = fit_target(df, c, y)
        else:
            encoders[c] = (fit_ordinal(df, c), -1.0)
    options = text_options or {}
    vocabulary, size = None, 0
    if textfeat.has_text(df, text_col):
        vocabulary = textfeat.fit_vocabulary(df, text_col, min_df=min_df, max_features=max_text_features, **options)
        size = vocabulary.count()
    model = FeatureModel(
        id_col=id_col, scaler={"robust": fit_robust, "standard": fit_standard}[scaler](df, numeric), encoders=encoders,
        low_card=fit_low_card(df, low, high_card), text_col=text_col if vocabulary is not None else None,
        interactions=[(a, b) for a, b, _ in interaction_top_k(df, numeric, top_interactions, id_col, first_rows)],
        vocabulary=vocabulary, vocabulary_size=size, text_options=options,
    )
    if selection or pca_features:
        kept = [y] if y else []
        out = model.transform(df, kept)
        scalars, offered = model.scalar_columns(), model.offered()
        if selection == "model":
            if vocabulary is None:
                found = select_by_model(out, scalars, y, threshold, max_features)
            else:
                found = select_by_model(model._whole(out), offered, y, threshold, max_features, assembled=True)
            model.selected = [r["feature"] for r in found.collect()]
        elif selection == "mutual_info":
            table = mutual_information(out, scalars, y)
            if vocabulary is not None:
                table = table.union(sparsefeat.presence_information(out, y, model.text_columns()))
            model.selected = [r["feature"] for r in table.orderBy(F.desc("importance"), "feature").limit(max_features).collect()]
        if pca_features and vocabulary is None:
            names = model.scalar_columns()
            means, components, _ = fit_pca(select_columns(out, names, []), names, pca_features)
            model.pca = {"columns": names, "means": means.tolist(), "components": components.tolist()}
        elif pca_features:
            chosen = offered if model.selected is None else model.selected
            taken = np.isin(offered, chosen)  # columns that were not selected take no part
            means, components, _ = sparsefeat.sparse_pca(
                model.cells(out, []).select("indices", "values"), len(offered), pca_features, taken)
            model.pca = {"columns": chosen, "means": means.tolist(), "components": components.tolist()}
    return model
