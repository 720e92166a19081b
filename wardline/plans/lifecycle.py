"""The two end-to-end flows: prepare and train, load and score."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import ensemble, explain, features, metrics, models, ordering, prep, resample, sampling, tuning
from wardline.operators.perceptron import Perceptron
from wardline.session import cut_lineage, scratch_path
from wardline.sources import files
from wardline.streaming.incremental import incremental_perceptron

STATE_PREP, STATE_FEATURES, STATE_MODELS = "prep", "features", "models"


def prepare(df: DataFrame, id_cols, text_cols, label_col, val_size: float = sampling.VAL_SIZE, fit_on: str = "train",
            path: str | None = None) -> tuple[str, prep.PrepModel]:
    """Split, fit and transform, written once as a table partitioned by split.

    Statistics come from the training side only; ``fit_on='all'`` uses every row. The input
    is stored first, as the fits pass over it several times. Rows without the first id column
    are numbered under its name.
    """
    df = cut_lineage(df)
    if id_cols[0] not in df.columns:
        df = cut_lineage(ordering.dense_index(df, id_cols[0]))
    tagged = sampling.stratified_split(df, label_col, id_cols[0], val_size)
    basis = df if fit_on == "all" else tagged.where("split = 'train'").drop("split")
    model = prep.fit_prep(basis, id_cols, text_cols, label_col)
    rows = model.transform(tagged, keep=("split",))
    path = path or scratch_path(df.sparkSession, "prepared")
    files.write_splits(rows, path)
    return path, model


@dataclass
class Run:
    """What training leaves behind. ``tables`` holds the report: written where a path was given."""

    prep_model: prep.PrepModel
    feature_model: features.FeatureModel
    models: ensemble.ModelSet
    metrics: DataFrame
    incremental: Perceptron | None = None
    searched: dict[str, list[dict]] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)


def train(df: DataFrame, id_cols, text_cols, label_col, names: list[str], params: dict[str, dict] | None = None,
          resample_method: str | None = None, feature_options: dict | None = None, stacking: bool = False,
          stack_folds: int = ensemble.STACK_FOLDS, fit_on: str = "train", search_trials: int = 0, cv_folds: int = 0,
          incremental: dict | None = None, explain_methods: tuple[str, ...] = (), explain_limits: dict | None = None,
          report: str | None = None) -> Run:
    """Raw events to fitted preparation, features and models, with validation metrics per model.

    Optional steps, in this order: a parameter search per model (``search_trials``), scores over
    ``cv_folds`` folds of the training rows, an ``incremental`` network with these options, the
    attribution of the model that scores. ``report`` is a folder for the tables of the run.
    """
    spark = df.sparkSession
    path, prep_model = prepare(files.dedup_rows(df), id_cols, text_cols, label_col, fit_on=fit_on)
    rows = spark.read.parquet(path)
    train_rows, val_rows = rows.where("split = 'train'"), rows.where("split = 'val'")
    id_col, text_col = id_cols[0], text_cols[0] if text_cols else None
    feature_model = features.fit_features(
        train_rows, prep_model.feature_order, id_col, "label_idx", text_col, **(feature_options or {})
    )
    k, params = len(prep_model.labels), dict(params or {})

    def vectors(part: DataFrame) -> DataFrame:
        out = feature_model.transform(part, ["label_idx"])
        return feature_model.assemble(out, ["label_idx"])

    x_train, x_val = vectors(train_rows).persist(), vectors(val_rows).persist()
    try:
        fit_rows = x_train
        if resample_method:
            balanced = _balanced(x_train, id_col, resample_method)
            fit_rows = balanced.withColumn("features", ensemble.array_to_vector("features"))
        if resample_method or cv_folds or search_trials:
            fit_rows = cut_lineage(fit_rows)
        searched = {}
        for name in names if search_trials else []:
            searched[name] = tuning.hyper_search(name, fit_rows, "label_idx", id_col, k, search_trials, fixed=params.get(name))
            if searched[name]:
                params[name] = searched[name][0]["params"]
        offered = models.build_models(names, params, k)
        trained = {name: models.train_single(name, c, fit_rows, x_val) for name, c in offered.items()}
        scored = {name: t.metrics for name, t in trained.items()}
        folds = {name: models.cross_validate(c, fit_rows, "label_idx", id_col, cv_folds) for name, c in offered.items()} if cv_folds else {}
        found = ensemble.model_set(trained, k=k)
        if found.voting:
            scored["voting"] = models.evaluate(found.voting.predict(x_val), "label_idx", k)
        if stacking:
            found.stacking = ensemble.train_stacking(models.build_models(names, params, k), fit_rows, "label_idx", id_col, folds=stack_folds)
            scored["stacking"] = models.evaluate(found.stacking.predict(x_val), "label_idx", k)
        net = None
        if incremental is not None:
            net = incremental_perceptron(fit_rows, "label_idx", k, len(feature_model.feature_names()), **incremental)
            scored["incremental"] = models.evaluate(net.predict(x_val), "label_idx", k)
        chosen = found.choose(stacking)
        said = cut_lineage(chosen.predict(x_val).select(id_col, "label_idx", "pred", "probability"))
        scored["chosen"] = models.evaluate(said, "label_idx", k)

        def long(part: dict, kind: str) -> list[tuple]:
            return [(name, kind, metric, float(v)) for name, m in part.items() for metric, v in m.items()]

        table = spark.createDataFrame(long(scored, "validation") + long(folds, "folds"),
                                      "model string, dataset string, metric string, value double")
        tables = {"metrics": table}
        if report or explain_methods:
            tables |= _report(table, said, x_train, fit_rows, k)
        if explain_methods:
            importance = explain.explain(chosen, fit_rows, x_val, id_col, feature_model.feature_names(), explain_methods, k,
                                         **(explain_limits or {}))
            tables["importance"] = cut_lineage(explain.report_importance(importance))
        if report:
            for name, part in tables.items():
                if name == "importance":
                    files.write_importance(part, f"{report}/{name}")
                else:
                    files.write_metrics(part, f"{report}/{name}")
        return Run(prep_model, feature_model, found, table, net, searched, tables)
    finally:
        x_train.unpersist()
        x_val.unpersist()


def _report(table: DataFrame, said: DataFrame, before: DataFrame, after: DataFrame, k: int) -> dict[str, DataFrame]:
    """Tables behind the charts of a run: the models side by side, the chosen one by class, the labels."""
    slim, probs = models.probability_columns(said.select(F.col("label_idx").alias("y"), "pred", "probability"), k)
    share = lambda rows, side: rows.groupBy("label_idx").agg(F.count("*").alias("n")).select(F.lit(side).alias("rows"), "label_idx", "n")
    return {
        "comparison": metrics.model_comparison(table.where("dataset = 'validation'")),
        "confusion": metrics.confusion_matrix(slim, k),
        "per_class": metrics.per_class_prf(slim, k),
        "labels": cut_lineage(share(before, "given").unionByName(share(after, "trained on"))),
    }


def _balanced(rows: DataFrame, id_col: str, method: str) -> DataFrame:
    """Resampled training rows. Resampling numbers its new rows, so text ids are replaced by numbers first."""
    rows = rows.select(id_col, "label_idx", models.vector_to_array("features").alias("features"))
    if not isinstance(rows.schema[id_col].dataType, T.IntegralType):
        rows = ordering.dense_index(cut_lineage(rows.drop(id_col)), id_col)
    return resample.resample(rows, "label_idx", id_col, "features", method)


def save_run(run: Run, spark: SparkSession, path: str) -> None:
    run.prep_model.save(spark, f"{path}/{STATE_PREP}")
    run.feature_model.save(spark, f"{path}/{STATE_FEATURES}")
    run.models.save(spark, f"{path}/{STATE_MODELS}")


def load_run(spark: SparkSession, path: str) -> tuple[prep.PrepModel, features.FeatureModel, ensemble.ModelSet]:
    return (
        prep.PrepModel.load(spark, f"{path}/{STATE_PREP}"),
        features.FeatureModel.load(spark, f"{path}/{STATE_FEATURES}"),
        ensemble.ModelSet.load(spark, f"{path}/{STATE_MODELS}"),
    )


def score(df: DataFrame, prep_model, feature_model, model_set, dedup: bool = True, use_stacking: bool = False,
          use_ensemble: bool = True, probabilities: bool = True) -> DataFrame:
    """(event_id, pred_label[, prob_*]); every step but the dedup also runs on a stream."""
    rows = files.dedup_rows(df) if dedup else df
    prepared = prep_model.transform(rows, has_label=False)
    vectors = feature_model.assemble(feature_model.transform(prepared))
    predicted = model_set.predict(vectors, use_stacking, use_ensemble)
    out = [feature_model.id_col, prep.decode_label(F.col("pred"), prep_model.labels).alias("pred_label")]
    if probabilities:
        out += [F.col("probability")[i].alias(f"prob_{c}") for i, c in enumerate(prep_model.labels)]
    return predicted.select(*out)


def score_files(df: DataFrame, prep_model, feature_model, model_set, path: str, top: int = 10, **options) -> dict[str, DataFrame]:
    """Scores written as CSV, with how often each label was said and the rows most likely malicious.

    The scores are computed once; both tables read the stored ones.
    """
    scored = cut_lineage(score(df, prep_model, feature_model, model_set, **options))
    files.write_predictions(scored, f"{path}/predictions", feature_model.id_col)
    tables = {"distribution": metrics.prediction_distribution(scored)}
    if "prob_malicious" in scored.columns:
        tables["top_malicious"] = metrics.top_malicious(scored, top, feature_model.id_col)
    for name, table in tables.items():
        files.write_csv(table, f"{path}/{name}")
    return tables
