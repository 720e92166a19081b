"""Preparation, features, models and the two flows, on small literal frames."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.operators import ensemble, features, metrics, models, prep, tuning
from wardline.plans import lifecycle
from wardline.sources import files, state, views


def events(spark, n=200, seed=42):
    rng = random.Random(seed)
    missing = set(rng.sample(range(n), n * 15 // 100))
    rows = [(f"evt_{i}", f"msg {rng.randrange(9)} flow", rng.gauss(0, 1), None if i in missing else rng.gauss(0, 1), rng.choice("ABCDE"),
             f"v{rng.randrange(50)}", rng.randrange(3), rng.choice(["benign", "malicious", "suspicious"])) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, message_sanitized string, num_feat double, num_feat_missing double, "
                                       "cat_feat string, high_card_feat string, dense_cat int, label string")


IDS, TEXTS, LABEL = ["event_id"], ["message_sanitized"], "label"


def test_prep_columns_follow_fit_order_without_gaps(spark):
    df = events(spark)
    model = prep.fit_prep(df, IDS, TEXTS, LABEL)
    out = model.transform(df)
    assert out.columns[-len(model.feature_order):] == model.feature_order
    assert out.where(" OR ".join(f"{c} IS NULL" for c in out.columns)).count() == 0


def test_train_and_test_columns_agree(spark):
    model = prep.fit_prep(events(spark), IDS, TEXTS, LABEL)
    test = events(spark, 50, 7).drop("num_feat_missing", "label").withColumn("extra_col", F.lit(123))
    out = model.transform(test, has_label=False)
    assert "extra_col" not in out.columns and out.columns[-len(model.feature_order):] == model.feature_order
    assert out.agg(F.max(F.abs("num_feat_missing")).alias("m")).first()["m"] == 0


def test_label_codes(spark):
    df = events(spark)
    model = prep.fit_prep(df, IDS, TEXTS, LABEL)
    odd = df.withColumn("label", F.when(F.col("event_id") == "evt_0", "other").otherwise(F.col("label")))
    assert model.labels == ["benign", "malicious", "suspicious"]
    assert {r["label_idx"] for r in model.transform(odd).select("label_idx").distinct().collect()} == {-1, 0, 1, 2}


def test_mostly_missing_column_goes(spark):
    df = events(spark).withColumn("mostly_missing", F.when(F.col("dense_cat") < 0, F.lit(1.0)))
    nan = df.withColumn("all_nan", F.lit(float("nan")))
    assert prep.fit_prep(nan, IDS, TEXTS, LABEL).dropped == ["all_nan", "mostly_missing"]


def test_exact_threshold_keeps_the_column(spark):
    df = spark.createDataFrame([(i, None if i < 6 else 1.0) for i in range(10)], "event_id int, x double")
    assert prep.sparse_columns(df, ["x"], 0.6) == [] and prep.sparse_columns(df, ["x"], 0.59) == ["x"]


def test_prep_state_survives(spark, tmp_path):
    df = events(spark)
    model = prep.fit_prep(df, IDS, TEXTS, LABEL)
    model.save(spark, str(tmp_path / "prep"))
    again = prep.PrepModel.load(spark, str(tmp_path / "prep"))
    assert again == model
    with pytest.raises(Exception):
        prep.PrepModel.load(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        state.load_state(spark, str(tmp_path / "prep"), "features", 1)


def test_missing_ids_are_numbered(spark):
    df = spark.range(100).repartition(7).select(F.col("id").cast("double").alias("x"))
    model = prep.fit_prep(df, ["event_id"], [], None)
    ids = sorted(r["event_id"] for r in model.transform(df, has_label=False).collect())
    assert ids == list(range(100))


def test_read_auto_picks_by_extension(spark, tmp_path):
    df = events(spark, 30)
    df.write.parquet(str(tmp_path / "t.parquet"))
    files.write_csv(df, str(tmp_path / "t.txt"))
    assert files.read_auto(spark, str(tmp_path / "t.parquet")).count() == 30
    assert sorted(map(str, files.read_auto(spark, str(tmp_path / "t.txt"), df.schema).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception):
        files.read_auto(spark, str(tmp_path / "absent.parquet")).count()
    assert files.load_split_source(spark, str(tmp_path), "t.parquet").count() == 30


def feature_rows(spark, n=200, seed=42):
    rng = random.Random(seed)
    rows = [(f"evt_{i}", f"alert {rng.choice(['dns', 'tcp', 'udp'])} port {rng.randrange(20)}", rng.gauss(0, 1), rng.gauss(5, 2),
             rng.choice("XYZ"), f"c{rng.randrange(100)}", rng.randrange(3)) for i in range(n)]
    return spark.createDataFrame(rows, "event_id string, message_sanitized string, num_a double, num_b double, cat_low string, cat_high string, label_idx int")


COLS = ["num_a", "num_b", "cat_low", "cat_high"]


def fit(df, **options):
    return features.fit_features(df, COLS, "event_id", "label_idx", "message_sanitized", high_card=50, max_text_features=40, **options)


def test_feature_names_match_the_vector(spark):
    df = feature_rows(spark)
    model = fit(df)
    vectors = model.assemble(model.transform(df))
    sizes = {r["n"] for r in vectors.select(F.size(vector_to_array("features")).alias("n")).collect()}
    assert sizes == {len(model.feature_names())} and "tfidf_0" in model.feature_names()
    assert vectors.where(F.exists(vector_to_array("features"), lambda v: F.isnan(v))).count() == 0
    assert vectors.count() == 200


def test_interactions_and_absent_columns(spark):
    model = fit(feature_rows(spark))
    test = feature_rows(spark, 50, 3)
    assert model.interaction_columns() == ["inter_num_a_num_b"]
    out = model.transform(test.drop("num_a", "cat_low"))
    centre, width = model.scaler["num_a"]
    assert out.columns[1:5] == ["num_a", "num_b", "cat_high", "cat_low"]
    assert out.select("num_a", "cat_low").distinct().collect()[0]["num_a"] == pytest.approx(-centre / width)
    assert out.agg(F.max("cat_low").alias("m")).first()["m"] == -1.0


@pytest.mark.parametrize("options", [
    {"scaler": "standard", "encoder": "ordinal"}, {"selection": "mutual_info", "max_features": 3},
    {"selection": "model", "threshold": "median", "max_features": 3}, {"pca_features": 2}, {"text_options": {"analyzer": "word", "ngram_range": (1, 2)}},
])
def test_feature_state_survives(spark, tmp_path, options):
    df = feature_rows(spark)
    model = fit(df, **options)
    model.save(spark, str(tmp_path / "f"))
    again = features.FeatureModel.load(spark, str(tmp_path / "f"))
    assert again.feature_names() == model.feature_names()
    a, b = model.assemble(model.transform(df)), again.assemble(again.transform(df))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_unseen_values_get_the_prior(spark):
    df = feature_rows(spark)
    table, prior = features.fit_target(df, "cat_high", "label_idx")
    out = features.encode_values(df.limit(1).withColumn("cat_high", F.lit("new")), "cat_high", table, prior)
    assert out.first()["cat_high"] == pytest.approx(prior)


def model_rows(spark, n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.choice([0, 0, 1, 2])
        rows.append((i, y, [rng.gauss(y * 2, 1), rng.gauss(-y, 1), rng.gauss(0, 1)]))
    df = spark.createDataFrame(rows, "event_id bigint, label_idx int, v array<double>")
    return df.select("event_id", "label_idx", ensemble.array_to_vector("v").alias("features"))


TINY = {"random_forest": {"num_trees": 5, "max_depth": 4}, "logistic": {"max_iter": 20}, "gbt_ovr": {"rounds": 2, "max_depth": 2},
        "mlp": {"hidden": [5], "max_iter": 20}}


def test_metrics_table(spark):
    y, p = [0, 0, 1, 1, 2, 2], [0, 1, 1, 1, 2, 2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, pred int")
    found = {r["metric"]: r["value"] for r in metrics.compute_metrics(df, 3, names=["benign", "malicious", "suspicious"]).collect()}
    assert found["accuracy"] == pytest.approx(5 / 6)
    assert found["f1_macro"] == pytest.approx((2 / 3 + 0.8 + 1) / 3) and found["f1_malicious"] == pytest.approx(0.8)


def test_build_train_vote_stack_save(spark, tmp_path):
    rows = model_rows(spark).persist()
    built = models.build_models(["random_forest", "logistic", "gbt_ovr", "mlp", "not_offered"], TINY)
    assert list(built) == ["random_forest", "logistic", "gbt_ovr", "mlp"]
    trained = {n: models.train_single(n, c, rows, rows) for n, c in built.items()}
    assert all(0 <= v <= 1 for t in trained.values() for v in t.metrics.values())
    found = ensemble.model_set(trained)
    assert found.best_score == max(t.metrics["f1_macro"] for t in trained.values())
    two = {n: built[n] for n in ("random_forest", "logistic")}
    found.stacking = ensemble.train_stacking(two, rows, "label_idx", "event_id", models.Classifier("logistic", {"max_iter": 20}), folds=2)
    found.save(spark, str(tmp_path / "m"))
    again = ensemble.ModelSet.load(spark, str(tmp_path / "m"))
    for options in ({"use_stacking": True}, {}, {"use_ensemble": False}):
        a = {r["event_id"]: r["probability"] for r in found.predict(rows, **options).collect()}
        b = {r["event_id"]: r["probability"] for r in again.predict(rows, **options).collect()}
        assert a == b and all(sum(p) == pytest.approx(1) for p in a.values())
    assert ensemble.build_ensemble({"one": found.singles["logistic"]}) is None


def test_search_prefers_the_better_trial(spark):
    found = tuning.hyper_search("random_forest", model_rows(spark), "label_idx", "event_id", trials=2, fixed={"num_trees": 3, "max_depth": 3})
    assert [f["score"] for f in found] == sorted((f["score"] for f in found), reverse=True)


def test_train_then_score(spark, tmp_path):
    df = events(spark)
    run = lifecycle.train(df, IDS, TEXTS, LABEL, ["random_forest", "logistic"], TINY, resample_method="smote",
                          feature_options={"max_text_features": 20})
    assert {r["dataset"] for r in run.metrics.select("dataset").distinct().collect()} == {"validation"}
    lifecycle.save_run(run, spark, str(tmp_path / "run"))
    scored = lifecycle.score(df.unionByName(df).drop("label"), *lifecycle.load_run(spark, str(tmp_path / "run")))
    assert scored.columns == ["event_id", "pred_label", "prob_benign", "prob_malicious", "prob_suspicious"]
    assert scored.count() == 200


def test_boosted_models_are_explained_by_their_trees(spark):
    from pyspark.ml.functions import array_to_vector
    from wardline.operators import explain, models

    rows = spark.range(300).select("id", (F.col("id") % 3).cast("int").alias("label_idx"), array_to_vector(F.array(
        (F.col("id") % 3).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"))
    model = models.Classifier("gbt_ovr", {"rounds": 3, "max_depth": 3}, 3).fit(rows)
    got = {r.feature: r for r in explain.explain(model, rows, rows, "id", ["own", "other"], ("shap",)).collect()}
    assert {r.method for r in got.values()} == {"shap_tree"}
    assert got["own"].importance > got["other"].importance


def test_the_whole_flow_with_its_report(spark, tmp_path):
    """Search, folds, incremental network, attribution and report tables in one call; scoring in another."""
    events = views.load(spark, "/root/testdata/sf0.001", "soc")
    report = str(tmp_path / "report")
    run = lifecycle.train(
        events, ["event_id", "ts"], ["message_sanitized"], "label", ["random_forest", "logistic"],
        {"random_forest": {"num_trees": 4, "max_depth": 4}, "logistic": {"max_iter": 5}},
        feature_options={"max_text_features": 10, "text_options": {"analyzer": "word", "ngram_range": (1, 1)}}, stacking=True,
        stack_folds=2, search_trials=1, cv_folds=2, incremental={"epochs": 2, "hidden": [8]}, explain_methods=("permutation",),
        explain_limits={"repeats": 1, "max_rows": 40}, report=report)
    said = {(r["model"], r["dataset"]) for r in run.metrics.select("model", "dataset").distinct().collect()}
    assert said == {*[(m, "validation") for m in ("random_forest", "logistic", "voting", "stacking", "incremental", "chosen")],
                    ("random_forest", "folds"), ("logistic", "folds")}
    assert [len(run.searched[n]) for n in ("random_forest", "logistic")] == [1, 0]
    assert run.incremental.steps == 2
    assert spark.read.json(f"{report}/comparison").count() == 6 and spark.read.json(f"{report}/confusion").count() == 9
    assert {r["rows"] for r in spark.read.json(f"{report}/labels").collect()} == {"given", "trained on"}
    assert spark.read.option("header", True).csv(f"{report}/importance/full").count() == len(run.feature_model.feature_names())
    tables = lifecycle.score_files(events.drop("label"), run.prep_model, run.feature_model, run.models, str(tmp_path / "out"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "out/predictions"))
    assert rows.columns == ["event_id", "pred_label", *[c for c in rows.columns if c.startswith("prob_")]] and len(rows.columns) == 5
    assert tables["distribution"].agg(F.sum("n")).first()[0] == rows.count() == 1000 and tables["top_malicious"].count() == 10
