"""Model, ensemble, explanation and streaming queries.

Trained models have no row-by-row SQL; these queries report invariants, and the SQL states
what they must be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions import arrays
from wardline.functions.hashing import sql_hash_unit
from wardline.operators import ensemble, explain, features, models, prep, resample, sampling, tuning
from wardline.operators.perceptron import Perceptron
from wardline.plans import lifecycle
from wardline.plans.common import FRAME_NUMERIC, soc, soc_frame
from wardline.plans.registry import query, r6, violations
from wardline.session import cut_lineage, scratch_path, spread
from wardline.sources import views
from wardline.streaming import activity, incremental, scoring

K = 3
ENCODED = ["product_name", "pipeline"]
MODEL_COLS = FRAME_NUMERIC + ENCODED
# Sizes of the trained models in registered queries; operators default to the full ones.
SMALL = {
    "random_forest": {"num_trees": 20, "max_depth": 8},
    "gbt_ovr": {"rounds": 5, "max_depth": 4},
    "gbt_ovr_balanced": {"rounds": 5, "max_depth": 5},
    "mlp": {},
    "leafwise": {"rounds": 5},
    "logistic": {"max_iter": 50},
}


def event_vectors(spark, folder) -> DataFrame:
    """(event_id, label_idx, features) of every event: scaled numbers and coded categories."""
    # a few large files must not leave most cores idle; stored, as the fits and every training pass over the rows
    frame = cut_lineage(spread(soc_frame(spark, folder).select("event_id", "label_idx", *MODEL_COLS)))
    out = frame
    for c, values in features.fit_low_card(frame, ENCODED).items():
        out = features.encode_values(out, c, features.low_card_table(spark, values), -1.0, small=True)
    stats = features.fit_standard(out, MODEL_COLS)
    return features.assemble(features.scale(out, stats, ["event_id", "label_idx"]), MODEL_COLS).select("event_id", "label_idx", "features")


def both_sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = sampling.stratified_split(event_vectors(spark, folder), "label_idx", "event_id")
    rows = rows.persist()
    return rows.where("split = 'train'"), rows.where("split = 'val'")


def small(kind: str) -> models.Classifier:
    return models.Classifier(kind, SMALL[kind], K)


def bad_prediction():
    """Probabilities must be k numbers in [0, 1] with sum 1, the prediction their first maximum."""
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    inside = F.forall(p, lambda x: (x >= -1e-9) & (x <= 1 + 1e-9))
    fine = (F.size(p) == K) & inside & (F.abs(total - 1) < 1e-6) & (F.col("pred") == F.array_position(p, F.array_max(p)) - 1)
    return ~F.coalesce(fine, F.lit(False))


VAL_ROWS = views.ctes("soc") + """, sizes AS (SELECT label, count(*) AS n FROM soc GROUP BY label)
SELECT CAST(sum(floor(n * 0.15 + 0.5)) AS BIGINT) AS n_rows, 0 AS n_violations, 1 AS beats_majority FROM sizes"""


def model_report(predicted: DataFrame) -> DataFrame:
    """Rows, broken predictions, and whether macro F1 is well above that of saying the largest class always."""
    known = predicted.select("label_idx", "pred", bad_prediction().alias("bad"))
    cells = known.groupBy("label_idx", "pred").agg(F.count("*").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("bad")).collect()
    total = sum(r["n"] for r in cells)
    truth = {c: sum(r["n"] for r in cells if r["label_idx"] == c) for c in range(K)}
    said = {c: sum(r["n"] for r in cells if r["pred"] == c) for c in range(K)}
    hits = {c: sum(r["n"] for r in cells if r["label_idx"] == r["pred"] == c) for c in range(K)}
    f1 = sum(2 * hits[c] / max(truth[c] + said[c], 1) for c in range(K)) / K
    guess = 2 * max(truth.values()) / max(max(truth.values()) + total, 1) / K
    return predicted.sparkSession.createDataFrame(
        [(total, sum(r["bad"] for r in cells), int(f1 > guess + 0.1))], "n_rows long, n_violations long, beats_majority int")


def _register(kind: str):
    @query(kind, VAL_ROWS)
    def run(spark, folder):
        train, val = both_sides(spark, folder)
        return model_report(small(kind).fit(train).predict(val))


for _kind in ("random_forest", "gbt_ovr", "gbt_ovr_balanced"):
    _register(_kind)


@query("mlp", VAL_ROWS.replace("1 AS beats_majority", "1 AS beats_majority, 1 AS stopped_in_time"))
def _(spark, folder):
    """Full size; the kept epoch is the one of the lowest held-out loss."""
    train, val = both_sides(spark, folder)
    model = small("mlp").fit(train)
    net = model.parts[0]
    kept = net.stop_epoch >= 1 and net.history[net.stop_epoch] <= min(net.history) + 2e-4 * len(net.history)
    return model_report(model.predict(val)).withColumn("stopped_in_time", F.lit(int(kept)))


@query("leafwise", VAL_ROWS.replace("1 AS beats_majority", "1 AS beats_majority, 1 AS loss_falls, 0 AS n_bad_trees"))
def _(spark, folder):
    """Full trees of 63 leaves and depth 10, fewer rounds; the loss falls with every round."""
    train, val = both_sides(spark, folder)
    model = small("leafwise").fit(train)
    net = model.parts[0]
    falls = all(b < a for a, b in zip(net.losses, net.losses[1:]))
    bad = sum(sum(f < 0 for f in t.feature) > 63 or len(t.feature) != 2 * sum(f < 0 for f in t.feature) - 1
              for trees in net.trees for t in trees)
    return model_report(model.predict(val)).withColumns({"loss_falls": F.lit(int(falls)), "n_bad_trees": F.lit(bad)})


@query("train_single", "SELECT 15 AS n_metrics, 0 AS n_out_of_range, 1 AS has_time")
def _(spark, folder):
    train, val = both_sides(spark, folder)
    run = models.train_single("random_forest", small("random_forest"), train, val)
    table = spark.createDataFrame([(m, float(v)) for m, v in run.metrics.items()], "metric string, value double")
    return table.agg(
        F.count("*").alias("n_metrics"), F.count(F.when(~F.col("value").between(0, 1), 1)).alias("n_out_of_range"),
        F.lit(int(run.train_time > 0)).alias("has_time"))


@query("cross_validate", "SELECT 6 AS n_scores, 0 AS n_out_of_range")
def _(spark, folder):
    found = models.cross_validate(small("random_forest"), event_vectors(spark, folder), "label_idx", "event_id", folds=5)
    rows = [(m, float(v)) for m, v in found.items() if m != "elapsed"]
    return spark.createDataFrame(rows, "score string, value double").agg(
        F.count("*").alias("n_scores"), F.count(F.when(~F.col("value").between(0, 1), 1)).alias("n_out_of_range"))


@query("hyper_search", "SELECT 2 AS n_trials, 1 AS best_first, 0 AS n_unsupported")
def _(spark, folder):
    rows = event_vectors(spark, folder)
    found = tuning.hyper_search("random_forest", rows, "label_idx", "event_id", K, trials=2, fixed={"num_trees": 10, "max_depth": 6})
    scores = [(f["folds"], f["score"]) for f in found]
    nothing = tuning.hyper_search("mlp", rows, "label_idx", "event_id", K, trials=2)
    return spark.createDataFrame([(len(found), int(scores == sorted(scores, reverse=True)), len(nothing))],
                                 "n_trials int, best_first int, n_unsupported int")


def sql_space() -> str:
    parts = []
    for kind, space in tuning.SPACES.items():
        for name, how, low, high in space:
            u = sql_hash_unit("42", f"'{kind}'", "trial", f"'{name}'")
            value = {
                "int": f"least(CAST(floor({low} + {u} * ({high} - {low} + 1)) AS DOUBLE), {high})",
                "log": f"exp(ln({low}::DOUBLE) + {u} * (ln({high}::DOUBLE) - ln({low}::DOUBLE)))",
                "float": f"{low}::DOUBLE + {u} * ({high}::DOUBLE - {low}::DOUBLE)",
            }[how]
            parts.append(f"SELECT '{kind}' AS model, CAST(trial AS BIGINT) AS trial, '{name}' AS param, round({value}, 6) AS value FROM trials")
    return "WITH trials AS (SELECT unnest(range((SELECT count(*) FROM region))) AS trial) " + " UNION ALL ".join(parts)


@query("search_space", sql_space())
def _(spark, folder):
    """As many trials per model as there are regions."""
    trials = spark.read.parquet(f"{folder}/region.parquet").count()
    parts = [tuning.search_space(spark, kind, trials).select(F.lit(kind).alias("model"), "trial", "param", r6("value").alias("value"))
             for kind in tuning.SPACES]
    return reduce(DataFrame.unionByName, parts)


@query("voting_model", VAL_ROWS)
def _(spark, folder):
    train, val = both_sides(spark, folder)
    members = {n: small(n).fit(train) for n in ("random_forest", "gbt_ovr")}
    return model_report(ensemble.build_ensemble(members).predict(val))


BASES = ("random_forest", "logistic")


@query("stack_oof", "SELECT count(*) AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Every row once; each block of probabilities sums to 1; own features follow."""
    rows = event_vectors(spark, folder)
    meta = ensemble.stack_oof({n: small(n) for n in BASES}, rows, "label_idx", "event_id", folds=3)
    total = lambda i: F.aggregate(F.slice("meta", 1 + K * i, K), F.lit(0.0), lambda a, x: a + x)
    wrong = (F.abs(total(0) - 1) > 1e-6) | (F.abs(total(1) - 1) > 1e-6) | (F.size("meta") != 2 * K + len(MODEL_COLS))
    per_id = meta.select("event_id", wrong.alias("bad")).groupBy("event_id").agg(F.max("bad").alias("bad"), F.count("*").alias("n"))
    return violations(per_id, F.col("bad") | (F.col("n") != 1))


@query("stacking", VAL_ROWS)
def _(spark, folder):
    train, val = both_sides(spark, folder)
    model = ensemble.train_stacking({n: small(n) for n in BASES}, train, "label_idx", "event_id", small("logistic"), folds=3)
    return model_report(model.predict(val))


@query("predict_priority", "SELECT 'stacking' AS asked, 'StackingModel' AS used UNION ALL SELECT 'voting', 'VotingModel' UNION ALL SELECT 'best', 'logistic' UNION ALL SELECT 'none', 'zeros'")
def _(spark, folder):
    """Which model answers, checked on predictions of all events."""
    rows = event_vectors(spark, folder).persist()
    singles = {n: small(n).fit(rows) for n in BASES}
    voting = ensemble.build_ensemble(singles)
    final = small("logistic").fit(rows)
    stack = ensemble.StackingModel(singles, final, False)
    full = ensemble.ModelSet(singles, voting, stack, "logistic", 1.0, K)
    used = [("stacking", type(full.choose(use_stacking=True)).__name__), ("voting", type(full.choose()).__name__),
            ("best", full.choose(use_ensemble=False).kind)]
    zero = ensemble.ModelSet(k=K).predict(rows).agg(F.max(F.array_max("probability")).alias("m"), F.count("*").alias("n")).first()
    used.append(("none", "zeros" if zero["m"] == 0.0 and zero["n"] > 0 else "something"))
    return spark.createDataFrame(used, "asked string, used string")


@query("model_roundtrip", "SELECT 2 * count(*) AS n_rows, 0 AS n_violations, 'random_forest' AS best_name FROM events")
def _(spark, folder):
    """A saved and loaded model set gives the same probabilities for every event, by vote and by stack."""
    rows = event_vectors(spark, folder).persist()
    singles = {n: small(n).fit(rows) for n in BASES}
    stack = ensemble.train_stacking({n: small(n) for n in BASES}, rows, "label_idx", "event_id", small("logistic"), folds=3)
    kept = ensemble.ModelSet(singles, ensemble.build_ensemble(singles), stack, "random_forest", 1.0, K)
    path = scratch_path(spark, "models")
    kept.save(spark, path)
    again = ensemble.ModelSet.load(spark, path)
    said = lambda models, out, **use: models.predict(rows, **use).select("event_id", F.col("probability").alias(out))
    both = [said(kept, "a", **use).join(said(again, "b", **use), "event_id") for use in ({}, {"use_stacking": True})]
    gap = F.exists(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), lambda d: d > 1e-12)
    return violations(both[0].unionByName(both[1]), gap).withColumn("best_name", F.lit(again.best_name))


@query("incremental_train", "SELECT count(*) AS n_rows, 0 AS n_violations, 1 AS beats_majority FROM events")
def _(spark, folder):
    rows = event_vectors(spark, folder).persist()
    size = -(-rows.count() // 8)
    model = incremental.incremental_train(rows, "label_idx", "event_id", K, len(MODEL_COLS), size, epochs=3, rate=0.5)
    return model_report(model.predict(rows))


@query("incremental_perceptron", "SELECT count(*) AS n_rows, 0 AS n_violations, 1 AS beats_majority, 1 AS resumed FROM events")
def _(spark, folder):
    """Two epochs, then a second call that goes on from the stored network for three more."""
    rows = event_vectors(spark, folder)
    state = scratch_path(spark, "perceptron")
    first = incremental.incremental_perceptron(rows, "label_idx", K, len(MODEL_COLS), 250, 2, state_path=state)
    model = incremental.incremental_perceptron(rows, "label_idx", K, len(MODEL_COLS), 250, 5, state_path=state)
    resumed = model.steps == 5 and model.state[-1] > first.state[-1] > 0
    return model_report(model.predict(rows)).withColumn("resumed", F.lit(int(resumed)))


@query("stream_perceptron", "SELECT count(*) AS n_rows, 0 AS n_violations, 1 AS trained FROM events")
def _(spark, folder):
    rows = event_vectors(spark, folder)
    stream, state = _stream_of(spark, rows, 4), scratch_path(spark, "perceptron")
    net = Perceptron([len(MODEL_COLS), *incremental.HIDDEN, K], incremental.RATE, 250)
    incremental.stream_incremental_train(spark, stream, net, "label_idx", state, scratch_path(spark, "stream-state"))
    model = incremental.restore(spark, state)
    out = violations(model.predict(rows), bad_prediction())
    return out.withColumn("trained", F.lit(int(model.steps == 4 and model.last_batch == 3)))


@query("incremental_mlp", "SELECT count(*) AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Two warm-started rounds on the two sides of a split."""
    train, val = both_sides(spark, folder)
    brief = models.Classifier("mlp", {"max_iter": 10}, K)
    first = incremental.warm_start_mlp(brief, train, "label_idx", None)
    second = incremental.warm_start_mlp(brief, val, "label_idx", first)
    return violations(second.predict(train.unionByName(val)), bad_prediction())


# --- explanation ---------------------------------------------------------------------

@query("shap_tree", "SELECT count(*) AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Contributions of every event sum to its probability minus the base."""
    rows = event_vectors(spark, folder).persist()
    model = small("random_forest").fit(rows)
    phi, base = explain.shap_tree(model.parts[0], rows, "event_id", MODEL_COLS, max_rows=None)
    total = phi.groupBy("event_id").agg(F.sum("phi").alias("total"))
    p = model.predict(rows).select("event_id", F.col("probability")[1].alias("p"))
    return violations(total.join(p, "event_id"), F.abs(F.col("total") - (F.col("p") - base)) > 1e-6)


@query("shap_tree_boosted", f"SELECT count(*) * {K} AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Contributions of every event to each class part sum to its margin minus the base."""
    rows = event_vectors(spark, folder).persist()
    found = []
    for part in small("gbt_ovr").fit(rows).parts:
        phi, base = explain.shap_tree(part, rows, "event_id", MODEL_COLS, max_rows=None)
        total = phi.groupBy("event_id").agg(F.sum("phi").alias("total"))
        margin = part.transform(rows).select("event_id", (
            vector_to_array(part.getRawPredictionCol())[1] - base).alias("margin"))
        found.append(total.join(margin, "event_id"))
    return violations(reduce(DataFrame.unionByName, found), F.abs(F.col("total") - F.col("margin")) > 1e-6)


@query("shap_tree_leafwise", f"SELECT count(*) * {K} AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Contributions of every event to the score of each class sum to it minus the base."""
    rows = event_vectors(spark, folder).persist()
    model = models.Classifier("leafwise", {"rounds": 2}, K).fit(rows).parts[0]
    found = []
    said = model.predict(rows).select("event_id", "probability")
    for c in range(K):
        phi, base = explain.shap_tree(model, rows, "event_id", MODEL_COLS, c, max_rows=None)
        found.append(phi.groupBy("event_id").agg((F.sum("phi") + base).alias(f"m{c}")))
    scores = found[0].join(found[1], "event_id").join(found[2], "event_id")
    each = scores.withColumn("p", arrays.softmax(F.array(*[f"m{c}" for c in range(K)]))).join(said, "event_id")
    cells = each.select(F.explode(F.zip_with("p", "probability", lambda a, b: F.abs(a - b))).alias("off"))
    return violations(cells, F.col("off") > 1e-9)


@query("shap_sampling", f"SELECT count(*) * {len(MODEL_COLS)} AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Contributions of every event sum to its probability minus the mean of its background rows."""
    rows = event_vectors(spark, folder).persist()
    model = small("random_forest").fit(rows)
    phi = explain.shap_sampling(model, rows, rows, "event_id", MODEL_COLS, max_rows=None, samples=2)
    p = model.predict(rows).select("event_id", F.col("probability")[1].alias("p"))
    total = phi.groupBy("event_id").agg(F.sum("phi").alias("total"), F.max("p_background").alias("p0"), F.count("*").alias("n"))
    off = F.abs(F.col("total") - (F.col("p") - F.col("p0"))) > 1e-6
    bad = total.join(p, "event_id").withColumn("bad", off)
    return bad.agg(F.sum("n").alias("n_rows"), F.count(F.when(F.col("bad"), 1)).alias("n_violations"))


@query("permutation_importance", f"SELECT {len(MODEL_COLS)} AS n_rows, 0 AS n_violations, 'product_name' AS top")
def _(spark, folder):
    rows = event_vectors(spark, folder).persist()
    model = small("random_forest").fit(rows)
    table = explain.permutation_importance(model, rows, "event_id", MODEL_COLS, K, max_rows=None)
    bad = ~F.col("importance").between(-1, 1) | (F.col("std") < 0)
    return table.agg(F.count("*").alias("n_rows"), F.count(F.when(bad, 1)).alias("n_violations"),
                     F.max_by("feature", "importance").alias("top"))


@query("explain", " UNION ALL ".join(f"SELECT '{m}' AS method, {len(MODEL_COLS)} AS n_features, 0 AS n_missing" for m in ("shap_tree", "permutation")))
def _(spark, folder):
    rows = event_vectors(spark, folder).persist()
    model = small("random_forest").fit(rows)
    table = explain.explain(model, rows, rows, "event_id", MODEL_COLS, max_rows=None, repeats=1)
    return table.groupBy("method").agg(F.count("*").alias("n_features"), F.count(F.when(F.col("importance").isNull(), 1)).alias("n_missing"))


# --- streams ---------------------------------------------------------------------------

STAMP = "'%Y-%m-%d %H:%M:%S'"


def _stream_of(spark, df: DataFrame, batches: int | None = None) -> DataFrame:
    """The rows as a stream: written once to a folder, read back in time order, in so many batches.

    Each batch has a file for every core, as a small file is read by one task.
    """
    path, cores = scratch_path(spark, "stream-in"), spark.sparkContext.defaultParallelism
    (df if batches is None else df.repartition(batches * cores)).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1000 if batches is None else cores).parquet(path)


@query("stream_ip_activity", views.ctes("soc") + f"""
SELECT src_ip, strftime(date_trunc('hour', ts), {STAMP}) AS window_start, count(*) AS events, count(DISTINCT dst_ip) AS dst_ips
FROM soc WHERE src_ip IS NOT NULL GROUP BY src_ip, date_trunc('hour', ts)""")
def _(spark, folder):
    stream = _stream_of(spark, soc(spark, folder).select("ts", "src_ip", "dst_ip"))
    out = activity.run_activity(spark, stream, "ts", scratch_path(spark, "stream-state"))
    start = F.date_format(F.col("window_start"), "yyyy-MM-dd HH:mm:ss")
    return out.select("src_ip", start.alias("window_start"), "events", "dst_ips")


@query("stream_incremental_train", "SELECT count(*) AS n_rows, 0 AS n_violations, 1 AS trained FROM events")
def _(spark, folder):
    rows = event_vectors(spark, folder)
    stream = _stream_of(spark, rows, 4)
    state = scratch_path(spark, "sgd")
    incremental.stream_incremental_train(
        spark, stream, incremental.SgdLogistic(K, len(MODEL_COLS), 0.5), "label_idx", state, scratch_path(spark, "stream-state"))
    model = incremental.restore(spark, state)
    out = violations(model.predict(rows), bad_prediction())
    return out.withColumn("trained", F.lit(int(model.steps > 0 and model.last_batch >= 0)))


@query("stream_score", "SELECT count(*) AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    """Stream scores equal batch scores for every event."""
    events = soc(spark, folder)
    run = lifecycle.train(events, ["event_id", "ts"], ["message_sanitized"], "label", ["random_forest"],
                          {"random_forest": {"num_trees": 5, "max_depth": 5}},
                          feature_options={"max_text_features": 50, "text_options": {"analyzer": "word", "ngram_range": (1, 1)}})
    path = scratch_path(spark, "run")
    lifecycle.save_run(run, spark, path)
    loaded = lifecycle.load_run(spark, path)
    stream = _stream_of(spark, events.drop("label"), 2)
    out = scratch_path(spark, "scored")
    scoring.stream_score(stream, *loaded, out, scratch_path(spark, "stream-state"))
    streamed = spark.read.parquet(out + "/batch=*").select("event_id", F.col("pred_label").alias("streamed"), F.col("prob_malicious").alias("p1"))
    batch = lifecycle.score(events, *loaded).select("event_id", "pred_label", "prob_malicious")
    joined = batch.join(streamed, "event_id", "full")
    same = (F.col("pred_label") == F.col("streamed")) & (F.abs(F.col("prob_malicious") - F.col("p1")) < 1e-9)
    return violations(joined, ~F.coalesce(same, F.lit(False)))
