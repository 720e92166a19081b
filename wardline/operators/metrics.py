"""Evaluation and report tables. Everything but the ROC family derives from k x k counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.ordering import SMALL_ROWS, running_sums

MALICIOUS = 1
# Metrics of the model comparison.
COMPARED = ("accuracy", "f1_macro", "f1_malicious", "auc_ovr")


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_grid(spark, k: int) -> DataFrame:
    return spark.range(k).select(F.col("id").cast("int").alias("class"))


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.agg(_ratio(F.count(F.when(F.col(y) == F.col(pred), 1)), F.count("*")).alias("accuracy"))


def confusion_matrix(df: DataFrame, k: int, y: str = "y", pred: str = "pred") -> DataFrame:
    """k x k counts, zero cells included."""
    counts = df.groupBy(F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("pred")).agg(
        F.count("*").alias("n")
    )
    cells = df.sparkSession.range(k * k).select(
        F.floor(F.col("id") / k).cast("int").alias("y"), (F.col("id") % k).cast("int").alias("pred")
    )
    return cells.join(counts, ["y", "pred"], "left").select("y", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def per_class_prf(df: DataFrame, k: int, y: str = "y", pred: str = "pred") -> DataFrame:
    counts = df.groupBy(F.col(y).cast("int").alias("y"), F.col(pred).cast("int").alias("p")).agg(
        F.count("*").alias("n")
    )
    sides = counts.select(
        F.explode(F.array(
            F.struct(F.col("y").alias("class"), F.col("n").alias("pos"), F.lit(0).cast("bigint").alias("said"),
                     F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
            F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("pos"), F.col("n").alias("said"),
                     F.lit(0).cast("bigint").alias("tp")),
        )).alias("s")
    ).select("s.*").groupBy("class").agg(F.sum("pos").alias("pos"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
    all_classes = class_grid(df.sparkSession, k).join(sides, "class", "left").fillna(0)
    return all_classes.select(
        "class", _ratio(F.col("tp"), F.col("said")).alias("precision"), _ratio(F.col("tp"), F.col("pos")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("pos") + F.col("said")).alias("f1"),
    )


def macro_prf(df: DataFrame, k: int, y: str = "y", pred: str = "pred") -> DataFrame:
    table = per_class_prf(df, k, y, pred)
    return table.agg(
        F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"), F.avg("f1").alias("f1_macro")
    )


def f1_of_class(df: DataFrame, k: int, index: int = MALICIOUS, y: str = "y", pred: str = "pred",
                name: str = "f1_malicious") -> DataFrame:
    return per_class_prf(df, k, y, pred).where(F.col("class") == index).select(F.col("f1").alias(name))


def _score_counts(df: DataFrame, prob_cols: list[str], y: str) -> DataFrame:
    """(class, score, pos, neg): one row per class and distinct score."""
    entries = F.array(*[
        F.struct(F.lit(i).alias("class"), F.col(c).cast("double").alias("score"), (F.col(y) == i).cast("bigint").alias("hit"))
        for i, c in enumerate(prob_cols)
    ])
    return (
        df.select(F.explode(entries).alias("e")).select("e.*").groupBy("class", "score")
        .agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg"))
    )


def roc_points(df: DataFrame, prob_cols: list[str], y: str = "y", small_rows: int = SMALL_ROWS) -> DataFrame:
    """(class, score, fpr, tpr) at every distinct score, highest first, without thinning.

    The starting point (0, 0) has no score. Running sums go over distinct scores only.
    """
    counts = _score_counts(df, prob_cols, y)
    summed = running_sums(counts, ["class"], [F.col("score").desc()], {"pos": "tp", "neg": "fp"}, small_rows)
    totals = counts.groupBy("class").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = summed.join(F.broadcast(totals), "class").select(
        "class", "score", _ratio(F.col("fp"), F.col("n")).alias("fpr"), _ratio(F.col("tp"), F.col("p")).alias("tpr")
    )
    start = class_grid(df.sparkSession, len(prob_cols)).select(
        "class", F.lit(None).cast("double").alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def auc_per_class(df: DataFrame, prob_cols: list[str], y: str = "y", small_rows: int = SMALL_ROWS) -> DataFrame:
    """Exact one-vs-rest AUC: share of (positive, negative) pairs in the right order, ties half."""
    counts = _score_counts(df, prob_cols, y)
    summed = running_sums(counts, ["class"], ["score"], {"neg": "neg_upto"}, small_rows)
    d = lambda c: F.col(c).cast("double")
    won = d("pos") * (d("neg_upto") - d("neg") + d("neg") / 2)
    return summed.groupBy("class").agg(
        F.sum(won).alias("won"), F.sum(d("pos")).alias("p"), F.sum(d("neg")).alias("n")
    ).select("class", F.try_divide(F.col("won"), F.col("p") * F.col("n")).alias("auc"))


def auc_ovr(df: DataFrame, prob_cols: list[str], y: str = "y", small_rows: int = SMALL_ROWS) -> DataFrame:
    """Mean of the one-vs-rest AUCs; NULL unless every class occurs."""
    table = auc_per_class(df, prob_cols, y, small_rows)
    complete = F.count("auc") == len(prob_cols)
    return table.agg(F.when(complete, F.avg("auc")).alias("auc_ovr"))


def label_distribution(before: DataFrame, after: DataFrame, label_col: str) -> DataFrame:
    parts = [
        d.groupBy(F.col(label_col).cast("int").alias("label")).agg(F.count("*").alias("n"))
        .select(F.lit(stage).alias("stage"), "label", "n")
        for stage, d in (("before", before), ("after", after))
    ]
    return reduce(DataFrame.unionByName, parts)


def compute_metrics(df: DataFrame, k: int, prob_cols: list[str] | None = None, y: str = "y", pred: str = "pred",
                    names: list[str] | None = None) -> DataFrame:
    """Long table (metric, value) of accuracy, macro and per-class scores, AUC and malicious F1."""
    table = per_class_prf(df, k, y, pred)
    label = F.col("class").cast("string")
    if names:
        label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("class") + 1)
    long = table.unpivot(["class"], ["precision", "recall", "f1"], "kind", "value")
    per_class = long.select(F.concat(F.col("kind"), F.lit("_"), label).alias("metric"), "value")
    macro = long.groupBy("kind").agg(F.avg("value").alias("value")).select(
        F.concat(F.col("kind"), F.lit("_macro")).alias("metric"), "value"
    )
    overall = accuracy(df, y, pred).select(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    out = [overall, macro, per_class]
    if not names or "malicious" not in names:
        out.append(f1_of_class(df, k, MALICIOUS, y, pred).select(F.lit("f1_malicious").alias("metric"), F.col("f1_malicious").alias("value")))
    if prob_cols and len(prob_cols) == k:
        auc = auc_ovr(df, prob_cols, y)
        # no entry where it is not defined
        out.append(auc.where("auc_ovr IS NOT NULL").select(F.lit("auc_ovr").alias("metric"), F.col("auc_ovr").alias("value")))
    return reduce(DataFrame.unionByName, out)


def model_comparison(metrics: DataFrame) -> DataFrame:
    """One row per model, one column per compared metric, absent ones 0."""
    wide = metrics.groupBy("model").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in COMPARED]
    )
    return wide.select("model", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in COMPARED])


def select_best(metrics: DataFrame, primary: str = "f1_macro") -> DataFrame:
    """Model with the highest primary metric; the smallest name on a tie."""
    scores = metrics.where(F.col("metric") == primary)
    best = scores.agg(F.min(F.struct(-F.col("value"), F.col("model"))).alias("b"))
    return best.select(F.col("b.model").alias("model"), (-F.col("b.col1")).alias("score"))


def prediction_distribution(df: DataFrame, label_col: str = "pred_label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label_col)


def top_malicious(df: DataFrame, n: int = 10, id_col: str = "event_id") -> DataFrame:
    """The n rows most likely malicious: a per-partition heap, then one merge."""
    return df.orderBy(F.desc("prob_malicious"), id_col).limit(n)


def top_features(df: DataFrame, n: int = 30) -> DataFrame:
    return df.orderBy(F.desc("importance"), "feature").limit(n)
