"""Evaluation, report, sampling and limit queries on formula-made predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.hashing import sql_hash_hex
from wardline.functions import arrays
from wardline.operators import metrics, prep, sampling
from wardline.plans.common import LABELS, PROBS, soc, soc_pred, split_ctes
from wardline.plans.preparation import PREDICTIONS, predictions
from wardline.plans.registry import query, r6
from wardline.sources import views

PRED = views.ctes("soc_pred")
TP = """, tp AS (SELECT c.class, count(*) FILTER (WHERE y = c.class AND pred = c.class) AS tp,
    count(*) FILTER (WHERE y = c.class) AS pos, count(*) FILTER (WHERE pred = c.class) AS said
  FROM soc_pred, (SELECT unnest([0, 1, 2]) AS class) c GROUP BY c.class),
prf AS (SELECT class, CASE WHEN said = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / said END AS precision,
    CASE WHEN pos = 0 THEN 0 ELSE CAST(tp AS DOUBLE) / pos END AS recall,
    CASE WHEN pos + said = 0 THEN 0 ELSE CAST(2 * tp AS DOUBLE) / (pos + said) END AS f1 FROM tp)
"""
SCORES = """, long AS (SELECT 0 AS class, p_benign AS score, CAST(y = 0 AS BIGINT) AS hit FROM soc_pred
  UNION ALL SELECT 1, p_malicious, CAST(y = 1 AS BIGINT) FROM soc_pred UNION ALL SELECT 2, p_suspicious, CAST(y = 2 AS BIGINT) FROM soc_pred),
counts AS (SELECT class, score, sum(hit) AS pos, count(*) - sum(hit) AS neg FROM long GROUP BY class, score),
cum AS (SELECT class, score, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
    CAST(sum(neg) OVER (PARTITION BY class ORDER BY score) - neg AS DOUBLE) AS below,
    CAST(sum(pos) OVER (PARTITION BY class ORDER BY score DESC) AS DOUBLE) AS tp,
    CAST(sum(neg) OVER (PARTITION BY class ORDER BY score DESC) AS DOUBLE) AS fp,
    CAST(sum(pos) OVER (PARTITION BY class) AS DOUBLE) AS p, CAST(sum(neg) OVER (PARTITION BY class) AS DOUBLE) AS n FROM counts),
auc AS (SELECT class, sum(pos * (below + neg / 2)) / (max(p) * max(n)) AS auc FROM cum GROUP BY class)
"""


@query("accuracy", PRED + "SELECT round(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy FROM soc_pred")
def _(spark, folder):
    return metrics.accuracy(soc_pred(spark, folder)).select(r6("accuracy").alias("accuracy"))


@query("macro_prf", PRED + TP + """SELECT round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro,
  round(avg(f1), 6) AS f1_macro FROM prf""")
def _(spark, folder):
    out = metrics.macro_prf(soc_pred(spark, folder), 3)
    return out.select(*[r6(c).alias(c) for c in out.columns])


@query("per_class_prf", PRED + TP + "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf")
def _(spark, folder):
    out = metrics.per_class_prf(soc_pred(spark, folder), 3)
    return out.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("auc_ovr", PRED + SCORES + "SELECT round(avg(auc), 6) AS auc_ovr FROM auc")
def _(spark, folder):
    return metrics.auc_ovr(soc_pred(spark, folder), PROBS).select(r6("auc_ovr").alias("auc_ovr"))


@query("f1_malicious", PRED + TP + "SELECT round(f1, 6) AS f1_malicious FROM prf WHERE class = 1")
def _(spark, folder):
    return metrics.f1_of_class(soc_pred(spark, folder), 3).select(r6("f1_malicious").alias("f1_malicious"))


@query("confusion_matrix", PRED + """
SELECT a.c AS y, b.c AS pred, count(s.event_id) AS n FROM (SELECT unnest([0, 1, 2]) AS c) a CROSS JOIN (SELECT unnest([0, 1, 2]) AS c) b
LEFT JOIN soc_pred s ON s.y = a.c AND s.pred = b.c GROUP BY a.c, b.c""")
def _(spark, folder):
    return metrics.confusion_matrix(soc_pred(spark, folder), 3)


@query("roc_points", PRED + SCORES + """
SELECT class, round(score, 9) AS score, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM cum
UNION ALL SELECT unnest([0, 1, 2]), NULL, 0, 0""")
def _(spark, folder):
    out = metrics.roc_points(soc_pred(spark, folder), PROBS)
    return out.select("class", F.round("score", 9).alias("score"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("label_distribution", views.ctes("soc_pred") + """
, ranked AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY """ + sql_hash_hex("42", "event_id") + """, event_id) AS rn FROM soc_pred),
small AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM soc_pred GROUP BY y) q)
SELECT 'before' AS stage, y AS label, count(*) AS n FROM soc_pred GROUP BY y
UNION ALL SELECT 'after', y, count(*) FROM ranked, small WHERE rn <= m GROUP BY y""")
def _(spark, folder):
    from wardline.operators.resample import random_under

    rows = soc_pred(spark, folder)
    return metrics.label_distribution(rows, random_under(rows, "y", "event_id"), "y")


def _three_models(spark, folder):
    rows = soc_pred(spark, folder).select("event_id", "y", "pred", *PROBS)
    flat = rows.withColumn("pred", F.lit(0))
    return {"rule": rows, "all_benign": flat}


def _metric_table(spark, folder):
    parts = []
    for name, rows in _three_models(spark, folder).items():
        probs = PROBS if name == "rule" else None
        parts.append(metrics.compute_metrics(rows, 3, probs).select(F.lit(name).alias("model"), "metric", "value"))
    return parts[0].unionByName(parts[1])


BASE = PRED + TP.replace("prf AS", "prf AS") + SCORES
FLAT_F1 = "(SELECT 2.0::DOUBLE * count(*) FILTER (WHERE y = 0) / (count(*) FILTER (WHERE y = 0) + count(*)) FROM soc_pred)"


@query("model_comparison", BASE + f"""
SELECT 'rule' AS model, round((SELECT avg(CAST(y = pred AS DOUBLE)) FROM soc_pred), 6) AS accuracy, round((SELECT avg(f1) FROM prf), 6) AS f1_macro,
  round((SELECT f1 FROM prf WHERE class = 1), 6) AS f1_malicious, round((SELECT avg(auc) FROM auc), 6) AS auc_ovr
UNION ALL SELECT 'all_benign', round((SELECT avg(CAST(y = 0 AS DOUBLE)) FROM soc_pred), 6), round({FLAT_F1} / 3, 6), 0, 0""")
def _(spark, folder):
    out = metrics.model_comparison(_metric_table(spark, folder))
    return out.select("model", *[r6(c).alias(c) for c in metrics.COMPARED])


@query("select_best", BASE + f"""
SELECT model, score FROM (SELECT 'rule' AS model, round((SELECT avg(f1) FROM prf), 6) AS score
  UNION ALL SELECT 'all_benign', round({FLAT_F1} / 3, 6)) m ORDER BY score DESC, model LIMIT 1""")
def _(spark, folder):
    return metrics.select_best(_metric_table(spark, folder)).select("model", r6("score").alias("score"))


@query("prediction_distribution", PRED + f"SELECT pred_label, count(*) AS n FROM ({PREDICTIONS}) q GROUP BY pred_label")
def _(spark, folder):
    return metrics.prediction_distribution(predictions(spark, folder))


@query("compute_metrics", BASE + """
SELECT 'accuracy' AS metric, round((SELECT avg(CAST(y = pred AS DOUBLE)) FROM soc_pred), 6) AS value
UNION ALL SELECT 'precision_macro', round(avg(precision), 6) FROM prf UNION ALL SELECT 'recall_macro', round(avg(recall), 6) FROM prf
UNION ALL SELECT 'f1_macro', round(avg(f1), 6) FROM prf
UNION ALL SELECT 'precision_' || ['benign', 'malicious', 'suspicious'][class + 1], round(precision, 6) FROM prf
UNION ALL SELECT 'recall_' || ['benign', 'malicious', 'suspicious'][class + 1], round(recall, 6) FROM prf
UNION ALL SELECT 'f1_' || ['benign', 'malicious', 'suspicious'][class + 1], round(f1, 6) FROM prf
UNION ALL SELECT 'auc_ovr', round(avg(auc), 6) FROM auc""")
def _(spark, folder):
    out = metrics.compute_metrics(soc_pred(spark, folder), 3, PROBS, names=LABELS)
    return out.select("metric", r6("value").alias("value"))


# --- limits and samples ----------------------------------------------------------

@query("top_malicious", PRED + f"""SELECT event_id, pred_label, prob_malicious, prob_benign FROM ({PREDICTIONS}) q
ORDER BY prob_malicious DESC, event_id LIMIT 10""")
def _(spark, folder):
    rows = predictions(spark, folder).select("event_id", "pred_label", "prob_malicious", "prob_benign")
    return metrics.top_malicious(rows)


@query("head_n", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 5000")
def _(spark, folder):
    return sampling.head_n(spark.read.parquet(f"{folder}/events.parquet").select("event_id", "event_type", "value"), "event_id", 5000)


@query("sample_without_replacement", f"SELECT event_id, event_type FROM events ORDER BY {sql_hash_hex('42', 'event_id')}, event_id LIMIT 100")
def _(spark, folder):
    rows = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "event_type")
    return sampling.sample_without_replacement(rows, "event_id", 100)


@query("shuffle_batches", " UNION ALL ".join(f"""
SELECT event_id, {e} AS epoch, CAST(floor((row_number() OVER (ORDER BY {sql_hash_hex(f"'42|{e}'", 'event_id')}, event_id) - 1) / 1000) AS BIGINT) AS batch
FROM events""" for e in (0, 1)))
def _(spark, folder):
    return sampling.shuffle_batches(spark.read.parquet(f"{folder}/events.parquet").select("event_id"), "event_id", 1000, 2)


@query("stratified_kfold", views.ctes("soc") + f"""
, ranked AS (SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash_hex('42', 'event_id')}, event_id) AS rn,
  count(*) OVER (PARTITION BY label) AS nc FROM soc)
SELECT event_id, label, CAST((rn - 1) * 5 // nc AS INT) AS fold FROM ranked""")
def _(spark, folder):
    return sampling.stratified_kfold(soc(spark, folder).select("event_id", "label"), "label", "event_id")


@query("softmax_scores", PRED + """
, e AS (SELECT event_id, exp(p_benign * 10 - m) AS a, exp(p_malicious * 10 - m) AS b, exp(p_suspicious * 10 - m) AS c
  FROM (SELECT *, greatest(p_benign, p_malicious, p_suspicious) * 10 AS m FROM soc_pred) q)
SELECT event_id, round(a / (a + b + c), 6) AS prob_benign, round(b / (a + b + c), 6) AS prob_malicious, round(c / (a + b + c), 6) AS prob_suspicious FROM e""")
def _(spark, folder):
    rows = soc_pred(spark, folder).select("event_id", arrays.softmax(F.array(*[F.col(c) * 10 for c in PROBS])).alias("p"))
    return rows.select("event_id", *[r6(F.col("p")[i]).alias(f"prob_{c}") for i, c in enumerate(LABELS)])


@query("soft_vote", PRED + """
, v AS (SELECT event_id, (p_benign + p_suspicious) / 2 AS a, (p_malicious + p_benign) / 2 AS b, (p_suspicious + p_malicious) / 2 AS c FROM soc_pred)
SELECT event_id, round(a, 6) AS prob_benign, round(b, 6) AS prob_malicious, round(c, 6) AS prob_suspicious,
  CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS pred FROM v""")
def _(spark, folder):
    """Two sets of probabilities: the second is the first with its classes rotated."""
    from wardline.operators.ensemble import soft_vote

    rows = soc_pred(spark, folder)
    first = rows.select("event_id", F.array(*PROBS).alias("probability"))
    second = rows.select("event_id", F.array("p_suspicious", "p_benign", "p_malicious").alias("probability"))
    out = soft_vote({"first": first, "second": second})
    return out.select("event_id", *[r6(F.col("probability")[i]).alias(f"prob_{c}") for i, c in enumerate(LABELS)], "pred")
