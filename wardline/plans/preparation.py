"""Sources, sinks and preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.hashing import sql_hash_hex, sql_hash_int
from wardline.operators import features, metrics, ordering, prep, sampling
from wardline.plans.common import (
    CATEGORICAL, ID_COLS, LABEL_COL, LABEL_SQL, LABELS, NUMERIC, PREP_SELECT, PROBS, TEXT_COLS,
    fitted_prep, soc, soc_frame, soc_pred, split_ctes, sql_median, sql_mode,
)
from wardline.plans.registry import query, r6, table, violations
from wardline.session import scratch_path
from wardline.sources import files, views

SOC_CTE = views.ctes("soc")
EVENT_COLS = "event_id, user_id, event_type, value, props"
EVENT_SQL = f"SELECT {EVENT_COLS}, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events"


def _stamped(rows):
    """All columns; times as text to the microsecond, which both engines print alike."""
    return rows.select(*EVENT_COLS.split(", "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("read_parquet", EVENT_SQL)
def _(spark, folder):
    return _stamped(files.read_parquet(spark, f"{folder}/events.parquet"))


def _events_csv(spark, folder):
    rows = table(spark, folder, "events").select(*EVENT_COLS.split(", "), "ts")
    path = scratch_path(spark, "events-csv")
    files.write_csv(rows, path)
    return path, rows.schema


@query("read_csv", EVENT_SQL)
def _(spark, folder):
    path, schema = _events_csv(spark, folder)
    return _stamped(files.read_csv(spark, path, schema))


@query("read_auto", "SELECT o_orderkey AS id, 'parquet' AS source FROM orders UNION ALL SELECT event_id, 'csv' FROM events")
def _(spark, folder):
    path, schema = _events_csv(spark, folder)
    left = files.read_auto(spark, f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.lit("parquet").alias("source"))
    right = files.read_auto(spark, path, schema).select(F.col("event_id").alias("id"), F.lit("csv").alias("source"))
    return files.union_all(left, right)


@query("dedup_rows", """
SELECT md5(text) AS text_md5, lang, source FROM (SELECT DISTINCT text, lang, source FROM documents) d""")
def _(spark, folder):
    rows = files.dedup_rows(table(spark, folder, "documents").select("text", "lang", "source"))
    return rows.select(F.md5("text").alias("text_md5"), "lang", "source")


@query("union_all", "SELECT event_id AS id, props AS payload FROM events UNION ALL SELECT o_orderkey, o_orderpriority FROM orders")
def _(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("props").alias("payload"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("payload"))
    return files.union_all(events, orders)


# --- projections, profiling ---------------------------------------------------

@query("split_roles", SOC_CTE + """
SELECT event_id, message_sanitized, label, src_ip, dst_ip, src_port, product_name, pipeline, src_host, username,
  num_value, sparse_num FROM soc""")
def _(spark, folder):
    parts = prep.split_roles(soc(spark, folder), ID_COLS, TEXT_COLS, LABEL_COL)
    return parts.select("ids.event_id", "texts.message_sanitized", "label", "features.*")


@query("event_id_fallback", "SELECT count(*) AS n_rows, 0 AS n_violations FROM events")
def _(spark, folder):
    rows = ordering.dense_index(table(spark, folder, "events").select("props", "value"))
    counted = rows.groupBy("event_id").agg(F.count("*").alias("n"))
    total = table(spark, folder, "events").agg(F.count("*").alias("total"))
    bad = (F.col("n") != 1) | (F.col("event_id") < 0) | (F.col("event_id") >= F.col("total"))
    return violations(counted.join(F.broadcast(total)), bad)


FEATURES = NUMERIC + ["sparse_num"] + CATEGORICAL

RATE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS missing_rate FROM soc"""
    for c in FEATURES
)


@query("missing_rate", SOC_CTE + f'SELECT "column", round(missing_rate, 6) AS missing_rate FROM ({RATE_SQL}) r')
def _(spark, folder):
    return prep.missing_rate(soc(spark, folder), FEATURES).select("column", r6("missing_rate").alias("missing_rate"))


@query("drop_sparse_cols", SOC_CTE + "SELECT event_id, src_ip, dst_ip, src_port, product_name, pipeline, src_host, username, num_value FROM soc")
def _(spark, folder):
    return prep.drop_sparse_cols(soc(spark, folder).drop("ts", "message_sanitized", "label"), FEATURES)


@query("numeric_medians", SOC_CTE + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {sql_median(c)} AS median""" for c in NUMERIC + ["sparse_num"]))
def _(spark, folder):
    found = prep.numeric_medians(soc(spark, folder), NUMERIC + ["sparse_num"])
    return spark.createDataFrame(list(found.items()), "column string, median double")


@query("categorical_modes", SOC_CTE + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {sql_mode(c)} AS value""" for c in CATEGORICAL))
def _(spark, folder):
    return prep.categorical_modes(soc(spark, folder), CATEGORICAL)


@query("impute", SOC_CTE + PREP_SELECT)
def _(spark, folder):
    rows, model = fitted_prep(spark, folder)
    return model.transform(rows).drop("ts", "message_sanitized")


@query("label_encode_fit", SOC_CTE + """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INT) AS idx
FROM (SELECT DISTINCT label FROM soc WHERE label IS NOT NULL) l""")
def _(spark, folder):
    return prep.label_table(spark, prep.fit_labels(soc(spark, folder), "label"))


@query("label_encode", views.ctes("soc", "soc_text") + f"""
SELECT event_id, {LABEL_SQL} AS label_idx FROM soc_text""")
def _(spark, folder):
    labels = prep.fit_labels(soc(spark, folder), "label")
    rows = views.load(spark, folder, "soc_text")
    return rows.select("event_id", prep.encode_label(F.col("label"), labels).alias("label_idx"))


@query("label_decode", """
SELECT event_id, CASE user_id % 5 - 1 WHEN 0 THEN 'benign' WHEN 1 THEN 'malicious' WHEN 2 THEN 'suspicious'
  ELSE 'benign' END AS label FROM events""")
def _(spark, folder):
    rows = table(spark, folder, "events")
    return rows.select("event_id", prep.decode_label(F.col("user_id") % 5 - 1, LABELS).alias("label"))


@query("align_schema", SOC_CTE + "SELECT event_id, num_value, 0 AS bytes_out, username, src_port FROM soc")
def _(spark, folder):
    return prep.align_schema(soc(spark, folder), ["num_value", "bytes_out", "username", "src_port"], keep=["event_id"])


@query("prep_fit_transform", views.ctes("soc") + f", prepared AS ({PREP_SELECT}) SELECT p.*, s.message_sanitized FROM prepared p JOIN soc s USING (event_id)")
def _(spark, folder):
    rows, model = fitted_prep(spark, folder)
    return model.transform(rows).drop("ts")


@query("state_roundtrip_prep", SOC_CTE + PREP_SELECT)
def _(spark, folder):
    rows, model = fitted_prep(spark, folder)
    path = scratch_path(spark, "prep-state")
    model.save(spark, path)
    return prep.PrepModel.load(spark, path).transform(rows).drop("ts", "message_sanitized")


@query("stratified_split", SOC_CTE + split_ctes("soc", "label") + "SELECT event_id, label, split FROM split_rows")
def _(spark, folder):
    return sampling.stratified_split(soc(spark, folder).select("event_id", "label"), "label", "event_id")


@query("write_splits", SOC_CTE + split_ctes("soc", "label") + "SELECT event_id, label, num_value, split FROM split_rows")
def _(spark, folder):
    rows = soc(spark, folder).select("event_id", "label", "num_value")
    path = scratch_path(spark, "splits")
    files.write_splits(sampling.stratified_split(rows, "label", "event_id"), path)
    return spark.read.parquet(path)


@query("prep_pipeline", SOC_CTE + f", prepared AS ({PREP_SELECT})" + split_ctes("prepared", "label_idx")
       + "SELECT event_id, label_idx, num_value, src_port, username, src_ip, split FROM split_rows")
def _(spark, folder):
    from wardline.plans.lifecycle import prepare

    path, _model = prepare(files.dedup_rows(soc(spark, folder)), ID_COLS, TEXT_COLS, LABEL_COL, fit_on="all")
    return spark.read.parquet(path).select("event_id", "label_idx", "num_value", "src_port", "username", "src_ip", "split")


@query("profile_columns", SOC_CTE + " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", 'numeric' AS role""" for c in NUMERIC]
    + [f"""SELECT '{c}', (SELECT CASE WHEN count(DISTINCT {c}) > 100 THEN 'high_card' ELSE 'low_card' END FROM soc)"""
       for c in CATEGORICAL]))
def _(spark, folder):
    roles = prep.profile_columns(soc(spark, folder), NUMERIC + CATEGORICAL, threshold=100)
    return spark.createDataFrame(list(roles.items()), "column string, role string")


@query("coerce_numeric", """
SELECT event_id, COALESCE(TRY_CAST(event_type AS DOUBLE), 0) AS event_type,
  COALESCE(TRY_CAST(substr(props, 7, length(props) - 7) AS DOUBLE), 0) AS prop, COALESCE(value, 0) AS value FROM events""")
def _(spark, folder):
    rows = table(spark, folder, "events")
    prop = F.substr("props", F.lit(7), F.length("props") - 7)
    return rows.select(
        "event_id", *[prep.coerce_numeric(c).alias(n) for n, c in
                      (("event_type", F.col("event_type")), ("prop", prop), ("value", F.col("value")))]
    )


# --- sinks ---------------------------------------------------------------------

PREDICTIONS = """SELECT event_id, CASE pred WHEN 0 THEN 'benign' WHEN 1 THEN 'malicious' ELSE 'suspicious' END AS pred_label,
  round(p_benign, 6) AS prob_benign, round(p_malicious, 6) AS prob_malicious, round(p_suspicious, 6) AS prob_suspicious FROM soc_pred"""


def predictions(spark, folder):
    return soc_pred(spark, folder).select(
        "event_id", prep.decode_label(F.col("pred"), LABELS).alias("pred_label"),
        *[r6(f"p_{c}").alias(f"prob_{c}") for c in LABELS],
    )


@query("write_predictions", views.ctes("soc_pred") + PREDICTIONS)
def _(spark, folder):
    rows = predictions(spark, folder)
    path = scratch_path(spark, "predictions")
    files.write_predictions(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("write_metrics", views.ctes("soc_pred") + """
, tp AS (SELECT c.class, count(*) FILTER (WHERE y = c.class AND pred = c.class) AS tp,
    count(*) FILTER (WHERE y = c.class) AS pos, count(*) FILTER (WHERE pred = c.class) AS said
  FROM soc_pred, (SELECT unnest([0, 1, 2]) AS class) c GROUP BY c.class)
SELECT 'rule' AS model, 'accuracy' AS metric, round((SELECT avg(CAST(y = pred AS DOUBLE)) FROM soc_pred), 6) AS value
UNION ALL SELECT 'rule', 'f1_malicious', round(CAST(2 * tp AS DOUBLE) / (pos + said), 6) FROM tp WHERE class = 1""")
def _(spark, folder):
    rows = soc_pred(spark, folder)
    wanted = metrics.compute_metrics(rows, 3).where(F.col("metric").isin("accuracy", "f1_malicious"))
    path = scratch_path(spark, "metrics")
    files.write_metrics(wanted.select(F.lit("rule").alias("model"), "metric", r6("value").alias("value")), path)
    return spark.read.schema("model string, metric string, value double").json(path)


@query("write_importance", "SELECT 4 AS n_rows, 0 AS n_violations")
def _(spark, folder):
    """Top-N records must repeat the largest rows of the full table."""
    frame = soc_frame(spark, folder)
    table_ = features.mutual_information(frame, ["src_port", "num_value", "hour_of_day", "msg_len"], "label_idx")
    path = scratch_path(spark, "importance")
    files.write_importance(table_, path, top_n=2)
    full = files.read_csv(spark, f"{path}/full", "feature string, importance double")
    top = spark.read.schema("feature string, importance double").json(f"{path}/top").withColumnRenamed("importance", "top_importance")
    expected = metrics.top_features(full, 2).select("feature", F.lit(1).alias("wanted"))
    joined = full.join(top, "feature", "left").join(expected, "feature", "left")
    agree = (F.col("wanted").isNull() & F.col("top_importance").isNull()) | (F.col("top_importance") == F.col("importance"))
    return violations(joined, ~F.coalesce(agree, F.lit(False)))
