"""Feature engineering queries."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from wardline.functions.text import BLANKS, WORD
from wardline.operators import features, textfeat
from wardline.plans.common import FRAME_NUMERIC, soc_frame
from wardline.plans.registry import query, r6, violations
from wardline.session import scratch_path, spread
from wardline.sources import views

FRAME = views.ctes("soc_frame")
HIGH, LOW = ["username", "src_ip"], ["product_name", "pipeline"]
HIGH_CARD = 10  # keeps the column roles the same at every table size
TEXT_TERMS = textfeat.MAX_FEATURES


def sql_robust(c: str, value: str | None = None, source: str = "soc_frame") -> str:
    q = lambda p: f"(SELECT quantile_cont({c}, {p}) FROM {source})"
    spread = f"({q(0.75)} - {q(0.25)})"
    return f"(({value or c} - {q(0.5)}) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END)"


@query("robust_scale", FRAME + "SELECT event_id, " + ", ".join(f"round({sql_robust(c)}, 6) AS {c}" for c in FRAME_NUMERIC) + " FROM soc_frame")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    out = features.scale(frame, features.fit_robust(frame, FRAME_NUMERIC), ["event_id"])
    return out.select("event_id", *[r6(c).alias(c) for c in FRAME_NUMERIC])


@query("standard_scale", FRAME + "SELECT event_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM soc_frame)) / (SELECT stddev_pop({c}) FROM soc_frame), 6) AS {c}" for c in FRAME_NUMERIC) + " FROM soc_frame")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    out = features.scale(frame, features.fit_standard(frame, FRAME_NUMERIC), ["event_id"])
    return out.select("event_id", *[r6(c).alias(c) for c in FRAME_NUMERIC])


@query("scale_missing_cols", FRAME + f"""SELECT event_id, round({sql_robust('src_port')}, 6) AS src_port,
  round({sql_robust('num_value', '0')}, 6) AS num_value FROM soc_frame""")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    stats = features.fit_robust(frame, ["src_port", "num_value"])
    out = features.scale(frame.drop("num_value"), stats, ["event_id"])
    return out.select("event_id", r6("src_port").alias("src_port"), r6("num_value").alias("num_value"))


def sql_target(c: str, name: str) -> str:
    return f"""{name} AS (SELECT {c} AS value, prior * (1 - w) + mean * w AS code FROM (
      SELECT {c}, avg(CAST(label_idx AS DOUBLE)) AS mean,
        CAST(1 AS DOUBLE) / (1 + exp(-(CAST(count(*) AS DOUBLE) - 20) / 10)) AS w,
        (SELECT avg(CAST(label_idx AS DOUBLE)) FROM soc_frame) AS prior FROM soc_frame GROUP BY {c}) q)"""


@query("target_encode", FRAME + f", {sql_target('username', 'te_user')}, {sql_target('src_ip', 'te_ip')} " + """
SELECT f.event_id, round(u.code, 6) AS username, round(i.code, 6) AS src_ip FROM soc_frame f
JOIN te_user u ON u.value = f.username JOIN te_ip i ON i.value = f.src_ip""")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    out = frame.select("event_id", *HIGH)
    for c in HIGH:
        table, prior = features.fit_target(frame, c, "label_idx")
        out = features.encode_values(out, c, table, prior)
    return out.select("event_id", *[r6(c).alias(c) for c in HIGH])


def sql_ranks(c: str, name: str) -> str:
    return f"{name} AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT {c} AS value FROM soc_frame) d)"


@query("ordinal_encode", FRAME + f", {sql_ranks('username', 'o_user')}, {sql_ranks('src_ip', 'o_ip')} " + """
SELECT f.event_id, u.code AS username, i.code AS src_ip FROM soc_frame f
JOIN o_user u ON u.value = f.username JOIN o_ip i ON i.value = f.src_ip""")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    out = frame.select("event_id", *HIGH)
    for c in HIGH:
        out = features.encode_values(out, c, features.fit_ordinal(frame, c), -1.0)
    return out


@query("label_encode_lowcard", FRAME + f", {sql_ranks('product_name', 'o_product')}, {sql_ranks('pipeline', 'o_pipe')} " + """
SELECT f.event_id, a.code AS product_name, b.code AS pipeline FROM soc_frame f
JOIN o_product a ON a.value = f.product_name JOIN o_pipe b ON b.value = f.pipeline""")
def _(spark, folder):
    frame = soc_frame(spark, folder)
    out = frame.select("event_id", *LOW)
    for c, values in features.fit_low_card(frame, LOW).items():
        out = features.encode_values(out, c, features.low_card_table(spark, values), -1.0, small=True)
    return out


# --- text ------------------------------------------------------------------------

CHAR_GRAMS = f"""words AS (SELECT event_id, ' ' || w || ' ' AS w FROM (
    SELECT event_id, unnest(regexp_split_to_array(lower(COALESCE(message_sanitized, '')), '{BLANKS}')) AS w FROM soc_text) q WHERE w <> ''),
  sizes AS (SELECT event_id, w, unnest([1, 2, 3, 4]) AS n FROM words),
  grams AS (SELECT event_id, substr(w, i, n) AS term FROM (
    SELECT event_id, w, n, unnest(range(1, length(w) - n + 2)) AS i FROM sizes WHERE length(w) >= n) q)"""
TEXT_CTE = views.ctes("soc_text") + ", " + CHAR_GRAMS
STATS_SQL = ", per_row AS (SELECT event_id, term, count(*) AS n FROM grams GROUP BY event_id, term), stats AS (SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df FROM per_row GROUP BY term)"
VOCAB_SQL = STATS_SQL + f""", kept AS (SELECT * FROM stats WHERE df >= 3 ORDER BY tf DESC, term LIMIT {TEXT_TERMS}),
  vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS term_id, tf, df,
    ln((1 + CAST((SELECT count(*) FROM soc_text) AS DOUBLE)) / (1 + df)) + 1 AS idf FROM kept)"""


def soc_text(spark, folder):
    return views.load(spark, folder, "soc_text")


@query("char_wb_ngrams", TEXT_CTE + STATS_SQL + "SELECT term, tf, df FROM stats")
def _(spark, folder):
    return textfeat.term_statistics(soc_text(spark, folder), "message_sanitized")


@query("word_ngrams", views.ctes("soc_text") + f"""
, toks AS (SELECT event_id, regexp_extract_all(lower(COALESCE(message_sanitized, '')), '{WORD}') AS t FROM soc_text),
grams AS (SELECT event_id, unnest(t) AS term FROM toks
  UNION ALL SELECT event_id, t[i] || ' ' || t[i + 1] FROM (SELECT event_id, t, unnest(range(1, len(t))) AS i FROM toks) q)
""" + STATS_SQL + "SELECT term, tf, df FROM stats")
def _(spark, folder):
    return textfeat.term_statistics(soc_text(spark, folder), "message_sanitized", "word", (1, 2))


@query("tfidf_vocab", TEXT_CTE + VOCAB_SQL + "SELECT term, term_id, tf, df, round(idf, 6) AS idf FROM vocab")
def _(spark, folder):
    table = textfeat.fit_vocabulary(soc_text(spark, folder), "message_sanitized", max_features=TEXT_TERMS)
    return table.withColumn("idf", r6("idf"))


@query("tfidf_transform", TEXT_CTE + VOCAB_SQL + """
, weighed AS (SELECT event_id, term_id, (1 + ln(CAST(n AS DOUBLE))) * idf AS w FROM per_row JOIN vocab USING (term)),
norms AS (SELECT event_id, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY event_id)
SELECT event_id, term_id, round(w / norm, 6) AS weight FROM weighed JOIN norms USING (event_id)""")
def _(spark, folder):
    rows = soc_text(spark, folder)
    vocabulary = textfeat.fit_vocabulary(rows, "message_sanitized", max_features=TEXT_TERMS)
    long = textfeat.tfidf_long(textfeat.tfidf(rows, vocabulary, "event_id", "message_sanitized"), "event_id")
    return long.withColumn("weight", r6("weight"))


@query("tfidf_empty_guard", views.ctes("soc_text") + """
SELECT 'message' AS text_col, CAST(COALESCE(sum(length(message_sanitized)), 0) > 0 AS INT) AS has_text FROM soc_text
UNION ALL SELECT 'emptied', 0 UNION ALL SELECT 'absent', 0""")
def _(spark, folder):
    rows = soc_text(spark, folder).withColumn("emptied", F.lit(""))
    found = [(name, int(textfeat.has_text(rows, c))) for name, c in
             (("message", "message_sanitized"), ("emptied", "emptied"), ("absent", "no_such_column"))]
    return spark.createDataFrame(found, "text_col string, has_text int")


# --- interactions and selection ----------------------------------------------------

PAIRS = list(itertools.combinations(FRAME_NUMERIC, 2))


@query("pairwise_products", FRAME + "SELECT event_id, " + ", ".join(
    f"round({a} * {b}, 6) AS inter_{a}_{b}" for a, b in PAIRS) + " FROM soc_frame")
def _(spark, folder):
    out = features.pairwise_products(soc_frame(spark, folder), FRAME_NUMERIC, ["event_id"])
    return out.select("event_id", *[r6(c).alias(c) for c in out.columns if c != "event_id"])


VARIANCES = "variances AS (" + " UNION ALL ".join(
    f"SELECT 'inter_{a}_{b}' AS name, var_samp({a} * {b}) AS variance FROM soc_frame" for a, b in PAIRS) + ")"


@query("interaction_top_k", FRAME + f", {VARIANCES} SELECT name, round(variance, 3) AS variance FROM variances ORDER BY variances.variance DESC, name LIMIT 3")
def _(spark, folder):
    found = features.interaction_top_k(soc_frame(spark, folder), FRAME_NUMERIC, 3)
    rows = [(features.interaction_name(a, b), v) for a, b, v in found]
    return spark.createDataFrame(rows, "name string, variance double").withColumn("variance", F.round("variance", 3))


@query("interaction_replay", FRAME + """
SELECT event_id, round(src_port * msg_len, 6) AS inter_src_port_msg_len, round(src_port * 0, 6) AS inter_src_port_gone FROM soc_frame""")
def _(spark, folder):
    """Only the locked products are computed; a column that is gone counts as 0."""
    model = features.FeatureModel("event_id", {"src_port": (0.0, 1.0), "msg_len": (0.0, 1.0)}, {}, {},
                                  [("src_port", "msg_len"), ("src_port", "gone")])
    out = model.transform(soc_frame(spark, folder))
    return out.select("event_id", *[r6(c).alias(c) for c in model.interaction_columns()])


@query("select_by_model", "SELECT 1 AS within_limit, 0 AS below_threshold")
def _(spark, folder):
    frame = soc_frame(spark, folder).select("label_idx", *FRAME_NUMERIC)
    everything = features.select_by_model(frame, FRAME_NUMERIC, "label_idx", threshold=0.0)
    kept = features.select_by_model(frame, FRAME_NUMERIC, "label_idx", threshold="mean", max_features=3)
    cut = everything.agg(F.avg("importance").alias("cut"))
    return kept.join(F.broadcast(cut)).agg(
        (F.count("*").between(1, 3)).cast("int").alias("within_limit"),
        F.count(F.when(F.col("importance") < F.col("cut") - 1e-9, 1)).alias("below_threshold"),
    )


MI_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, label_idx FROM soc_frame" for c in FRAME_NUMERIC)
MI_SQL = f""", long AS ({MI_LONG}),
cuts AS (SELECT feature, unnest([{', '.join(f'quantile_cont(x, {i / 10})' for i in range(1, 10))}]) AS q FROM long GROUP BY feature),
grid AS (SELECT feature, list(q) AS qs FROM cuts GROUP BY feature),
binned AS (SELECT l.feature, len(list_filter(g.qs, lambda q: q < l.x)) AS bin, label_idx FROM long l JOIN grid g USING (feature)),
joint AS (SELECT feature, bin, label_idx, CAST(count(*) AS DOUBLE) AS n FROM binned GROUP BY ALL),
parts AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS nt, sum(n) OVER (PARTITION BY feature, bin) AS nb,
  sum(n) OVER (PARTITION BY feature, label_idx) AS ny FROM joint)
SELECT feature, round(sum(n / nt * ln(n * nt / (nb * ny))), 6) AS importance FROM parts GROUP BY feature"""


@query("select_by_mutual_info", FRAME + MI_SQL + " ORDER BY importance DESC, feature LIMIT 3")
def _(spark, folder):
    out = features.select_by_mutual_info(soc_frame(spark, folder), FRAME_NUMERIC, "label_idx", 3)
    return out.withColumn("importance", r6("importance"))


@query("top_features", FRAME + MI_SQL + " ORDER BY importance DESC, feature LIMIT 2")
def _(spark, folder):
    from wardline.operators.metrics import top_features

    table = features.mutual_information(soc_frame(spark, folder), FRAME_NUMERIC, "label_idx")
    return top_features(table, 2).withColumn("importance", r6("importance"))


@query("pca", "SELECT 3 AS n_components, 0 AS n_not_orthonormal, 0 AS n_not_descending, count(*) AS n_rows FROM events")
def _(spark, folder):
    """Scores must be uncorrelated with falling variance, components orthonormal."""
    frame = soc_frame(spark, folder)
    scaled = features.scale(frame, features.fit_standard(frame, FRAME_NUMERIC), ["event_id"])
    means, components, _ = features.fit_pca(scaled, FRAME_NUMERIC, 3)
    scores = features.pca_project(scaled, FRAME_NUMERIC, means, components, ["event_id"])
    gram = components.T @ components
    bad = int((abs(gram - __import__("numpy").eye(gram.shape[0])) > 1e-6).sum())
    n = components.shape[1]
    falling = [(F.var_samp(f"pca_{i}") < F.var_samp(f"pca_{i + 1}") - 1e-9).cast("int") for i in range(n - 1)]
    return scores.agg(
        F.lit(n).alias("n_components"), F.lit(bad).alias("n_not_orthonormal"),
        sum(falling[1:], falling[0]).alias("n_not_descending"), F.count("*").alias("n_rows"),
    )


@query("selection_replay", FRAME + "SELECT event_id, msg_len, CAST(0 AS DOUBLE) AS gone, src_port FROM soc_frame")
def _(spark, folder):
    return features.select_columns(soc_frame(spark, folder), ["msg_len", "gone", "src_port"], ["event_id"])


# --- the whole model -----------------------------------------------------------------

FIT_COLS = [*FRAME_NUMERIC, *LOW, *HIGH]


def fitted(spark, folder, text: bool = False, **options):
    frame = soc_frame(spark, folder)
    model = features.fit_features(
        frame, FIT_COLS, "event_id", "label_idx", "message_sanitized" if text else None, high_card=HIGH_CARD, **options)
    return frame, model


def sql_feature(c: str) -> str:
    if c in FRAME_NUMERIC:
        return sql_robust(c)
    return {"username": "u.code", "src_ip": "i.code", "product_name": "a.code", "pipeline": "b.code"}[c]


FEATURE_SQL = FRAME + f""", {sql_target('username', 'te_user')}, {sql_target('src_ip', 'te_ip')},
{sql_ranks('product_name', 'o_product')}, {sql_ranks('pipeline', 'o_pipe')},
scaled AS (SELECT f.event_id, f.label_idx, {', '.join(f'{sql_robust(c)} AS {c}' for c in FRAME_NUMERIC)},
  u.code AS username, i.code AS src_ip, a.code AS product_name, b.code AS pipeline FROM soc_frame f
  JOIN te_user u ON u.value = f.username JOIN te_ip i ON i.value = f.src_ip
  JOIN o_product a ON a.value = f.product_name JOIN o_pipe b ON b.value = f.pipeline)
SELECT event_id, {', '.join(f'round({c}, 6) AS {c}' for c in FRAME_NUMERIC + HIGH + LOW)},
  {', '.join(f'round({a} * {b}, 6) AS inter_{a}_{b}' for a, b in PAIRS)} FROM scaled"""


@query("feature_fit_transform", FEATURE_SQL)
def _(spark, folder):
    frame, model = fitted(spark, folder)
    out = model.transform(frame)
    return out.select("event_id", *[r6(c).alias(c) for c in model.scalar_columns()])


@query("state_roundtrip_features", FEATURE_SQL)
def _(spark, folder):
    frame, model = fitted(spark, folder)
    path = scratch_path(spark, "feature-state")
    model.save(spark, path)
    again = features.FeatureModel.load(spark, path)
    return again.transform(frame).select("event_id", *[r6(c).alias(c) for c in again.scalar_columns()])


BASE_NAMES = [*FRAME_NUMERIC, *HIGH, *LOW]
# Terms of the events' own messages: three rows at least, the most frequent up to the limit.
FRAME_TERMS = FRAME + ", " + CHAR_GRAMS.replace("soc_text", "soc_frame") + STATS_SQL + f""",
terms AS (SELECT least({TEXT_TERMS}, count(*)) AS n FROM stats WHERE df >= 3)"""


@query("final_feature_names", FRAME_TERMS + f""", {VARIANCES}
SELECT CAST(i AS BIGINT) AS pos, ([{', '.join(f"'{n}'" for n in BASE_NAMES)}])[i + 1] AS name FROM (SELECT unnest(range({len(BASE_NAMES)})) AS i) q
UNION ALL SELECT {len(BASE_NAMES)} + i, 'tfidf_' || i FROM (SELECT unnest(range(n)) AS i FROM terms) t
UNION ALL SELECT {len(BASE_NAMES)} + (SELECT n FROM terms) + r - 1, name FROM (SELECT name, row_number() OVER (ORDER BY variance DESC, name) AS r FROM variances) v""")
def _(spark, folder):
    _frame, model = fitted(spark, folder, text=True)
    return spark.createDataFrame(list(enumerate(model.feature_names())), "pos bigint, name string")


@query("assemble_features", FRAME_TERMS + """
SELECT event_id, CAST(n + N_OTHERS AS INT) AS n_features, CAST(1 AS DOUBLE) AS text_norm FROM soc_frame, terms""".replace(
    "N_OTHERS", str(len(BASE_NAMES) + len(PAIRS))))
def _(spark, folder):
    """Scalars and sparse text of a row in one vector; the text part has length 1."""
    frame, model = fitted(spark, folder, text=True)
    vectors = model.assemble(model.transform(spread(frame)))
    low = len(model.base_columns())
    high = low + model.vocabulary_size

    @F.udf("n_features int, text_norm double")
    def report(v):
        """From the filled cells: most of the columns of a row are empty."""
        at = v.indices if hasattr(v, "indices") else np.arange(len(v))
        text = v.values[(at >= low) & (at < high)]
        return len(v), float(np.sqrt(np.dot(text, text)))

    values = vectors.select("event_id", report("features").alias("r"))
    return values.select("event_id", "r.n_features", F.round("r.text_norm", 6).alias("text_norm"))
