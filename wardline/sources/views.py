"""Security-event views over the source tables.

Each statement runs unchanged in Spark SQL and in the SQL used for comparison, so both
sides of a registered query start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOC = """
SELECT event_id, ts,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 89 = 0 THEN 'not-an-ip'
       WHEN event_id % 83 = 0 THEN '2001:db8::1'
       WHEN user_id % 5 = 0 THEN concat('100.64.', CAST(user_id % 7 AS VARCHAR(10)), '.', CAST(user_id % 250 AS VARCHAR(10)))
       WHEN user_id % 3 = 0 THEN concat('8.8.', CAST(user_id % 7 AS VARCHAR(10)), '.', CAST(user_id % 250 AS VARCHAR(10)))
       ELSE concat('10.0.', CAST(user_id % 7 AS VARCHAR(10)), '.', CAST(user_id % 250 AS VARCHAR(10))) END AS src_ip,
  CASE WHEN event_id % 101 = 0 THEN NULL
       ELSE concat('10.0.', CAST(event_id % 7 AS VARCHAR(10)), '.', CAST(event_id % 40 AS VARCHAR(10))) END AS dst_ip,
  CAST(1024 + (event_id * 7919) % 5000 AS INT) AS src_port,
  CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN 'Falcon' WHEN 'purchase' THEN 'ASA Firewall'
       WHEN 'view' THEN 'Other' ELSE 'syslog-app' END AS product_name,
  concat('pipe', CAST(event_id % 4 AS VARCHAR(10))) AS pipeline,
  concat('host', CAST(user_id % 20 AS VARCHAR(10))) AS src_host,
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE concat('u', CAST(user_id AS VARCHAR(10))) END AS username,
  concat(event_type, ' flow user=', CAST(user_id AS VARCHAR(10)), ' props=', props) AS message_sanitized,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS num_value,
  CASE WHEN event_id % 10 < 8 THEN NULL ELSE value * 2 END AS sparse_num,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'suspicious'
       WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'malicious'
       ELSE 'benign' END AS label
FROM {events}
"""

SOC_TEXT = """
SELECT d.doc_id AS event_id, d.text AS message_sanitized, d.source AS src_host,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'malicious'
       WHEN l.quality = 0 THEN 'suspicious' ELSE 'benign' END AS label
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
"""

SOC_VECTORS = """
SELECT vec_id AS event_id, embedding AS features,
  CASE WHEN label <= 6 THEN 0 WHEN label <= 8 THEN 1 ELSE 2 END AS label_idx
FROM {embeddings}
"""

SOC_PRED = """
SELECT event_id, y, p_benign, p_malicious, p_suspicious,
  CASE WHEN p_benign >= p_malicious AND p_benign >= p_suspicious THEN 0
       WHEN p_malicious >= p_suspicious THEN 1 ELSE 2 END AS pred
FROM (
  SELECT event_id, y, CAST(a AS DOUBLE) / (a + b + c) AS p_benign,
    CAST(b AS DOUBLE) / (a + b + c) AS p_malicious, CAST(c AS DOUBLE) / (a + b + c) AS p_suspicious
  FROM (
    SELECT event_id,
      CASE WHEN event_type IN ('signup', 'purchase') THEN 2 WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END AS y,
      1 + (event_id * 31) % 17 + CASE WHEN event_type IN ('click', 'view') THEN 9 ELSE 0 END AS a,
      1 + (event_id * 37) % 13 + CASE WHEN event_type = 'error' THEN 6 ELSE 0 END AS b,
      1 + (event_id * 41) % 19 + CASE WHEN event_type IN ('signup', 'purchase') THEN 9 ELSE 0 END AS c
    FROM {events}) s) q
"""

# Numeric and categorical columns of an event, none missing: input of the feature operators.
SOC_FRAME = """
SELECT event_id,
  CAST(src_port AS DOUBLE) AS src_port, COALESCE(num_value, CAST(0 AS DOUBLE)) AS num_value,
  CAST(hour(ts) AS DOUBLE) AS hour_of_day, CAST(length(message_sanitized) AS DOUBLE) AS msg_len,
  product_name, pipeline, username, COALESCE(src_ip, 'UNKNOWN') AS src_ip, message_sanitized,
  CASE label WHEN 'benign' THEN 0 WHEN 'malicious' THEN 1 ELSE 2 END AS label_idx
FROM ({soc}) soc_rows
"""

_TABLES = {
    "soc": (SOC, ("events",)),
    "soc_text": (SOC_TEXT, ("documents", "labels")),
    "soc_vectors": (SOC_VECTORS, ("embeddings",)),
    "soc_pred": (SOC_PRED, ("events",)),
}


def sql_of(view: str) -> str:
    """The view as plain SQL over the registered tables."""
    if view == "soc_frame":
        return SOC_FRAME.replace("{soc}", sql_of("soc"))
    text, tables = _TABLES[view]
    for table in tables:
        text = text.replace("{" + table + "}", table)
    return text.strip()


def ctes(*views: str) -> str:
    """``WITH`` clause naming the views, for a comparison query."""
    return "WITH " + ", ".join(f"{v} AS ({sql_of(v)})" for v in views)


def load(spark: SparkSession, folder: str, view: str) -> DataFrame:
    if view == "soc_frame":
        return spark.sql(SOC_FRAME.replace("({soc})", "{soc}"), soc=load(spark, folder, "soc"))
    text, tables = _TABLES[view]
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in tables}
    return spark.sql(text, **frames)
