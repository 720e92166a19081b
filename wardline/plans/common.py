"""Shared inputs and SQL fragments of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardline.functions.hashing import sql_hash_hex, sql_hash_int
from wardline.operators import prep
from wardline.sources import views

LABELS = ["benign", "malicious", "suspicious"]
PROBS = ["p_benign", "p_malicious", "p_suspicious"]
ID_COLS, TEXT_COLS, LABEL_COL = ["event_id", "ts"], ["message_sanitized"], "label"
NUMERIC, CATEGORICAL = ["src_port", "num_value"], ["src_ip", "dst_ip", "product_name", "pipeline", "src_host", "username"]
FRAME_NUMERIC = ["src_port", "num_value", "hour_of_day", "msg_len"]

# Group split of the events by user, both sides kept: train and scored events in one column.
SPLIT_SQL = f"CASE WHEN {sql_hash_int('42', 'username')} % 1000 < 150 THEN 'val' ELSE 'train' END"


def soc(spark: SparkSession, folder: str) -> DataFrame:
    return views.load(spark, folder, "soc")


def soc_pred(spark: SparkSession, folder: str) -> DataFrame:
    return views.load(spark, folder, "soc_pred")


def soc_frame(spark: SparkSession, folder: str) -> DataFrame:
    return views.load(spark, folder, "soc_frame")


def fitted_prep(spark: SparkSession, folder: str) -> tuple[DataFrame, prep.PrepModel]:
    rows = soc(spark, folder)
    return rows, prep.fit_prep(rows, ID_COLS, TEXT_COLS, LABEL_COL)


def sql_mode(col: str, source: str = "soc") -> str:
    return (f"COALESCE((SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1), 'UNKNOWN')")


def sql_median(col: str, source: str = "soc") -> str:
    return f"COALESCE((SELECT CAST(median(CAST({col} AS DOUBLE)) AS DOUBLE) FROM {source}), 0)"


LABEL_SQL = "CASE label WHEN 'benign' THEN 0 WHEN 'malicious' THEN 1 WHEN 'suspicious' THEN 2 ELSE -1 END"

PREP_SELECT = "SELECT event_id, " + LABEL_SQL + " AS label_idx, " + ", ".join(
    [f"COALESCE({c}, {sql_mode(c)}) AS {c}" for c in ("src_ip", "dst_ip")]
    + [f"COALESCE(CAST(src_port AS DOUBLE), {sql_median('src_port')}) AS src_port"]
    + [f"COALESCE({c}, {sql_mode(c)}) AS {c}" for c in ("product_name", "pipeline", "src_host", "username")]
    + [f"COALESCE(num_value, {sql_median('num_value')}) AS num_value"]
) + " FROM soc"


def split_ctes(source: str, label: str, id_col: str = "event_id", share: float = 0.15) -> str:
    """CTE ``split_rows``: the source rows with their side, by quota in hash order."""
    order = f"{sql_hash_hex('42', id_col)}, {id_col}"
    return f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {order}) AS rn,
      count(*) OVER (PARTITION BY {label}) AS nc FROM {source}),
    split_rows AS (SELECT *, CASE WHEN rn <= floor(nc * {share} + 0.5) THEN 'val' ELSE 'train' END AS split FROM ranked)"""
