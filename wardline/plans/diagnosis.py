"""IP address and rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions import ip as ipx
from wardline.functions.hashing import sql_hash_int
from wardline.operators import ipfeat, rules, sampling
from wardline.plans.common import SPLIT_SQL, soc, soc_pred
from wardline.plans.registry import query, r6
from wardline.sources import views

SOC_CTE = views.ctes("soc")

SRC_SQL = """SELECT src_ip, count(DISTINCT dst_ip) AS src_dst_ip_count, count(DISTINCT src_port) AS src_port_count,
  count(DISTINCT product_name) AS src_product_count, count(DISTINCT pipeline) AS src_pipeline_count,
  round(CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000, 6) AS src_time_span,
  count(*) AS src_total_events FROM soc WHERE src_ip IS NOT NULL GROUP BY src_ip"""
DST_SQL = """SELECT dst_ip, count(DISTINCT src_ip) AS dst_src_ip_count, count(DISTINCT src_port) AS dst_port_count,
  count(*) AS dst_total_events FROM soc WHERE dst_ip IS NOT NULL GROUP BY dst_ip"""
SRC_STATS = ["src_dst_ip_count", "src_port_count", "src_product_count", "src_pipeline_count", "src_time_span", "src_total_events"]
DST_STATS = ["dst_src_ip_count", "dst_port_count", "dst_total_events"]
STATS_CTE = SOC_CTE + f", src_stats AS ({SRC_SQL}), dst_stats AS ({DST_SQL})"

IPV4 = ipx.IPV4_PATTERN
IPV6 = ipx.IPV6_PATTERN


def sql_long(c: str) -> str:
    part = lambda i: f"CAST(split_part({c}, '.', {i}) AS BIGINT)"
    return (f"(CASE WHEN regexp_matches({c}, '{IPV4}') THEN "
            f"{part(1)} * 16777216 + {part(2)} * 65536 + {part(3)} * 256 + {part(4)} END)")


def sql_private(c: str) -> str:
    n = sql_long(c)
    return (f"CASE WHEN {n} BETWEEN 167772160 AND 184549375 OR {n} BETWEEN 2886729728 AND 2887778303 "
            f"OR {n} BETWEEN 3232235520 AND 3232301055 OR {n} BETWEEN 1681915904 AND 1686110207 THEN 1 "
            f"WHEN {n} IS NOT NULL OR regexp_matches({c}, '{IPV6}') THEN 0 ELSE -1 END")


def sql_prefix(c: str, bits: int) -> str:
    n = sql_long(c)
    return (f"CASE WHEN {n} IS NOT NULL THEN {n} - {n} % {2 ** (32 - bits)} "
            f"WHEN regexp_matches({c}, '{IPV6}') THEN -1 ELSE -2 END")


def _events_without_host(spark, folder):
    return soc(spark, folder).drop("src_host").withColumnRenamed("ts", "timestamp")


@query("src_ip_behavior", SOC_CTE + SRC_SQL)
def _(spark, folder):
    stats = ipfeat.src_ip_behavior(_events_without_host(spark, folder))
    return stats.withColumn("src_time_span", r6("src_time_span"))


@query("dst_ip_behavior", SOC_CTE + DST_SQL)
def _(spark, folder):
    return ipfeat.dst_ip_behavior(soc(spark, folder))


@query("ip_default_stats", STATS_CTE + " UNION ALL ".join(
    [f"SELECT '{c}' AS stat, round(CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE), 6) AS value FROM src_stats" for c in SRC_STATS]
    + [f"SELECT '{c}', round(CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE), 6) FROM dst_stats" for c in DST_STATS]))
def _(spark, folder):
    stats = ipfeat.fit_ip_behavior(_events_without_host(spark, folder)).default_stats()
    return spark.createDataFrame(list(stats.items()), "stat string, value double").withColumn("value", r6("value"))


LOOKUP_SQL = STATS_CTE + "SELECT s.event_id, " + ", ".join(
    [f"round(COALESCE(CAST(a.{c} AS DOUBLE), (SELECT CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) FROM src_stats)), 6) AS {c}" for c in SRC_STATS]
    + [f"round(COALESCE(CAST(b.{c} AS DOUBLE), (SELECT CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) FROM dst_stats)), 6) AS {c}" for c in DST_STATS]
) + " FROM soc s LEFT JOIN src_stats a ON s.src_ip = a.src_ip LEFT JOIN dst_stats b ON s.dst_ip = b.dst_ip"


@query("ip_behavior_lookup", LOOKUP_SQL)
def _(spark, folder):
    events = _events_without_host(spark, folder)
    model = ipfeat.fit_ip_behavior(events)
    out = model.transform(events.select("event_id", "src_ip", "dst_ip"))
    return out.select("event_id", *[r6(c).alias(c) for c in SRC_STATS + DST_STATS])


@query("is_private_ip", SOC_CTE + f"SELECT event_id, src_ip, {sql_private('src_ip')} AS is_private FROM soc")
def _(spark, folder):
    rows = soc(spark, folder).select("event_id", "src_ip")
    return ipfeat.private_columns(rows, src="src_ip").withColumnRenamed("is_private_src", "is_private")


@query("ip_prefix", SOC_CTE + f"SELECT event_id, {sql_prefix('src_ip', 16)} AS prefix_16, {sql_prefix('src_ip', 20)} AS prefix_20 FROM soc")
def _(spark, folder):
    out = ipfeat.prefix_columns(soc(spark, folder).select("event_id", "src_ip"), (16, 20), src="src_ip")
    return out.select("event_id", *[F.col(f"src_prefix_{b}").alias(f"prefix_{b}") for b in (16, 20)])


def sql_same(bits: int) -> str:
    return f"CAST({sql_prefix('src_ip', bits)} = {sql_prefix('dst_ip', bits)} AS INT)"


@query("same_subnet", SOC_CTE + f"SELECT event_id, {sql_same(24)} AS same_24, {sql_same(16)} AS same_16 FROM soc")
def _(spark, folder):
    out = ipfeat.same_subnet(soc(spark, folder).select("event_id", "src_ip", "dst_ip"))
    return out.select("event_id", *[F.col(f"is_same_subnet_{b}").alias(f"same_{b}") for b in (24, 16)])


@query("ip_topology", SOC_CTE + f"""SELECT event_id, {sql_private('src_ip')} AS is_private_src, {sql_private('dst_ip')} AS is_private_dst,
  {sql_same(24)} AS is_same_subnet_24, {sql_same(16)} AS is_same_subnet_16 FROM soc""")
def _(spark, folder):
    out = ipfeat.ip_topology(soc(spark, folder).select("event_id", "src_ip", "dst_ip"))
    return out.drop("src_ip", "dst_ip")


@query("ip_prefix_columns", SOC_CTE + "SELECT event_id, " + ", ".join(
    f"{sql_prefix(c + '_ip', b)} AS {c}_prefix_{b}" for c in ("src", "dst") for b in (16, 24)) + " FROM soc")
def _(spark, folder):
    return ipfeat.ip_prefix_columns(soc(spark, folder).select("event_id", "src_ip", "dst_ip")).drop("src_ip", "dst_ip")


ENTROPY_SQL = """entropy AS (SELECT src_ip, -sum(p * log2(p)) AS h FROM (
    SELECT src_ip, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY src_ip) AS p FROM (
      SELECT src_ip, dst_ip, count(*) AS n FROM soc WHERE src_ip IS NOT NULL AND dst_ip IS NOT NULL GROUP BY src_ip, dst_ip) c) q
  GROUP BY src_ip)"""


@query("ip_octets_entropy", SOC_CTE + f", {ENTROPY_SQL}, ips AS (SELECT DISTINCT src_ip FROM soc WHERE src_ip IS NOT NULL)" + f"""
SELECT i.src_ip, {', '.join(f"CASE WHEN regexp_matches(i.src_ip, '{IPV4}') THEN CAST(split_part(i.src_ip, '.', {k}) AS INT) ELSE -1 END AS octet_{k}" for k in range(1, 5))},
  CASE WHEN NOT regexp_matches(i.src_ip, '{IPV4}') THEN NULL WHEN CAST(split_part(i.src_ip, '.', 1) AS INT) < 128 THEN 'A'
    WHEN CAST(split_part(i.src_ip, '.', 1) AS INT) < 192 THEN 'B' WHEN CAST(split_part(i.src_ip, '.', 1) AS INT) < 224 THEN 'C'
    WHEN CAST(split_part(i.src_ip, '.', 1) AS INT) < 240 THEN 'D' ELSE 'E' END AS ip_class,
  round(e.h, 6) + 0 AS dst_entropy
FROM ips i LEFT JOIN entropy e ON e.src_ip = i.src_ip""")
def _(spark, folder):
    events = soc(spark, folder)
    addresses = events.select("src_ip").where("src_ip IS NOT NULL").distinct()
    out = ipfeat.ip_octets(addresses).join(ipfeat.ip_entropy(events), "src_ip", "left")
    octets = {f"octet_{i}": F.coalesce(F.col(f"octet_{i}"), F.lit(-1)) for i in range(1, 5)}
    return out.withColumns(octets).withColumn("dst_entropy", r6("dst_entropy"))


def _window_text(df):
    return df.select(
        "src_ip", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")], "events", "dst_ips"
    )


STAMP = "'%Y-%m-%d %H:%M:%S'"


@query("ip_activity_windows", SOC_CTE + f"""
SELECT src_ip, strftime(date_trunc('hour', ts), {STAMP}) AS window_start,
  strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {STAMP}) AS window_end, count(*) AS events, count(DISTINCT dst_ip) AS dst_ips
FROM soc WHERE src_ip IS NOT NULL GROUP BY src_ip, date_trunc('hour', ts)""")
def _(spark, folder):
    return _window_text(ipfeat.ip_activity_windows(soc(spark, folder), "ts"))


@query("ip_activity_sliding", SOC_CTE + f"""
, starts AS (SELECT src_ip, dst_ip, time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(15 * k) AS start
  FROM soc, (SELECT unnest(range(4)) AS k) o WHERE src_ip IS NOT NULL)
SELECT src_ip, strftime(start, {STAMP}) AS window_start, strftime(start + INTERVAL 1 HOUR, {STAMP}) AS window_end,
  count(*) AS events, count(DISTINCT dst_ip) AS dst_ips FROM starts GROUP BY src_ip, start""")
def _(spark, folder):
    return _window_text(ipfeat.ip_activity_windows(soc(spark, folder), "ts", "1 hour", "15 minutes"))


# --- rules ---------------------------------------------------------------------

@query("label_purity", SOC_CTE + """
, counts AS (SELECT product_name, label, count(*) AS n, sum(count(*)) OVER (PARTITION BY product_name) AS total,
    row_number() OVER (PARTITION BY product_name ORDER BY count(*) DESC, label) AS r FROM soc GROUP BY product_name, label)
SELECT product_name, CAST(total AS BIGINT) AS n_rows, label AS top_label, round(CAST(n AS DOUBLE) / total, 6) AS purity,
  CAST(CAST(n AS DOUBLE) / total >= 0.99 AND total >= 30 AS INT) AS is_pure FROM counts WHERE r = 1""")
def _(spark, folder):
    out = rules.label_purity(soc(spark, folder), "product_name", "label")
    return out.withColumn("purity", r6("purity"))


PURE = "('Precinct', 'Falcon', 'AWS VPC Security', 'ASA Firewall')"


def _scored(spark, folder):
    scores = soc_pred(spark, folder).select("event_id", "y", "pred", "p_malicious")
    return soc(spark, folder).join(scores, "event_id")


@query("purity_rule", views.ctes("soc", "soc_pred") + f"""
SELECT s.event_id, CASE WHEN product_name IN {PURE} THEN 'suspicious' WHEN pred = 0 THEN 'benign' WHEN pred = 1 THEN 'malicious'
  ELSE 'suspicious' END AS rule_label FROM soc s JOIN soc_pred p ON p.event_id = s.event_id""")
def _(spark, folder):
    from wardline.operators.prep import decode_label
    from wardline.plans.common import LABELS

    rows = _scored(spark, folder).withColumn("model_label", decode_label(F.col("pred"), LABELS))
    return rules.purity_rule(rows, "model_label").select("event_id", "rule_label")


HARD_SQL = f"""event_id, CAST(COALESCE(product_name IN {PURE}, FALSE) AS INT) AS is_sus_product,
  CAST(COALESCE(product_name, '') = '' AS INT) AS is_empty_product, CAST(COALESCE(username = '-', FALSE) AS INT) AS username_is_dash,
  CAST(COALESCE(src_ip, '') <> '' AS INT) AS has_src_ip,
  CAST(COALESCE({sql_long('src_ip')} BETWEEN 1681915904 AND 1686110207, FALSE) AS INT) AS src_ip_cgnat,
  CAST(len(regexp_extract_all(lower(message_sanitized), '\\b(flow|src|dst|sport|dport|proto|bytes|packets)\\b')) AS INT) AS msg_flow_tokens"""
HARD_NAMES = ["is_sus_product", "is_empty_product", "username_is_dash", "has_src_ip", "src_ip_cgnat", "msg_flow_tokens"]


@query("hard_features", SOC_CTE + f"SELECT {HARD_SQL} FROM soc")
def _(spark, folder):
    return rules.hard_features(soc(spark, folder)).select("event_id", *HARD_NAMES)


@query("two_stage", views.ctes("soc", "soc_pred") + f"""
SELECT s.event_id, CASE WHEN COALESCE(product_name, '') = '' THEN CASE WHEN p_malicious >= 0.5 THEN 'malicious' ELSE 'benign' END
  WHEN product_name IN {PURE} THEN 'suspicious' ELSE 'benign' END AS stage_label
FROM soc s JOIN soc_pred p ON p.event_id = s.event_id""")
def _(spark, folder):
    return rules.two_stage(_scored(spark, folder), "p_malicious").select("event_id", "stage_label")


@query("group_split", SOC_CTE + f"""
SELECT event_id, src_host, CASE WHEN {sql_hash_int('42', 'src_host')} % 1000 < 150 THEN 'val' ELSE 'train' END AS split FROM soc""")
def _(spark, folder):
    return sampling.group_split(soc(spark, folder).select("event_id", "src_host"), "src_host")


def _sides(spark, folder):
    rows = sampling.group_split(soc(spark, folder), "username")
    return rows.where("split = 'train'"), rows.where("split = 'val'")


SIDES = SOC_CTE + f", sides AS (SELECT *, {SPLIT_SQL} AS split FROM soc)"
OOV_COLS = ["src_host", "product_name", "username", "src_ip"]


@query("oov_rate", SIDES + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count(*) AS n_rows, CAST(count(*) FILTER (WHERE NOT seen) AS BIGINT) AS n_oov,
  round(CAST(count(*) FILTER (WHERE NOT seen) AS DOUBLE) / count(*), 6) AS oov_rate FROM (
  SELECT {c} IN (SELECT {c} FROM sides WHERE split = 'train' AND {c} IS NOT NULL) AS seen
  FROM sides WHERE split = 'val' AND {c} IS NOT NULL) q""" for c in OOV_COLS))
def _(spark, folder):
    train, test = _sides(spark, folder)
    return rules.oov_rate(train, test, OOV_COLS).withColumn("oov_rate", r6("oov_rate"))


@query("distribution_shift", SIDES + """
, shares AS (SELECT src_host AS value, CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) / (SELECT count(*) FROM sides WHERE split = 'train') AS p,
    CAST(count(*) FILTER (WHERE split = 'val') AS DOUBLE) / (SELECT count(*) FROM sides WHERE split = 'val') AS q FROM sides GROUP BY src_host)
SELECT value, round(p, 6) AS p_train, round(q, 6) AS p_test, round(abs(p - q) / 2, 6) AS half_diff FROM shares""")
def _(spark, folder):
    train, test = _sides(spark, folder)
    out = rules.distribution_shift(train, test, "src_host")
    return out.select("value", *[r6(c).alias(c) for c in ("p_train", "p_test", "half_diff")])


@query("distribution_shift_total", SIDES + """
, shares AS (SELECT src_host AS value, CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) / (SELECT count(*) FROM sides WHERE split = 'train') AS p,
    CAST(count(*) FILTER (WHERE split = 'val') AS DOUBLE) / (SELECT count(*) FROM sides WHERE split = 'val') AS q FROM sides GROUP BY src_host)
SELECT count(*) AS n_values, round(sum(abs(p - q)) / 2, 6) AS total_diff FROM shares""")
def _(spark, folder):
    train, test = _sides(spark, folder)
    out = rules.distribution_shift(train, test, "src_host")
    return out.agg(F.count("*").alias("n_values"), r6(F.sum("half_diff")).alias("total_diff"))


@query("prediction_jaccard", views.ctes("soc", "soc_pred") + f"""
, flagged AS (SELECT s.event_id, pred <> 0 AS l, product_name = '' AND p_malicious >= 0.25 OR product_name IN {PURE} AS r
  FROM soc s JOIN soc_pred p ON p.event_id = s.event_id)
SELECT count(*) FILTER (WHERE l AND r) AS n_both, count(*) FILTER (WHERE l OR r) AS n_any,
  round(CAST(count(*) FILTER (WHERE l AND r) AS DOUBLE) / count(*) FILTER (WHERE l OR r), 6) AS jaccard FROM flagged""")
def _(spark, folder):
    rows = rules.two_stage(_scored(spark, folder), "p_malicious", cut=0.25)
    out = rules.prediction_jaccard(rows.where("pred <> 0"), rows.where("stage_label <> 'benign'"))
    return out.withColumn("jaccard", r6("jaccard"))


@query("slice_recall", views.ctes("soc", "soc_pred") + """
SELECT product_name, count(*) AS n_rows, round(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy, count(*) FILTER (WHERE y = 1) AS n_pos,
  round(CASE WHEN count(*) FILTER (WHERE y = 1) = 0 THEN 0 ELSE CAST(count(*) FILTER (WHERE y = 1 AND pred = 1) AS DOUBLE) / count(*) FILTER (WHERE y = 1) END, 6) AS recall
FROM soc s JOIN soc_pred p ON p.event_id = s.event_id GROUP BY product_name""")
def _(spark, folder):
    out = rules.slice_recall(_scored(spark, folder), ["product_name"], "y", "pred")
    return out.withColumn("accuracy", r6("accuracy")).withColumn("recall", r6("recall"))


@query("event_profile", LOOKUP_SQL.replace("SELECT s.event_id,", f"""
, hard AS (SELECT {HARD_SQL} FROM soc), topo AS (SELECT event_id, {sql_private('src_ip')} AS is_private_src, {sql_private('dst_ip')} AS is_private_dst,
  {sql_same(24)} AS is_same_subnet_24, {sql_same(16)} AS is_same_subnet_16 FROM soc)
SELECT s.event_id, {', '.join('h.' + c for c in HARD_NAMES)}, t.is_private_src, t.is_private_dst, t.is_same_subnet_24, t.is_same_subnet_16,""", 1)
    + " JOIN hard h ON h.event_id = s.event_id JOIN topo t ON t.event_id = s.event_id")
def event_profile(spark, folder):
    """Flagship: every event with the behaviour of its addresses, topology and content signals."""
    events = _events_without_host(spark, folder)
    model = ipfeat.fit_ip_behavior(events)
    out = ipfeat.ip_topology(rules.hard_features(model.transform(events)))
    return out.select(
        "event_id", *HARD_NAMES, "is_private_src", "is_private_dst", "is_same_subnet_24", "is_same_subnet_16",
        *[r6(c).alias(c) for c in SRC_STATS + DST_STATS],
    )
