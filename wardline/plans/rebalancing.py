"""Resampling queries on the vector table."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.hashing import sql_hash_hex, sql_hash_int, sql_hash_unit
from wardline.operators import resample
from wardline.operators.hashsearch import knn_lsh, knn_some, recall
from wardline.operators.neighbors import knn
from wardline.operators.ordering import class_counts
from wardline.plans.common import soc
from wardline.plans.registry import query, r6, violations
from wardline.session import cut_lineage
from wardline.sources import views

VEC = "soc_vectors"


def vectors(spark, folder):
    return views.load(spark, folder, VEC)


def micro(df):
    """Vectors as whole numbers of millionths in one text, so both engines print them alike."""
    text = F.array_join(F.transform("features", lambda x: F.round(x * F.lit(1e6)).cast("bigint").cast("string")), ",")
    return df.select("event_id", "label_idx", text.alias("feature_micro"))


SQL_MICRO = "array_to_string(list_transform(features, lambda x: CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR)), ',') AS feature_micro"
VECTORS = f"WITH {VEC} AS ({views.sql_of(VEC)}), vecs AS (SELECT event_id, label_idx, CAST(features AS DOUBLE[]) AS features FROM {VEC})"


def sql_near(name: str, source: str, k: int, same_class: bool) -> str:
    same = "AND a.label_idx = b.label_idx" if same_class else ""
    return f"""{name} AS (SELECT id, neighbor, CAST(r AS INT) AS rank, dist2 FROM (
      SELECT id, neighbor, dist2, row_number() OVER (PARTITION BY id ORDER BY dist2, neighbor) AS r FROM (
        SELECT a.event_id AS id, b.event_id AS neighbor,
          round(list_sum(list_transform(list_zip(a.features, b.features), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) AS dist2
        FROM {source} a JOIN {source} b ON a.event_id <> b.event_id {same}) d) q WHERE r <= {k})"""


def sql_others(name: str, source: str, k: int) -> str:
    """Rows with the number of other-class rows among their k nearest."""
    return sql_near(f"{name}_near", source, k, False) + f""", {name} AS (
      SELECT a.event_id, a.label_idx, a.features, count(*) FILTER (WHERE b.label_idx <> a.label_idx) AS others
      FROM {source} a JOIN {name}_near n ON n.id = a.event_id JOIN {source} b ON b.event_id = n.neighbor
      GROUP BY a.event_id, a.label_idx, a.features)"""


def sql_smote(name: str, source: str, targets: str, seeds: str | None = None) -> str:
    """``targets`` yields (label_idx, target); ``seeds`` (event_id, label_idx) limits the base rows."""
    order = f"{sql_hash_hex('42', 'event_id')}, event_id"
    return sql_near(f"{name}_near", source, 5, True) + f""",
    {name}_n AS (SELECT label_idx, count(*) AS n FROM {source} GROUP BY label_idx),
    {name}_ranked AS (SELECT event_id, label_idx, row_number() OVER (PARTITION BY label_idx ORDER BY {order}) - 1 AS idx,
      count(*) OVER (PARTITION BY label_idx) AS seeds FROM {seeds or source}),
    {name}_draws AS (SELECT label_idx, unnest(range(target - n)) AS s FROM ({targets}) t JOIN {name}_n USING (label_idx) WHERE target > n AND n > 5),
    {name}_based AS (SELECT d.label_idx, d.s, r.event_id AS base, 1 + {sql_hash_int('42', 'd.label_idx', 'd.s', "'n'")} % 5 AS rank
      FROM {name}_draws d JOIN {name}_ranked r ON r.label_idx = d.label_idx
        AND r.idx = {sql_hash_int('42', 'd.label_idx', 'd.s', "'r'")} % r.seeds),
    {name}_new AS (SELECT -(b.s * 3 + b.label_idx + 1) AS event_id, b.label_idx,
        list_transform(list_zip(x.features, z.features), lambda p: round(p[1] + {sql_hash_unit('42', 'b.label_idx', 'b.s', "'u'")} * (p[2] - p[1]), 6)) AS features
      FROM {name}_based b JOIN {name}_near k ON k.id = b.base AND k.rank = b.rank
      JOIN {source} x ON x.event_id = b.base JOIN {source} z ON z.event_id = k.neighbor),
    {name} AS (SELECT event_id, label_idx, features FROM {source} UNION ALL SELECT event_id, label_idx, features FROM {name}_new)"""


EQUAL = "SELECT label_idx, (SELECT max(c) FROM (SELECT count(*) AS c FROM vecs GROUP BY label_idx) m) AS target FROM (SELECT DISTINCT label_idx FROM vecs) l"
ROWS = f"SELECT event_id, label_idx, {SQL_MICRO} FROM "


@query("class_weights", views.ctes("soc") + """
SELECT label, count(*) AS n, round(CAST((SELECT count(*) FROM soc) AS DOUBLE) / ((SELECT count(DISTINCT label) FROM soc) * count(*)), 6) AS weight
FROM soc GROUP BY label""")
def _(spark, folder):
    out = resample.class_weights(soc(spark, folder), "label")
    return out.withColumn("weight", r6("weight"))


@query("random_under", views.ctes("soc") + f"""
, ranked AS (SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash_hex('42', 'event_id')}, event_id) AS rn FROM soc)
SELECT event_id, label FROM ranked WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM soc GROUP BY label) q)""")
def _(spark, folder):
    return resample.random_under(soc(spark, folder).select("event_id", "label"), "label", "event_id")


@query("random_over", views.ctes("soc") + f"""
, ranked AS (SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash_hex('42', 'event_id')}, event_id) - 1 AS idx,
    count(*) OVER (PARTITION BY label) AS n FROM soc),
sizes AS (SELECT label, count(*) AS n, (SELECT max(c) FROM (SELECT count(*) AS c FROM soc GROUP BY label) m) AS target FROM soc GROUP BY label),
draws AS (SELECT label, n, unnest(range(1, target - n + 1)) AS k FROM sizes)
SELECT event_id, label, CAST(0 AS BIGINT) AS copy FROM soc
UNION ALL SELECT r.event_id, d.label, d.k FROM draws d JOIN ranked r ON r.label = d.label AND r.idx = {sql_hash_int('42', 'd.label', 'd.k')} % d.n""")
def _(spark, folder):
    return resample.random_over(soc(spark, folder).select("event_id", "label"), "label", "event_id")


@query("knn_within_class", VECTORS + f", {sql_near('near', 'vecs', 5, True)} SELECT id, neighbor, rank, dist2 FROM near")
def _(spark, folder):
    return knn(vectors(spark, folder), "event_id", "features", 5, "label_idx")


@query("knn_any_class", VECTORS + f", {sql_near('near', 'vecs', 10, False)} SELECT id, neighbor, rank, dist2 FROM near")
def _(spark, folder):
    return knn(vectors(spark, folder), "event_id", "features", 10)


@query("knn_lsh", f"""SELECT count(*) AS n_queries, 1 AS recall_reached, 0 AS n_wrong, (SELECT count(*) * 5 FROM ({views.sql_of(VEC)}) a) AS n_rows
FROM ({views.sql_of(VEC)}) v WHERE event_id % 50 = 0""")
def _(spark, folder):
    """Recall of the hashed search on every id divisible by 50, against all rows of its class."""
    rows = vectors(spark, folder)
    found = cut_lineage(knn_lsh(rows, "event_id", "features", 5, "label_idx"))
    exact = knn_some(rows.where("event_id % 50 = 0"), rows, "event_id", "features", 5, "label_idx")
    seen = recall(found, exact)
    return seen.crossJoin(F.broadcast(found.agg(F.count("*").alias("n_rows")))).select(
        "n_queries", (F.col("recall") >= 0.9).cast("int").alias("recall_reached"), "n_wrong", "n_rows")


@query("smote_hashed", f"""WITH {VEC} AS ({views.sql_of(VEC)}), counts AS (SELECT label_idx, count(*) AS n FROM {VEC} GROUP BY label_idx)
SELECT label_idx, max(n) OVER () AS n_rows, max(n) OVER () - n AS n_synthetic, 0 AS n_off_segment FROM counts""")
def _(spark, folder):
    """Classes end equal, and every synthetic row lies on a segment between two rows of its class."""
    rows = vectors(spark, folder)
    return _class_report(rows, resample.smote(rows, "label_idx", "event_id", "features", search="hashed"))


@query("smote", VECTORS + f", {sql_smote('grown', 'vecs', EQUAL)} {ROWS} grown")
def _(spark, folder):
    return micro(resample.smote(vectors(spark, folder), "label_idx", "event_id", "features"))


@query("adasyn", f"""WITH {VEC} AS ({views.sql_of(VEC)}), counts AS (SELECT label_idx, count(*) AS n FROM {VEC} GROUP BY label_idx)
SELECT label_idx, max(n) OVER () AS n_rows, max(n) OVER () - n AS n_synthetic, 0 AS n_off_segment FROM counts""")
def _(spark, folder):
    """Classes end equal, and no synthetic row lies beyond the box of its class."""
    rows = vectors(spark, folder)
    out = resample.adasyn(rows, "label_idx", "event_id", "features")
    return _class_report(rows, out)


def _class_report(rows, out):
    """(label, rows, synthetic rows, synthetic rows outside the value range of their class)."""
    values = rows.select("label_idx", F.posexplode("features").alias("pos", "x"))
    box = values.groupBy("label_idx", "pos").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    synthetic = out.where("event_id < 0").select("event_id", "label_idx", F.posexplode("features").alias("pos", "x"))
    outside = (F.col("x") < F.col("low") - 1e-6) | (F.col("x") > F.col("high") + 1e-6)
    off = (
        synthetic.join(box, ["label_idx", "pos"]).groupBy("label_idx", "event_id").agg(F.max(outside.cast("int")).alias("off"))
        .groupBy("label_idx").agg(F.sum("off").alias("n_off_segment"))
    )
    return out.groupBy("label_idx").agg(
        F.count("*").alias("n_rows"), F.count(F.when(F.col("event_id") < 0, 1)).alias("n_synthetic")
    ).join(off, "label_idx", "left").fillna(0, ["n_off_segment"])


DANGER = sql_others("around", "vecs", 10) + ", danger AS (SELECT event_id, label_idx FROM around WHERE 2 * others >= 10 AND others < 10)"


@query("borderline_smote", VECTORS + f", {DANGER}, {sql_smote('grown', 'vecs', EQUAL, 'danger')} {ROWS} grown")
def _(spark, folder):
    return micro(resample.borderline_smote(vectors(spark, folder), "label_idx", "event_id", "features"))


HYBRID = f""", c AS (SELECT label_idx, count(*) AS n FROM vecs GROUP BY label_idx),
t AS (SELECT (SELECT n * 6 // 10 FROM c WHERE label_idx = 0) AS under, (SELECT n * 4 // 10 FROM c WHERE label_idx = 0) AS over),
kept AS (SELECT event_id, label_idx, features FROM (SELECT *, row_number() OVER (PARTITION BY label_idx ORDER BY {sql_hash_hex('42', 'event_id')}, event_id) AS rn FROM vecs) q
  WHERE label_idx <> 0 OR rn <= (SELECT under FROM t))"""


@query("hybrid_resample", VECTORS + HYBRID + f""", {sql_smote('grown', 'kept', 'SELECT unnest([1, 2]) AS label_idx, (SELECT over FROM t) AS target')} {ROWS} grown""")
def _(spark, folder):
    rows = vectors(spark, folder)
    largest = class_counts(rows, "label_idx")[0]
    over = {1: largest * 4 // 10, 2: largest * 4 // 10}
    return micro(resample.hybrid_resample(rows, "label_idx", "event_id", "features", {0: largest * 6 // 10}, over))


def sql_tomek(name: str, source: str) -> str:
    return sql_near(f"{name}_near", source, 1, False) + f""", {name} AS (
      SELECT a.id, a.neighbor FROM {name}_near a JOIN {name}_near b ON b.id = a.neighbor AND b.neighbor = a.id
      JOIN {source} x ON x.event_id = a.id JOIN {source} y ON y.event_id = a.neighbor WHERE x.label_idx <> y.label_idx)"""


@query("tomek_links", VECTORS + f", {sql_tomek('links', 'vecs')} SELECT id, neighbor FROM links")
def _(spark, folder):
    return resample.tomek_links(vectors(spark, folder), "label_idx", "event_id", "features")


@query("smote_tomek", VECTORS + f", {sql_smote('grown', 'vecs', EQUAL)}, {sql_tomek('links', 'grown')} {ROWS} grown WHERE event_id NOT IN (SELECT id FROM links)")
def _(spark, folder):
    return micro(resample.smote_tomek(vectors(spark, folder), "label_idx", "event_id", "features"))


@query("enn_clean", VECTORS + f", {sql_others('around', 'vecs', 3)} SELECT event_id, label_idx FROM around WHERE others = 0")
def _(spark, folder):
    return resample.enn_clean(vectors(spark, folder), "label_idx", "event_id", "features").select("event_id", "label_idx")


@query("smote_enn", VECTORS + f", {sql_smote('grown', 'vecs', EQUAL)}, {sql_others('around', 'grown', 3)} {ROWS} around WHERE others = 0")
def _(spark, folder):
    return micro(resample.smote_enn(vectors(spark, folder), "label_idx", "event_id", "features"))


@query("resample", VECTORS + f", {sql_smote('grown', 'vecs', EQUAL)} SELECT 'smote' AS method, label_idx, count(*) AS n FROM grown GROUP BY label_idx"
       + " UNION ALL SELECT 'no_such_method', label_idx, count(*) FROM vecs GROUP BY label_idx"
       + " UNION ALL SELECT 'class_weight', label_idx, count(*) FROM vecs GROUP BY label_idx")
def _(spark, folder):
    parts = []
    for method in ("smote", "no_such_method", "class_weight"):
        out = resample.resample(vectors(spark, folder), "label_idx", "event_id", "features", method)
        parts.append(out.groupBy("label_idx").agg(F.count("*").alias("n")).select(F.lit(method).alias("method"), "label_idx", "n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
