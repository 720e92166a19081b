"""Class rebalancing: weights, under- and over-sampling, synthesis and cleaning.

Rows are (event_id, label, features array). Random draws are hashes of the draw number, so
a draw is a join on a rank. Synthetic rows get negative ids.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_int, hash_unit
from wardline.operators.hashsearch import knn_lsh
from wardline.operators.neighbors import BLOCK_ROWS, knn
from wardline.operators.ordering import class_counts, hash_rank, with_hash
from wardline.operators.sampling import keep_first
from wardline.session import cut_lineage

# Neighbour counts and default targets.
K_NEIGHBORS = 5
M_NEIGHBORS = 10
ENN_NEIGHBORS = 3
UNDER_TARGETS = {0: 50_000}
OVER_TARGETS = {1: 30_000, 2: 30_000}
DEFAULT_METHOD = "hybrid"


def nearest(df: DataFrame, id_col: str, vec_col: str, k: int, class_col: str | None, block_rows: int, search: str) -> DataFrame:
    """Neighbours by the ``exact`` search, or by ``hashed`` tables: linear traffic, a few near rows missed."""
    if search not in ("exact", "hashed"):
        raise ValueError(f"unknown search {search}")
    if search == "hashed":
        return knn_lsh(df, id_col, vec_col, k, class_col)
    return knn(df, id_col, vec_col, k, class_col, block_rows)


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """(label, n, weight) with weight n / (k * n_label)."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    # One row of totals.
    return counts.join(F.broadcast(totals)).select(
        label_col, "n", (F.col("total") / (F.col("k") * F.col("n"))).alias("weight")
    )


def with_class_weight(df: DataFrame, label_col: str, out: str = "weight") -> DataFrame:
    weights = {r[label_col]: r["weight"] for r in class_weights(df, label_col).collect()}
    value = F.lit(1.0)
    for label, weight in weights.items():
        value = F.when(F.col(label_col) == F.lit(label), weight).otherwise(value)
    return df.withColumn(out, value)


def random_under(df: DataFrame, label_col: str, id_col: str, targets: dict | None = None, seed=SEED) -> DataFrame:
    """The first ``target`` rows of each class in hash order, by default as many as the smallest class has."""
    counts = class_counts(df, label_col)
    targets = targets if targets is not None else {c: min(counts.values()) for c in counts}
    quotas = {c: min(t, counts[c]) for c, t in targets.items() if c in counts}
    quotas.update({c: n for c, n in counts.items() if c not in quotas})
    quotas_needed = {c: q for c, q in quotas.items() if q < counts[c]}
    inside = keep_first(df, label_col, id_col, quotas_needed, seed, rows=sum(counts.values()))
    cut = reduce(lambda a, b: a | b, [F.col(label_col).eqNullSafe(F.lit(c)) for c in quotas_needed], F.lit(False))
    return with_hash(df, id_col, seed).where(~cut | inside).drop("__hash")


def random_over(df: DataFrame, label_col: str, id_col: str, targets: dict | None = None, seed=SEED) -> DataFrame:
    """All rows plus drawn copies up to the target, by default the size of the largest class.

    ``copy`` is 0 for a source row and the draw number for a copy.
    """
    counts = class_counts(df, label_col)
    targets = targets if targets is not None else {c: max(counts.values()) for c in counts}
    extra = {c: targets[c] - counts[c] for c in targets if c in counts and targets[c] > counts[c]}
    out = df.withColumn("copy", F.lit(0).cast("bigint"))
    if not extra:
        return out
    ranked = hash_rank(df.where(F.col(label_col).isin(list(extra))), [label_col], id_col, "__rank", seed)
    drawn = _draws(df, extra, label_col).withColumn("__n", _per_class(label_col, counts))
    drawn = drawn.select(
        label_col, (F.col("s") + 1).alias("copy"),
        (hash_int(seed, F.col(label_col), F.col("s") + 1) % F.col("__n") + 1).alias("__rank"),
    )
    copies = drawn.join(ranked, [label_col, "__rank"]).select(*df.columns, "copy")
    return out.unionByName(copies)


def _draws(df: DataFrame, extra: dict, label_col: str) -> DataFrame:
    """(label, s) with s = 0..extra - 1 for each class, generated where it is used."""
    spark, data_type = df.sparkSession, df.schema[label_col].dataType
    parts = [spark.range(n).select(F.lit(c).cast(data_type).alias(label_col), F.col("id").alias("s")) for c, n in extra.items()]
    return reduce(DataFrame.unionByName, parts)


def _per_class(label_col: str, values: dict):
    out = F.lit(None).cast("bigint")
    for c, v in values.items():
        out = F.when(F.col(label_col) == F.lit(c), F.lit(v).cast("bigint")).otherwise(out)
    return out


def _mix(pairs: DataFrame, label_col: str, id_col: str, vec_col: str, vectors: DataFrame, n_classes: int, seed) -> DataFrame:
    """Synthetic rows from (label, s, base, neighbor): x + u * (z - x), six digits."""
    x = vectors.select(F.col(id_col).alias("base"), F.col(vec_col).cast("array<double>").alias("x"))
    z = vectors.select(F.col(id_col).alias("neighbor"), F.col(vec_col).cast("array<double>").alias("z"))
    u = hash_unit(seed, F.col(label_col), F.col("s"), F.lit("u"))
    both = pairs.withColumn("u", u).join(x, "base").join(z, "neighbor")
    mixed = F.zip_with("x", "z", lambda a, b: F.round(a + F.col("u") * (b - a), 6))
    new_id = -(F.col("s") * n_classes + F.col(label_col) + 1)
    return both.select(new_id.cast("bigint").alias(id_col), label_col, mixed.alias(vec_col))


def _plain(df: DataFrame, label_col: str, id_col: str, vec_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias(id_col), label_col, F.col(vec_col).cast("array<double>").alias(vec_col))


def _missing(counts: dict, targets: dict | None) -> dict:
    top = max(counts.values())
    targets = targets if targets is not None else {c: top for c in counts}
    return {c: targets[c] - counts[c] for c in targets}


def over_feasible(counts: dict, targets: dict | None, k: int = K_NEIGHBORS) -> bool:
    """Every class to be filled exists, is below its target and has more rows than neighbours."""
    targets = targets if targets is not None else {c: max(counts.values()) for c in counts}
    grow = {c for c in targets if targets[c] > counts.get(c, 0)}
    return all(c in counts and targets[c] >= counts[c] for c in targets) and all(counts[c] > k for c in grow)


def _seeded(ranked: DataFrame, extra: dict, sizes: dict, near: DataFrame, label_col: str, id_col: str, k: int, seed) -> DataFrame:
    """(label, s, base, neighbor): base by drawn rank among the seed rows, neighbour by drawn rank."""
    drawn = _draws(ranked, extra, label_col).withColumn("__n", _per_class(label_col, sizes))
    drawn = drawn.select(
        label_col, "s",
        (hash_int(seed, F.col(label_col), F.col("s"), F.lit("r")) % F.col("__n") + 1).alias("__rank"),
        (hash_int(seed, F.col(label_col), F.col("s"), F.lit("n")) % k + 1).cast("int").alias("rank"),
    )
    based = drawn.join(ranked.select(label_col, "__rank", F.col(id_col).alias("base")), [label_col, "__rank"])
    return based.join(near.select(F.col("id").alias("base"), "rank", "neighbor"), ["base", "rank"]).select(
        label_col, "s", "base", "neighbor"
    )


def smote(df: DataFrame, label_col: str, id_col: str, vec_col: str, targets: dict | None = None, k: int = K_NEIGHBORS,
          seed=SEED, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """Rows plus synthetic ones on segments to near rows of the same class."""
    rows = _plain(df, label_col, id_col, vec_col)
    counts = class_counts(rows, label_col)
    if not over_feasible(counts, targets, k):
        return rows
    extra = {c: n for c, n in _missing(counts, targets).items() if n > 0}
    if not extra:
        return rows
    grown = rows.where(F.col(label_col).isin(list(extra)))
    near = nearest(grown, id_col, vec_col, k, label_col, block_rows, search)
    ranked = hash_rank(grown.select(id_col, label_col), [label_col], id_col, "__rank", seed)
    pairs = _seeded(ranked, extra, counts, near, label_col, id_col, k, seed)
    return rows.unionByName(_mix(pairs, label_col, id_col, vec_col, grown, max(counts) + 1, seed))


def _other_class_counts(rows: DataFrame, label_col: str, id_col: str, vec_col: str, m: int, block_rows: int,
                        search: str) -> DataFrame:
    """(id, label, others, seen): how many of the m nearest rows of any class belong to another class."""
    near = nearest(rows, id_col, vec_col, m, None, block_rows, search)
    labels = rows.select(F.col(id_col).alias("neighbor"), F.col(label_col).alias("near_label"))
    own = rows.select(F.col(id_col).alias("id"), label_col)
    return (
        near.select("id", "neighbor").join(labels, "neighbor").join(own, "id")
        .groupBy("id", label_col).agg(
            F.count(F.when(F.col("near_label") != F.col(label_col), 1)).alias("others"), F.count("*").alias("seen"))
        .withColumnRenamed("id", id_col)
    )


def adasyn(df: DataFrame, label_col: str, id_col: str, vec_col: str, k: int = K_NEIGHBORS, seed=SEED,
           block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """As ``smote``, with more synthetic rows where other classes are near.

    Shares are settled by largest remainder. A share takes at most k + 1 values, so the
    quotas come from a table of class x value, and only the last value is cut by hash order.
    """
    rows = _plain(df, label_col, id_col, vec_col)
    counts = class_counts(rows, label_col)
    extra = {c: n for c, n in _missing(counts, None).items() if n > 0}
    if not extra or not over_feasible(counts, None, k):
        return rows
    around = _other_class_counts(rows, label_col, id_col, vec_col, k, block_rows, search).where(F.col(label_col).isin(list(extra)))
    around = cut_lineage(around.withColumn("key", F.concat_ws("|", label_col, "others")))
    table = around.groupBy(label_col, "others", "key").agg(F.count("*").alias("n")).collect()
    base, more = {}, {}
    for c, wanted in extra.items():
        part = [(r["others"], r["n"], r["key"]) for r in table if r[label_col] == c]
        weight = sum(o * n for o, n, _ in part)
        if not weight:
            continue
        left = wanted
        shares = []
        for o, n, key in part:
            whole = wanted * o // weight
            base[key] = whole
            left -= whole * n
            shares.append((-((wanted * o) % weight), -o, n, key))
        for _, _, n, key in sorted(shares):
            more[key] = max(0, min(n, left))
            left -= more[key]
    if not base:
        return rows
    cut = {key: q for key, q in more.items() if q > 0}
    inside = keep_first(around, "key", id_col, cut, seed) if cut else F.lit(False)
    share = _per_class("key", base) + F.when(inside, 1).otherwise(0)
    seeds = with_hash(around, id_col, seed).withColumn("share", share).where(F.col("share") > 0)
    seeds = seeds.select(label_col, F.col(id_col).alias("base"), F.explode(F.sequence(F.lit(1), F.col("share").cast("int"))).alias("turn"))
    # The draw number must be unique per class: rank of the seed row times the largest share, plus the turn.
    width = max(base.values()) + 1
    ranked = hash_rank(around.select(id_col, label_col), [label_col], id_col, "__rank", seed)
    ranked = ranked.select(F.col(id_col).alias("base"), "__rank")
    drawn = seeds.join(ranked, "base").withColumn("s", F.col("__rank") * width + F.col("turn"))
    drawn = drawn.withColumn("rank", (hash_int(seed, F.col(label_col), F.col("s"), F.lit("n")) % k + 1).cast("int"))
    grown = rows.where(F.col(label_col).isin(list(extra)))
    near = nearest(grown, id_col, vec_col, k, label_col, block_rows, search).select(F.col("id").alias("base"), "rank", "neighbor")
    pairs = drawn.join(near, ["base", "rank"]).select(label_col, "s", "base", "neighbor")
    return rows.unionByName(_mix(pairs, label_col, id_col, vec_col, grown, max(counts) + 1, seed))


def danger_rows(df: DataFrame, label_col: str, id_col: str, vec_col: str, m: int = M_NEIGHBORS,
                block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """Rows with at least half, but not all, of their m nearest rows in another class."""
    around = _other_class_counts(df, label_col, id_col, vec_col, m, block_rows, search)
    return around.where((2 * F.col("others") >= m) & (F.col("others") < m)).select(id_col, label_col)


def borderline_smote(df: DataFrame, label_col: str, id_col: str, vec_col: str, targets: dict | None = None,
                     k: int = K_NEIGHBORS, m: int = M_NEIGHBORS, seed=SEED, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """As ``smote``, with seeds from the danger rows only; a class without any is left as it is."""
    rows = _plain(df, label_col, id_col, vec_col)
    counts = class_counts(rows, label_col)
    if not over_feasible(counts, targets, k):
        return rows
    extra = {c: n for c, n in _missing(counts, targets).items() if n > 0}
    danger = danger_rows(rows, label_col, id_col, vec_col, m, block_rows, search).where(F.col(label_col).isin(list(extra)))
    danger = cut_lineage(danger)
    sizes = class_counts(danger, label_col)
    extra = {c: n for c, n in extra.items() if sizes.get(c)}
    if not extra:
        return rows
    grown = rows.where(F.col(label_col).isin(list(extra)))
    near = nearest(grown, id_col, vec_col, k, label_col, block_rows, search)
    ranked = hash_rank(danger, [label_col], id_col, "__rank", seed)
    pairs = _seeded(ranked, extra, sizes, near, label_col, id_col, k, seed)
    return rows.unionByName(_mix(pairs, label_col, id_col, vec_col, grown, max(counts) + 1, seed))


def hybrid_resample(df: DataFrame, label_col: str, id_col: str, vec_col: str, under: dict | None = None,
                    over: dict | None = None, seed=SEED, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """Cut the large class, then synthesise the small ones; a step that cannot be met is skipped."""
    under = UNDER_TARGETS if under is None else under
    over = OVER_TARGETS if over is None else over
    rows = _plain(df, label_col, id_col, vec_col)
    counts = class_counts(rows, label_col)
    if all(c in counts and t <= counts[c] for c, t in under.items()):
        rows = random_under(rows, label_col, id_col, under, seed)
    return smote(rows, label_col, id_col, vec_col, over, seed=seed, block_rows=block_rows, search=search)


def tomek_links(df: DataFrame, label_col: str, id_col: str, vec_col: str, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """(id, neighbor) of mutually nearest rows of different classes, both directions."""
    near = nearest(df, id_col, vec_col, 1, None, block_rows, search).select("id", "neighbor")
    back = near.select(F.col("neighbor").alias("id"), F.col("id").alias("neighbor"))
    labels = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("a"))
    others = df.select(F.col(id_col).alias("neighbor"), F.col(label_col).alias("b"))
    mutual = near.join(back, ["id", "neighbor"], "left_semi")
    return mutual.join(labels, "id").join(others, "neighbor").where(F.col("a") != F.col("b")).select("id", "neighbor")


def drop_tomek(df: DataFrame, label_col: str, id_col: str, vec_col: str, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    links = tomek_links(df, label_col, id_col, vec_col, block_rows, search).select(F.col("id").alias(id_col))
    return df.join(links, id_col, "left_anti")


def enn_clean(df: DataFrame, label_col: str, id_col: str, vec_col: str, k: int = ENN_NEIGHBORS,
              block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    """Rows whose k nearest rows all share their class."""
    mixed = _other_class_counts(df, label_col, id_col, vec_col, k, block_rows, search).where(F.col("others") > 0)
    return df.join(mixed.select(id_col), id_col, "left_anti")


def smote_tomek(df: DataFrame, label_col: str, id_col: str, vec_col: str, seed=SEED, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    grown = cut_lineage(smote(df, label_col, id_col, vec_col, seed=seed, block_rows=block_rows, search=search))
    return drop_tomek(grown, label_col, id_col, vec_col, block_rows, search)


def smote_enn(df: DataFrame, label_col: str, id_col: str, vec_col: str, seed=SEED, block_rows: int = BLOCK_ROWS, search: str = "exact") -> DataFrame:
    grown = cut_lineage(smote(df, label_col, id_col, vec_col, seed=seed, block_rows=block_rows, search=search))
    return enn_clean(grown, label_col, id_col, vec_col, block_rows=block_rows, search=search)


METHODS = {
    "smote": smote, "adasyn": adasyn, "borderline_smote": borderline_smote,
    "hybrid": hybrid_resample, "smote_tomek": smote_tomek, "smote_enn": smote_enn,
}


def resample(df: DataFrame, label_col: str, id_col: str, vec_col: str, method: str = DEFAULT_METHOD, **options) -> DataFrame:
    """Dispatch by name. ``class_weight`` adds a ``weight`` column, an unknown name changes nothing."""
    if method == "class_weight":
        return with_class_weight(df, label_col)
    if method == "random_under":
        return random_under(df, label_col, id_col, **options)
    if method == "random_over":
        return random_over(df, label_col, id_col, **options)
    if method not in METHODS:
        return df
    return METHODS[method](df, label_col, id_col, vec_col, **options)
