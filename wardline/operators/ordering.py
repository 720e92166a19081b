"""Order statistics, ranks and running sums that never put a whole table into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_hex
from wardline.session import cut_lineage

# Rows one sort task or one driver-side table may hold.
BUCKET_ROWS = 500_000
SMALL_ROWS = 1_000_000
MAX_HEX = 4
MAX_CLASSES = 10_000


# --- exact quantiles ---------------------------------------------------------

def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    small_rows: int = SMALL_ROWS, accuracy: int = 10_000) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns.

    A small table is answered by ``percentile``. On a large one that function would
    hold every distinct value in one buffer, so sketches bracket the wanted order
    statistics, the rows inside the brackets are counted per value, and the brackets
    shrink until the counts fit; the result is exact either way.
    """
    if not cols:
        return {}
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    numbers = numbers.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in cols])
    counts = numbers.agg(*[F.count(c).alias(c) for c in cols]).first()
    if max(counts) <= small_rows:
        row = numbers.agg(
            *[F.percentile(c, F.array(*[F.lit(float(p)) for p in probs])).alias(c) for c in cols]
        ).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}

    wanted: dict[str, set[int]] = {}
    for c in cols:
        ranks: set[int] = set()
        for p in probs:
            place = p * (counts[c] - 1)
            ranks |= {math.floor(place), math.ceil(place)} if counts[c] else set()
        wanted[c] = ranks
    found = _select_ranks(numbers, wanted, small_rows, accuracy)

    out: dict[str, list[float | None]] = {}
    for c in cols:
        values: list[float | None] = []
        for p in probs:
            if not counts[c]:
                values.append(None)
                continue
            place = p * (counts[c] - 1)
            low, high = math.floor(place), math.ceil(place)
            a, b = found[c, low], found[c, high]
            values.append(a if low == high else (high - place) * a + (place - low) * b)
        out[c] = values
    return out


def _select_ranks(numbers: DataFrame, wanted: dict[str, set[int]], small_rows: int,
                  accuracy: int) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks of each column, by shrinking brackets [low, high]."""
    open_ranks = {(c, r): (-math.inf, math.inf) for c, ranks in wanted.items() for r in ranks}
    found: dict[tuple[str, int], float] = {}
    while open_ranks:
        keys = list(open_ranks)
        aggs = []
        for i, key in enumerate(keys):
            low, high = open_ranks[key]
            c = F.col(key[0])
            inside = F.when((c >= F.lit(low)) & (c <= F.lit(high)), c)
            aggs += [
                F.count(F.when(c < F.lit(low), 1)).alias(f"below{i}"),
                F.count(inside).alias(f"inside{i}"),
                F.min(inside).alias(f"min{i}"),
                F.max(inside).alias(f"max{i}"),
            ]
        first = numbers.agg(*aggs).first()
        shares = []
        for i, key in enumerate(keys):
            low, high = open_ranks[key]
            c = F.col(key[0])
            inside = F.when((c >= F.lit(low)) & (c <= F.lit(high)), c)
            share = (key[1] - first[f"below{i}"] + 0.5) / first[f"inside{i}"]
            slack = 2.0 / accuracy
            points = [min(max(share + d, 0.0), 1.0) for d in (-slack, slack)]
            shares.append(F.percentile_approx(inside, points, accuracy).alias(f"p{i}"))
        second = numbers.agg(*shares).first()
        verify = []
        for i, key in enumerate(keys):
            low, high = second[f"p{i}"]
            c = F.col(key[0])
            verify += [
                F.count(F.when(c < F.lit(low), 1)).alias(f"below{i}"),
                F.count(F.when((c >= F.lit(low)) & (c <= F.lit(high)), 1)).alias(f"inside{i}"),
                F.approx_count_distinct(F.when((c >= F.lit(low)) & (c <= F.lit(high)), c)).alias(f"values{i}"),
            ]
        third = numbers.agg(*verify).first()
        narrow: list[tuple[tuple[str, int], float, float, int]] = []
        for i, key in enumerate(keys):
            low, high = second[f"p{i}"]
            below, inside = third[f"below{i}"], third[f"inside{i}"]
            if not below <= key[1] < below + inside:
                # The sketch missed: keep the certain side of the bracket only.
                low, high = first[f"min{i}"], first[f"max{i}"]
                if key[1] < below:
                    high = second[f"p{i}"][0]
                else:
                    low = second[f"p{i}"][1]
                open_ranks[key] = (low, high)
                continue
            if low == high:
                found[key] = low
                del open_ranks[key]
            elif third[f"values{i}"] <= small_rows // max(len(keys), 1):
                narrow.append((key, low, high, below))
                del open_ranks[key]
            else:
                open_ranks[key] = (low, high)
        if narrow:
            # All brackets in one scan; together they hold at most about small_rows distinct values.
            inside = [
                F.when(F.col(key[0]).between(low, high), F.struct(F.lit(i).alias("i"), F.col(key[0]).alias("v")))
                for i, (key, low, high, _) in enumerate(narrow)
            ]
            unfolded = numbers.select(F.explode(F.array_compact(F.array(*inside))).alias("e")).select("e.i", "e.v")
            counts = unfolded.groupBy("i", "v").count().toPandas().sort_values(["i", "v"])
            for i, (key, _, _, below) in enumerate(narrow):
                part = counts[counts["i"] == i]
                found[key] = float(part["v"][below + part["count"].cumsum() > key[1]].iloc[0])
    return found


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5]).items()}


# --- hash order --------------------------------------------------------------

def hex_digits_for(rows: int, bucket_rows: int) -> int:
    if rows <= bucket_rows:
        return 1
    return min(MAX_HEX, max(1, math.ceil(math.log(rows / bucket_rows, 16))))


def with_hash(df: DataFrame, id_col: str, seed=SEED, out: str = "__hash") -> DataFrame:
    return df.withColumn(out, hash_hex(seed, F.col(id_col)))


def class_counts(df: DataFrame, class_col: str) -> dict:
    """Rows per class; a column with more than MAX_CLASSES values is refused before it reaches the driver."""
    rows = df.groupBy(class_col).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{class_col} has more than {MAX_CLASSES} values and is no class column")
    return {r[class_col]: r["n"] for r in rows}


def hash_cutoffs(df: DataFrame, class_col: str, id_col: str, ranks: dict, seed=SEED,
                 bucket_rows: int = BUCKET_ROWS, rows: int | None = None) -> dict:
    """Hash key of the rows at given 1-based ranks of each class in hash order.

    ``ranks``: class -> list of ranks. Two small jobs: counts per leading hash digits,
    then a ranking inside the few buckets that hold a wanted rank. With the keys known,
    any split by rank is a plain per-row comparison.
    """
    ranks = {c: sorted({r for r in rs if r > 0}) for c, rs in ranks.items()}
    if not any(ranks.values()):
        return {}
    keyed = with_hash(df.select(id_col, class_col), id_col, seed)
    digits = hex_digits_for(df.count() if rows is None else rows, bucket_rows)
    bucket = F.substring("__hash", 1, digits)
    # At most 16^MAX_HEX buckets per class; NULL is a class like any other.
    counts: dict = {}
    for r in keyed.groupBy(F.col(class_col).alias("c"), bucket.alias("b")).agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["c"], []).append((r["b"], r["n"]))
    wanted = []
    for label, buckets in counts.items():
        before, open_ranks = 0, list(ranks.get(label, []))
        for name, n in sorted(buckets, key=lambda b: (b[0] is not None, b[0])):
            while open_ranks and open_ranks[0] <= before + n:
                rank = open_ranks.pop(0)
                wanted.append((label, name, rank, rank - before))
            before += n
    if not wanted:
        return {}
    spark = df.sparkSession
    label_type = df.schema[class_col].dataType.simpleString()
    schema = f"c {label_type}, b string, rank bigint, local_rank bigint"
    targets = spark.createDataFrame(wanted, schema)
    places = keyed.select(F.col(class_col).alias("c"), bucket.alias("b"), "__hash", F.col(id_col).alias("id"))
    targets = targets.select(F.col("c").alias("tc"), F.col("b").alias("tb"), "rank", F.col("local_rank").alias("tl"))
    same = F.col("c").eqNullSafe(F.col("tc")) & F.col("b").eqNullSafe(F.col("tb"))
    places = places.join(F.broadcast(targets.select("tc", "tb").distinct()), same, "left_semi")
    order = Window.partitionBy("c", "b").orderBy("__hash", "id")
    ranked = places.withColumn("local_rank", F.row_number().over(order).cast("bigint"))
    hit = same & (F.col("local_rank") == F.col("tl"))
    rows = ranked.join(F.broadcast(targets), hit).select("c", "rank", "__hash", "id").collect()
    return {(r["c"], r["rank"]): (r["__hash"], r["id"]) for r in rows}


def at_or_before(hash_col: Column, id_col: Column, key: tuple) -> Column:
    return (hash_col < F.lit(key[0])) | ((hash_col == F.lit(key[0])) & (id_col <= F.lit(key[1])))


def hash_rank(df: DataFrame, class_cols: list[str], id_col: str, out: str = "rank", seed=SEED,
              bucket_rows: int = BUCKET_ROWS, key: Column | None = None) -> DataFrame:
    """1-based rank of every row of its class in hash order.

    Sorting happens per (class, leading hash digits); offsets come from the bucket
    counts, so one large class spreads over many tasks. Hashes are made again where the rows are
    sorted, as they compress badly on the way. ``key`` is hashed in place of the id.
    """
    digits = hex_digits_for(df.count(), bucket_rows)
    key = F.col(id_col) if key is None else key
    keyed = df.withColumn("__bucket", F.substring(hash_hex(seed, key), 1, digits))
    before = Window.partitionBy(*class_cols).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*class_cols, "__bucket").agg(F.count("*").alias("n"))
        .select(*class_cols, "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    )
    local = Window.partitionBy(*class_cols, "__bucket").orderBy("__hash", key)
    met = keyed.repartition(*class_cols, "__bucket").withColumn("__hash", hash_hex(seed, key))
    ranked = met.withColumn("__local", F.row_number().over(local))
    return (
        ranked.join(offsets, [*class_cols, "__bucket"])
        .withColumn(out, (F.col("__before") + F.col("__local")).cast("bigint"))
        .drop("__hash", "__bucket", "__before", "__local")
    )


# --- value order -------------------------------------------------------------

def running_sums(df: DataFrame, keys: list[str], order: list[Column | str], sums: dict[str, str],
                 small_rows: int = SMALL_ROWS, partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` (source -> output) per key in value order.

    Input rows must be distinct in (keys, order). A small input is one window per key;
    a large one is range-partitioned, pinned on shared storage, summed per partition
    and completed by partition offsets.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rows = df.count()
    if rows <= small_rows:
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        w = w.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(o) for c, o in sums.items()])

    parts = partitions or max(2, math.ceil(rows / BUCKET_ROWS))
    ranged = df.repartitionByRange(parts, *[F.col(k) for k in keys], *order_cols)
    pinned = cut_lineage(ranged.withColumn("__part", F.spark_partition_id()))
    base = keys or []
    before = (Window.partitionBy(*base) if base else Window.partitionBy(F.lit(0)))
    before = before.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = pinned.groupBy(*base, "__part").agg(*[F.sum(c).alias(f"__t_{o}") for c, o in sums.items()])
    offsets = totals.select(
        *base, "__part",
        *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__o_{o}") for o in sums.values()],
    )
    local = Window.partitionBy(*base, "__part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    inner = pinned.select("*", *[F.sum(c).over(local).alias(f"__l_{o}") for c, o in sums.items()])
    joined = inner.join(offsets, [*base, "__part"])
    return joined.select(
        *df.columns, *[(F.col(f"__o_{o}") + F.col(f"__l_{o}")).alias(o) for o in sums.values()]
    )


def dense_index(df: DataFrame, out: str = "event_id") -> DataFrame:
    """0..n-1 in scan order: per-partition positions plus the counts of earlier partitions.

    ``df`` must be a deterministic scan or projection, so both passes see the same partitions.
    """
    tagged = df.withColumn("__mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__part", F.shiftright("__mid", 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit(2**33 - 1))
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per scan partition.
    offsets = tagged.groupBy("__part").agg(F.count("*").alias("n")).select(
        "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    return (
        tagged.join(F.broadcast(offsets), "__part")
        .withColumn(out, (F.col("__before") + F.col("__pos")).cast("bigint"))
        .drop("__mid", "__part", "__pos", "__before")
    )
