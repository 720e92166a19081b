"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

Each source is cut into blocks of equally many rows. A fluid mix would give every source its
exact weight of each slot; of a source without blocks the others share the weight. Block j of a
source is released in the slot in which its fluid part starts and due when that part ends; the
earliest deadline is served first. All arithmetic is in whole numbers, so nothing adds up.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardline.llm.base import pick, stored
from wardline.session import scratch_path

#: Slots of a period, rows ranked together, and sources or slots written at a time.
PERIOD, BUCKET_ROWS, CHUNK = 1024, 1024, 1 << 20


def shares_of(weights: dict, period: int = PERIOD) -> dict:
    """Whole shares of the period by largest remainder, at least one each."""
    total = sum(weights.values())
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    shares = {s: 1 + int(x) for s, x in exact.items()}
    left = period - sum(shares.values())
    for s in sorted(weights, key=lambda s: (int(exact[s]) - exact[s], s))[:left]:
        shares[s] += 1
    return shares


def schedule(blocks: dict, weights: dict) -> Iterator[tuple]:
    """(source, block) of each slot in turn; memory for the sources only, one heap step a slot.

    At every prefix a source has less than one block more or less than the fluid mix gives it:
    jobs released and due at whole slots around their fluid parts always fit, and serving the
    earliest deadline then keeps every deadline.
    """
    live = [s for s in blocks if blocks[s] > 0]
    exact = [max(Fraction(str(weights[s])), Fraction(1, 10**9)) for s in live]
    unit = lcm(*[w.denominator for w in exact])
    share, count = [int(w * unit) for w in exact], [blocks[s] for s in live]

    # per unit of virtual time a source gets its share; sources end in the order of count / share,
    # which whole numbers of this scale tell apart
    scale = 2 * max(share, default=0).bit_length()
    ends, given, rest = [], [0], [sum(share)]
    for end, q in sorted(((count[q] << scale) // share[q], q) for q in range(len(live))):
        ends.append(end)
        given.append(given[-1] + count[q])
        rest.append(rest[-1] - share[q])

    def fluid(q: int, j: int) -> tuple[int, int]:
        """Slot at which the fluid mix has given j blocks of the source, rounded down and up."""
        k = bisect_right(ends, (j << scale) // share[q])
        return given[k] + rest[k] * j // share[q], given[k] - (-rest[k] * j // share[q])

    waiting, due = [(0, q, 0) for q in range(len(live))], []
    for slot in range(sum(count)):
        while waiting and waiting[0][0] <= slot:
            _, q, j = heapq.heappop(waiting)
            heapq.heappush(due, (fluid(q, j + 1)[1], q, j))
        _, q, j = heapq.heappop(due)
        yield live[q], j
        if j + 1 < count[q]:
            heapq.heappush(waiting, (fluid(q, j + 1)[0], q, j + 1))


def one_period(shares: dict) -> dict:
    """Slots of each source in a period of whole shares."""
    slots: dict = {s: [] for s in shares}
    for t, (s, _) in enumerate(schedule(shares, shares)):
        slots[s].append(t)
    return slots


@dataclass
class Phase:
    """From slot ``start`` on, source s gives its blocks from ``first[s]`` to before ``last[s]``."""

    start: int
    first: dict
    last: dict


def plan(blocks: dict, weights: dict) -> list[Phase]:
    """Phases that place every block; ``blocks``: number of blocks of each source."""
    phases, done, start = [], dict.fromkeys(blocks, 0), 0
    first = dict(done)
    for t, (s, j) in enumerate(schedule(blocks, weights)):
        done[s] = j + 1
        if done[s] == blocks[s]:
            own = [x for x in blocks if first[x] < blocks[x]]
            phases.append(Phase(start, {x: first[x] for x in own}, {x: done[x] for x in own}))
            first, start = dict(done), t + 1
    return phases


def _stored_schedule(spark: SparkSession, blocks: dict, weights: dict) -> DataFrame:
    """Position and phase of each block, written slot by slot."""
    path, columns = scratch_path(spark, "schedule"), "_s int, _block long, _position long, _phase int"
    slots, position, phase = schedule(blocks, weights), 0, 0
    while (some := list(islice(slots, CHUNK))) or not position:
        phases = []
        for s, j in some:
            phases.append(phase)
            phase += j + 1 == blocks[s]
        part = pa.table({
            "_s": pa.array([s for s, _ in some], pa.int32()), "_block": pa.array([j for _, j in some], pa.int64()),
            "_position": pa.array(range(position, position + len(some)), pa.int64()), "_phase": pa.array(phases, pa.int32())})
        spark.createDataFrame(part, columns).write.mode("append").parquet(path)
        position += len(some)
        if not some:
            break
    return spark.read.schema(columns).parquet(path)


def mix_sources(docs: DataFrame, weights: dict | None = None, block_rows: int = 64, id_col: str = "doc_id",
                source_col: str = "source", seed: int = 11) -> DataFrame:
    """All rows and columns with ``block``, ``phase``, ``position`` and ``place`` of each row.

    Blocks are numbered by ``position`` in the mix, rows by ``place`` within their block: sorting
    by both gives the mixed order. Within a source rows are ordered by a seeded hash of their id.
    At every prefix of the mix each source has less than one block more or less than its exact
    weight says (a number counts as its shortest decimal form). No row is dropped: a source that
    runs out leaves its weight to the rest, and ``phase`` counts the sources that ran out before.

    ``weights``: target weight of each source, 1 where it is not named; by default all are equal. A
    weight that is no positive number raises.
    Every source is scheduled by its own weight; the driver holds a few numbers for each, and the
    tables of sources and slots are joined by their size. A null source is a source. Null ids are hashed like a value; rows alike in all
    columns may take each other's place. Columns named like a new one are replaced. An empty
    table stays empty.
    """
    weights = weights or {}
    wrong = {s: w for s, w in weights.items() if not 0 < w < float("inf")}
    if wrong:
        raise ValueError(f"target weights must be positive numbers: {wrong}")
    source = docs.columns.index(source_col)
    flat = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    counts = pick(docs, source_col).groupBy(source_col).count()
    spark, kind = docs.sparkSession, docs.schema[source].dataType
    blocks, weight, path = {}, {}, scratch_path(spark, "sources")
    columns = T.StructType([T.StructField("_source", kind), T.StructField("_queue", T.IntegerType()),
                            T.StructField("_buckets", T.LongType())])
    found = counts.orderBy(F.desc("count"), F.col(source_col)).toLocalIterator()
    while (some := list(islice(found, CHUNK))) or not blocks:
        own = []
        for r in some:
            q = len(blocks)
            blocks[q], weight[q] = -(-r["count"] // block_rows), weights.get(r[source_col], 1)
            own.append((r[source_col], q, -(-r["count"] // BUCKET_ROWS)))
        spark.createDataFrame(own, columns).coalesce(1).write.mode("append").parquet(path)
        if not some:
            break
    queues = spark.read.schema(columns).parquet(path)
    slots = _stored_schedule(spark, blocks, weight)

    key = F.xxhash64(F.lit(seed), flat[f"_c{docs.columns.index(id_col)}"])
    hashed = flat.join(queues, F.col(f"_c{source}").eqNullSafe(F.col("_source"))).withColumn(
        "_h", F.pmod(key, F.lit(1 << 31))).withColumn("_bucket", F.shiftright(F.col("_h") * F.col("_buckets"), 31))
    per_bucket = hashed.groupBy("_queue", "_bucket").count()
    before = F.sum("count").over(Window.partitionBy("_queue").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select("_queue", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"), "count").select(
        F.col("_queue").alias("_oq"), F.col("_bucket").alias("_ob"), "_before", F.explode(F.sequence(
            F.floor(F.col("_before") / block_rows), F.floor((F.col("_before") + F.col("count") - 1) / block_rows))).alias("_at"))
    # the slots of the blocks that a bucket touches travel with it: rows are moved once
    spots = stored(offsets.join(slots, (F.col("_oq") == F.col("_s")) & (F.col("_at") == F.col("_block"))).groupBy(
        "_oq", "_ob", "_before").agg(F.sort_array(F.collect_list(F.struct("_block", "_position", "_phase"))).alias("_slots")), "slots")
    order = Window.partitionBy("_queue", "_bucket").orderBy("_h", F.xxhash64(*flat.columns), *flat.columns)
    ranked = hashed.withColumn("_rank", F.row_number().over(order) - 1).join(
        spots, (F.col("_queue") == F.col("_oq")) & (F.col("_bucket") == F.col("_ob"))).withColumn(
        "_rank", F.col("_rank") + F.col("_before"))
    block = F.floor(F.col("_rank") / block_rows)
    placed = ranked.withColumn("block", block).withColumn("_slot", F.get(
        "_slots", (F.col("block") - F.floor(F.col("_before") / block_rows)).cast("int")))
    added: dict[str, Column] = {"block": F.col("block"), "phase": F.col("_slot._phase"), "position": F.col("_slot._position"),
                                "place": F.pmod("_rank", F.lit(block_rows)).cast("int")}
    kept, seen = [], set(added)
    for i, c in enumerate(docs.columns):
        if c.lower() not in seen:
            seen.add(c.lower())
            kept.append(F.col(f"_c{i}").alias(c))
    return placed.select(*kept, *[v.alias(k) for k, v in added.items()])
