"""Exact nearest neighbours as a partitioned job.

Copies of one vector collapse to a single search row that carries its smallest ids, so a
vector repeated in a third of the table costs one search. The distinct vectors are cut
into cells around pivots; a row first searches its own block, and the distance found
there limits the other cells it has to visit (triangle inequality). Only the best
candidates of each visited block leave a task, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.hashing import SEED, hash_hex
from wardline.session import cut_lineage

DIGITS = 9
BLOCK_ROWS = 16_384
MAX_PIVOTS = 4096
#: Blocks that are enough: beyond them a block grows, up to WIDEST times, so that a vector is not sent to ever more of them.
ENOUGH_BLOCKS, WIDEST = 16, 8
#: Rows of a tile of distances on either side (what stays in a core's cache), candidates of a row, as multiples of k,
#: that are compared without a cut, and pairs whose exact distances are made at a time.
TILE, FEW, PAIRS = 512, 8, 1 << 16


class _Rough:
    """Distances to fixed rows by one matrix product, in single precision where the numbers allow.

    ``slack`` bounds how far a rough squared distance is off the rounded exact one, so nothing near is lost.
    """

    def __init__(self, queries: np.ndarray, data: np.ndarray):
        self.centre = data.mean(axis=0)
        with np.errstate(over="ignore", invalid="ignore"):
            near, far = queries - self.centre, data - self.centre
            self.norms, norms = np.einsum("ij,ij->i", near, near), np.einsum("ij,ij->i", far, far)
            reach = np.sqrt(self.norms) + np.sqrt(norms.max())
            moved = np.finfo(float).eps * max(np.abs(data).max(), np.abs(queries).max()) * math.sqrt(data.shape[1])
        self.type = np.float32 if reach.max() < 1e15 else np.float64
        self.slack = 4.0 * 10.0**-DIGITS + (data.shape[1] + 8) * np.finfo(self.type).eps * reach**2 + 4 * moved * (reach + moved)
        self.near = np.hstack([near, np.ones((len(near), 1))]).astype(self.type)
        self.far = np.hstack([-2.0 * far, norms[:, None]]).astype(self.type)

    def within(self, rows: slice, cols: slice, cut: np.ndarray, room: dict) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances without the squared length of the query, and where they are at most ``cut``.

        Both are overwritten by the next tile, as fresh memory would cost more than the product.
        """
        near, far = self.near[rows], self.far[cols]
        shape = (len(near), len(far))
        if shape not in room:
            room[shape] = np.empty(shape, self.type), np.empty(shape, bool)
        made, inside = room[shape]
        np.matmul(near, far.T, out=made)
        # rounded up, so that the conversion loses nothing
        limit = np.nextafter((cut - self.norms[rows]).astype(self.type), self.type(np.inf))
        return made, np.less_equal(made, limit[:, None], out=inside)


def _places(inside: np.ndarray) -> np.ndarray:
    """Flat places of the few true cells, looked for eight at a time."""
    if inside.size % 8:
        return np.flatnonzero(inside)
    words = np.flatnonzero(inside.reshape(-1).view(np.uint64))
    word, bit = np.nonzero(inside.reshape(-1, 8)[words])
    return words[word] * 8 + bit


def _keep_least(dists: np.ndarray, best: np.ndarray, of: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
    """Merges (query, distance, id) candidates into the sorted k best of each query, in place."""
    k = dists.shape[1]
    rows, place = np.unique(of, return_inverse=True)
    every = np.concatenate([np.repeat(np.arange(len(rows)), k), place])
    d = np.concatenate([dists[rows].ravel(), found])
    i = np.concatenate([best[rows].ravel(), ids])
    order = np.lexsort((i, d, every))
    starts = np.searchsorted(every[order], np.arange(len(rows)))
    kept = order[starts[:, None] + np.arange(k)]
    dists[rows], best[rows] = d[kept], i[kept]


def _least(queries: np.ndarray, data: np.ndarray, ids: list, k: int, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k smallest (rounded squared distance, id) over the data rows and their copies.

    Two tables of k columns, where fewer are found filled up by an infinite distance. What is farther than
    ``bound`` may be left out. Rough distances are made tile by tile; only what can be among the best so
    far gets its exact distance.
    """
    rough = _Rough(queries, data)
    copies = np.array([len(own) for own in ids])
    starts = np.concatenate([[0], np.cumsum(copies)])
    flat = np.concatenate([np.asarray(own, dtype=np.int64) for own in ids])
    bound = np.full(len(queries), np.inf) if bound is None else bound
    room: dict = {}
    all_dists, all_best = np.full((len(queries), k), np.inf), np.full((len(queries), k), np.iinfo(np.int64).max)
    for start in range(0, len(queries), TILE):
        rows = slice(start, start + TILE)
        part, slack = queries[rows], rough.slack[rows]
        dists, best = all_dists[rows], all_best[rows]
        for at in range(0, len(data), TILE):
            made, inside = rough.within(rows, slice(at, at + TILE), np.minimum(bound[rows], dists[:, -1]) + slack, room)
            of, near = np.divmod(_places(inside), made.shape[1])
            many = np.flatnonzero(np.bincount(of, minlength=len(part)) > FEW * k)
            if len(many):
                nth = min(k, made.shape[1]) - 1
                least = np.partition(made[many], nth, axis=1)[:, nth] + 2 * slack[many]
                inside[many] &= made[many] <= least[:, None]
                of, near = np.divmod(_places(inside), made.shape[1])
            near += at
            for p in range(0, len(of), PAIRS):
                q, x = of[p:p + PAIRS], near[p:p + PAIRS]
                exact = np.round(((data[x] - part[q]) ** 2).sum(axis=1), DIGITS)
                wanted = exact <= dists[q, -1]
                q, x, exact = q[wanted], x[wanted], exact[wanted]
                if not len(q):
                    continue
                n = copies[x]
                each = np.repeat(starts[x] - np.cumsum(n) + n, n) + np.arange(n.sum())
                _keep_least(dists, best, np.repeat(q, n), np.repeat(exact, n), flat[each])
    return all_dists, all_best


def _best(queries: np.ndarray, data: np.ndarray, ids: list, k: int, bound: np.ndarray | None = None) -> list[tuple[list[float], list[int]]]:
    """``_least`` as lists, as long as what is found."""
    dists, best = _least(queries, data, ids, k, bound)
    full = np.count_nonzero(dists < np.inf, axis=1).tolist()
    return [(d[:n], i[:n]) for d, i, n in zip(dists.tolist(), best.tolist(), full)]


def _frame(block: pd.DataFrame, found) -> pd.DataFrame:
    return pd.DataFrame({
        "c": block["c"].to_numpy(), "vid": block["vid"].to_numpy(),
        "dists": pd.Series([d for d, _ in found], dtype=object), "ids": pd.Series([i for _, i in found], dtype=object),
    })


def _distinct_vectors(df: DataFrame, id_col: str, vec_col: str, class_col: str | None, k: int) -> DataFrame:
    """(c, vec, vid, copies): the k + 1 smallest ids of each distinct vector.

    The rank filter is applied before the shuffle too, so copies do not meet in one task.
    """
    label = F.col(class_col).cast("int") if class_col else F.lit(0)
    rows = df.select(label.alias("c"), F.col(vec_col).cast("array<double>").alias("vec"), F.col(id_col).cast("bigint").alias("id"))
    order = Window.partitionBy("c", "vec").orderBy("id")
    first = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    return first.groupBy("c", "vec").agg(F.sort_array(F.collect_list("id")).alias("copies")).select(
        "c", "vec", F.col("copies")[0].alias("vid"), "copies"
    )


def _to_cells(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""

    def assign(batches):
        for batch in batches:
            x = np.stack(batch["vec"].to_numpy()).astype(float)
            gaps = np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T, 0)
            cell = gaps.argmin(axis=1)
            reach = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield batch.assign(cell=cell.astype("int32"), reach=reach)

    return vectors.mapInPandas(assign, "c int, vec array<double>, vid bigint, copies array<bigint>, cell int, reach double")


def _block_size(total: int, least: int) -> int:
    """Rows of a block: ``least`` until there are ENOUGH_BLOCKS, then more, within the memory of a task."""
    return min(max(least, math.ceil(total / ENOUGH_BLOCKS)), WIDEST * least)


def knn(df: DataFrame, id_col: str, vec_col: str, k: int, class_col: str | None = None,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, neighbor, rank, dist2): the k nearest other rows, of the same class if ``class_col`` is given.

    Order is (squared distance rounded to 9 digits, id).
    """
    vectors = cut_lineage(_distinct_vectors(df, id_col, vec_col, class_col, k))
    total = vectors.count()
    block_rows = _block_size(total, block_rows)
    n_cells = min(MAX_PIVOTS, max(1, math.ceil(total / block_rows)))
    pivots = None
    if n_cells == 1:
        cells = vectors.withColumns({"cell": F.lit(0), "reach": F.lit(0.0)})
    else:
        pivot_rows = vectors.orderBy(hash_hex(SEED, F.col("vid")), "vid", "c").limit(n_cells).select("vec").collect()
        pivots = np.array([r["vec"] for r in pivot_rows], dtype=float)
        cells = cut_lineage(_to_cells(vectors, pivots))
    # At most pivots x classes rows.
    stats = {
        (r["c"], r["cell"]): (r["n"], r["radius"])
        for r in cells.groupBy("c", "cell").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect()
    }
    subs = {key: max(1, math.ceil(n / block_rows)) for key, (n, _) in stats.items()}
    spark = df.sparkSession
    sub_table = spark.createDataFrame([(c, cell, n) for (c, cell), n in subs.items()], "c int, cell int, subs int")
    blocks = (
        cells.join(F.broadcast(sub_table), ["c", "cell"])
        .withColumn("sub", F.pmod(F.xxhash64("vid"), F.col("subs")).cast("int"))
        .select("c", "cell", "sub", "vid", "vec", "copies")
    )

    found_schema = "c int, vid bigint, dists array<double>, ids array<bigint>"

    def search_own(block: pd.DataFrame) -> pd.DataFrame:
        data = np.stack(block["vec"].to_numpy()).astype(float)
        found = _best(data, data, block["copies"].tolist(), k + 1)
        return _frame(block, found)

    own = blocks.groupBy("c", "cell", "sub").applyInPandas(search_own, found_schema)
    candidates = own
    per_class: dict[int, int] = {}
    for (c, _), n in subs.items():
        per_class[c] = per_class.get(c, 0) + n
    if max(per_class.values(), default=1) > 1:
        own = cut_lineage(own)
        candidates = own.unionByName(_search_others(blocks, own, pivots, stats, subs, k, block_rows, found_schema))

    merged = (
        candidates.select("c", "vid", F.arrays_zip("dists", "ids").alias("found"))
        .groupBy("c", "vid").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))
    )
    lists = vectors.select("c", "vec", "vid").join(merged, ["c", "vid"]).select("c", "vec", "found")
    label = F.col(class_col).cast("int") if class_col else F.lit(0)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), label.alias("c"), F.col(vec_col).cast("array<double>").alias("vec"))
    others = F.slice(F.filter("found", lambda p: p["ids"] != F.col("id")), 1, k)
    return (
        rows.join(lists, ["c", "vec"])
        .select("id", F.posexplode(others).alias("pos", "p"))
        .select("id", F.col("p.ids").alias("neighbor"), (F.col("pos") + 1).alias("rank"), F.col("p.dists").alias("dist2"))
    )


def _search_others(blocks: DataFrame, own: DataFrame, pivots, stats, subs, k: int, block_rows: int, schema: str) -> DataFrame:
    """Candidates from every block that can still hold a nearer row than the own block did."""
    by_class: dict[int, list[tuple[int, float, int]]] = {}
    for (c, cell), (_, radius) in stats.items():
        by_class.setdefault(c, []).append((cell, radius, subs[c, cell]))
    visit_schema = "c int, cell int, sub int, vid bigint, vec array<double>, bound double"

    def visited(batches):
        """(c, cell, sub, the rows that ask this block)."""
        for batch in batches:
            x = np.stack(batch["vec"].to_numpy()).astype(float)
            if pivots is None:
                gaps = np.zeros((len(x), 1))
            else:
                gaps = np.sqrt(np.maximum((x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T, 0))
            bound = np.array([d[k] if len(d) > k else np.inf for d in batch["dists"]])
            reach = np.sqrt(bound + 4.0 * 10.0**-DIGITS) + 1e-6
            batch = batch.assign(bound=bound)
            for c, part in batch.groupby("c"):
                at = part.index.to_numpy() - batch.index[0]
                for cell, radius, n_subs in by_class[c]:
                    inside = gaps[at, cell] - radius <= reach[at]
                    if not inside.any():
                        continue
                    hit = part[inside]
                    for sub in range(n_subs):
                        other = hit[(hit["cell"] != cell) | (hit["sub"] != sub)]
                        if other.empty:
                            continue
                        yield np.int32(c), np.int32(cell), np.int32(sub), other

    def visits(batches):
        for c, cell, sub, rows in visited(batches):
            yield rows[["vid", "vec", "bound"]].assign(c=c, cell=cell, sub=sub)[["c", "cell", "sub", "vid", "vec", "bound"]]

    def counted(batches):
        for c, cell, sub, rows in visited(batches):
            yield pd.DataFrame({"c": [c], "cell": [cell], "sub": [sub], "n": [len(rows)]})

    asking = blocks.join(own.select("c", "vid", "dists"), ["c", "vid"]).select("c", "cell", "sub", "vid", "vec", "dists")
    asked = asking.mapInPandas(visits, visit_schema)
    # A block asked by very many rows is repeated for groups of askers of bounded size.
    loads = asking.mapInPandas(counted, "c int, cell int, sub int, n long").groupBy("c", "cell", "sub").agg(
        F.ceil(F.sum("n") / block_rows).cast("int").alias("groups"))
    queries = asked.join(loads, ["c", "cell", "sub"]).withColumn("g", F.pmod(F.xxhash64("vid"), F.col("groups")).cast("int"))
    data = blocks.join(loads, ["c", "cell", "sub"]).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))

    def search(asking_rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if asking_rows.empty or block.empty:
            return _frame(asking_rows.head(0), [])
        x = np.stack(block["vec"].to_numpy()).astype(float)
        q = np.stack(asking_rows["vec"].to_numpy()).astype(float)
        found = _best(q, x, block["copies"].tolist(), k + 1, asking_rows["bound"].to_numpy())
        nearer = [i for i, (d, _) in enumerate(found) if d]
        return _frame(asking_rows.iloc[nearer], [found[i] for i in nearer])

    keys = ["c", "cell", "sub", "g"]
    # New column identities: both sides come from the same blocks.
    queries = queries.select(*[F.col(n).alias(n) for n in [*keys, "vid", "vec", "bound"]])
    data = data.select(*[F.col(n).alias(n) for n in [*keys, "vid", "vec", "copies"]])
    return queries.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(search, schema)
