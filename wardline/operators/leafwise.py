"""Leaf-wise gradient boosting with histograms: one multiclass model, softmax gradients.

Rows are kept as bin numbers. A job adds up the gradient histograms of all open nodes of all
classes' trees inside the tasks and over them. The driver splits the leaf of the highest gain
first, as long as it knows the gains below; then one more job opens every leaf that may still be
split. So jobs grow with the depth of a tree, never with its leaves. Of two siblings only the
smaller is counted, the other is the parent less it.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.functions import arrays
from wardline.operators.trees import PART, part_row, tree_sum
from wardline.session import cut_lineage
from wardline.sources.state import load_meta, save_meta

#: Bins of a feature, cells (node x feature x bin) of one job, rounds after which scores are stored.
BINS, MOST_CELLS, REFRESH = 255, 1 << 20, 2
#: Curvature that a side of a split needs at least.
LEAST_CURVATURE = 1e-3

_ROWS = "y int, w double, b binary, s binary, r long"


@dataclass
class Node:
    """A node while its tree grows; totals are gradient, curvature and rows."""

    total: np.ndarray
    depth: int
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    left_total: np.ndarray | None = None
    children: tuple[int, int] | None = None
    histogram: np.ndarray | None = None


@dataclass
class Tree:
    """Arrays over nodes; ``feature`` -1 marks a leaf. Rows with bin <= ``bin`` (x <= ``cut``) go left."""

    feature: list[int]
    bin: list[int]
    cut: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    cover: list[float]

    def leaf_of(self, column, n: int, by_bin: bool) -> np.ndarray:
        """Leaf of each row; ``column(rows, features)`` gives their bins or values."""
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        edge = np.array(self.bin if by_bin else self.cut)
        at, todo = np.zeros(n, np.int64), np.arange(n)
        while len(todo):
            todo = todo[feature[at[todo]] >= 0]
            own = at[todo]
            at[todo] = np.where(column(todo, feature[own]) <= edge[own], left[own], right[own])
        return at


def _cells(column: pa.Array, kind: type, n: int) -> np.ndarray:
    """Rows of equally long binary values as a matrix."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind).reshape(n, -1)


def _softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _drawn(r: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Rows of a round's sample, the same in every job of it."""
    with np.errstate(over="ignore"):
        h = (r.astype(np.uint64) + np.uint64(number * 1_000_003 + seed)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def best_splits(cells: np.ndarray, total: np.ndarray, allowed: np.ndarray, min_rows: int) -> tuple[float, int, int, np.ndarray | None]:
    """(gain, feature, bin, totals of the left side) of the best split of one node.

    ``cells``: feature x bin x (gradient, curvature, rows). Ties go to the first feature and bin.
    """
    left = np.cumsum(cells, axis=1)[:, :-1]
    right = total - left
    fine = (left[..., 2] >= min_rows) & (right[..., 2] >= min_rows) & (left[..., 1] >= LEAST_CURVATURE) & (
        right[..., 1] >= LEAST_CURVATURE) & allowed[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1] - total[0] ** 2 / total[1]
    gain = np.where(fine, gain, -np.inf)
    if not gain.size:
        return 0.0, -1, -1, None
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, b]), int(f), int(b), left[f, b]) if gain[f, b] > 1e-12 else (0.0, -1, -1, None)


@dataclass
class Leafwise:
    """The boosted model: bin edges, first scores, and for each round a tree per class."""

    k: int
    rounds: int = 300
    max_depth: int = 10
    num_leaves: int = 63
    step: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    min_rows: int = 20
    seed: int = 42
    edges: list[list[float]] = field(default_factory=list)
    start: list[float] = field(default_factory=list)
    trees: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # before each round

    # --- training ---------------------------------------------------------------------

    def fit(self, df: DataFrame, label_col: str, weight_col: str | None = None) -> "Leafwise":
        """Rows without a label or features are left out. An empty table gives a model without trees."""
        weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
        rows = df.select(F.col(label_col).cast("int").alias("y"), weight.alias("w"), vector_to_array("features").alias("x")).dropna()
        shares = [F.sum(F.when(F.col("y") == c, F.col("w"))).alias(f"c{c}") for c in range(self.k)]
        first = rows.agg(*shares, F.max(F.size("x")).alias("d")).first()
        prior = np.array([first[f"c{c}"] or 0.0 for c in range(self.k)])
        if not prior.sum():
            self.start = [0.0] * self.k
            return self
        self.start = np.log(np.maximum(prior / prior.sum(), 1e-9)).tolist()
        self._edges(rows, first["d"])
        table, pending = self._binned(rows), 0
        for number in range(self.rounds):
            grown = self._round(table, number, pending)
            self.trees.append(grown)
            pending += 1
            if pending == REFRESH and number + 1 < self.rounds:
                table, pending = self._scored(table, pending), 0
        return self

    def _edges(self, rows: DataFrame, d: int) -> None:
        """Cuts between bins: order statistics of each feature from mergeable sketches."""
        shares = [F.lit(i / BINS) for i in range(1, BINS)]
        found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
            F.array_distinct(F.percentile_approx("v", F.array(*shares), F.lit(20 * BINS))).alias("e"), F.max("v").alias("top")).collect()
        self.edges = [[] for _ in range(d)]
        for r in found:
            self.edges[r["i"]] = sorted(e for e in r["e"] if e < r["top"])

    def _binned(self, rows: DataFrame) -> DataFrame:
        edges, k, start = [np.array(e) for e in self.edges], self.k, np.array(self.start)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                x = pa.concat_arrays([batch.column(2)]).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1).astype(np.uint8)
                score = np.tile(start, (n, 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), pa.array([row.tobytes() for row in bins], pa.binary()),
                    pa.array([row.tobytes() for row in score], pa.binary()), batch.column(3)], names=["y", "w", "b", "s", "r"])

        return cut_lineage(rows.withColumn("r", F.monotonically_increasing_id()).mapInArrow(run, _ROWS))

    def _read(self, batch: pa.RecordBatch, pending: list[list[Tree]]) -> tuple[np.ndarray, np.ndarray]:
        """(bins, scores) of the rows, with the trees that are not in the stored scores yet."""
        n = batch.num_rows
        bins, score = _cells(batch.column(2), np.uint8, n), _cells(batch.column(3), np.float64, n).copy()
        for trees in pending:
            for c, tree in enumerate(trees):
                score[:, c] += np.array(tree.value)[tree.leaf_of(lambda rows, f: bins[rows, f], n, True)]
        return bins, score

    def _scored(self, table: DataFrame, pending: int) -> DataFrame:
        shared = table.sparkSession.sparkContext.broadcast((self, self.trees[-pending:]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, trees = shared.value
            for batch in batches:
                if batch.num_rows:
                    _, score = model._read(batch, trees)
                    yield batch.set_column(3, "s", pa.array([row.tobytes() for row in score], pa.binary()))

        return cut_lineage(table.mapInArrow(run, _ROWS))

    def _histograms(self, table: DataFrame, number: int, pending: int, grown: list[list[Node]], asked: list[tuple[int, int]],
                    low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(asked node x feature x bin x 3 for the features from low to high, (loss, weight))."""
        routes = [_route(nodes) for nodes in grown]
        slim = Leafwise(self.k, subsample=self.subsample, seed=self.seed)
        shared = table.sparkSession.sparkContext.broadcast((slim, self.trees[len(self.trees) - pending:], routes))
        shape = (len(asked), high - low, BINS + 1, 3)
        size = int(np.prod(shape))
        by_class: dict[int, list[int]] = {}
        for i, (c, _) in enumerate(asked):
            by_class.setdefault(c, []).append(i)
        slots = {}
        for c, own in by_class.items():
            slots[c] = np.full(len(grown[c]), -1)
            slots[c][[asked[i][1] for i in own]] = np.arange(len(own))
        scale = self.k / max(self.k - 1, 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, trees, ways = shared.value
            total, loss = np.zeros(shape), np.zeros(2)
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                bins, score = model._read(batch, trees)
                y, w = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                p = _softmax(score)
                loss += [-(w * np.log(np.maximum(p[np.arange(n), y], 1e-15))).sum(), w.sum()]
                used = _drawn(batch.column(4).to_numpy(), number, model.seed, model.subsample)
                # all nodes of a class's tree in one count, a node's cells side by side
                for c, own in by_class.items():
                    place = slots[c][ways[c].leaf_of(lambda rows, f: bins[rows, f], n, True)]
                    rows = np.flatnonzero(used & (place >= 0))
                    g = w[rows] * (p[rows, c] - (y[rows] == c))
                    h = w[rows] * p[rows, c] * (1 - p[rows, c]) * scale
                    base = place[rows] * (BINS + 1)
                    for f in range(low, high):
                        at = base + bins[rows, f]
                        for m, v in enumerate((g, h, None)):
                            total[own, f - low, :, m] += np.bincount(at, v, len(own) * (BINS + 1)).reshape(len(own), BINS + 1)
            yield part_row(TaskContext.get().partitionId(), np.concatenate([total.reshape(-1), loss]))

        # a stored table: its number of parts is known without running anything
        found = tree_sum(table.mapInArrow(run, PART), size + 2, tasks=table.rdd.getNumPartitions())
        shared.unpersist()
        return found[:-2].reshape(shape), found[-2:]

    def _open(self, table: DataFrame, number: int, pending: int, grown: list[list[Node]], asked: list[tuple[int, int]],
              allowed: np.ndarray) -> np.ndarray:
        """Totals and best splits of the nodes asked for; roots first, else pairs of siblings."""
        d = len(self.edges)
        block = max(1, MOST_CELLS // (max(len(asked), 1) * (BINS + 1) * 3))
        whole = block >= d  # all features in one job: larger siblings by subtraction
        parents = {child: (c, v) for c, nodes in enumerate(grown) for v, node in enumerate(nodes) if node.children for child in
                   [(c, node.children[0]), (c, node.children[1])]}
        counted = asked
        if whole and asked and asked[0] in parents and grown[parents[asked[0]][0]][parents[asked[0]][1]].histogram is not None:
            counted = [min(pair, key=lambda x: grown[x[0]][x[1]].total[2]) for pair in zip(asked[::2], asked[1::2])]
        loss = np.zeros(2)
        for low in range(0, d, block):
            high = min(low + block, d)
            cells, loss = self._histograms(table, number, pending, grown, counted, low, high)
            by_node = dict(zip(counted, cells))
            for c, v in asked:
                node = grown[c][v]
                if (c, v) in by_node:
                    own = by_node[c, v]
                else:
                    pc, pv = parents[c, v]
                    a, b = grown[pc][pv].children
                    own = grown[pc][pv].histogram - by_node[c, a if v == b else b]
                if whole:
                    node.histogram = own
                if not node.depth and not low:
                    node.total = own[0].sum(axis=0)
                gain, f, b, left = best_splits(own, node.total, allowed[low:high], self.min_rows)
                if node.depth < self.max_depth and gain > node.gain:
                    node.gain, node.feature, node.bin, node.left_total = gain, low + f, b, left
        for c, v in asked:
            if (c, v) in parents:  # the parent's cells served both children
                grown[c][parents[c, v][1]].histogram = None
        return loss

    def _round(self, table: DataFrame, number: int, pending: int) -> list[Tree]:
        draw = np.random.default_rng([self.seed, number])
        d = len(self.edges)
        allowed = np.zeros(d, bool)
        allowed[draw.permutation(d)[:max(1, round(self.columns * d))]] = True
        grown = [[Node(np.zeros(3), 0)] for _ in range(self.k)]
        loss = self._open(table, number, pending, grown, [(c, 0) for c in range(self.k)], allowed)
        self.losses.append(float(loss[0] / loss[1]))
        while True:
            asked = []
            for c, nodes in enumerate(grown):
                chosen, waiting = grow(nodes, self.num_leaves)
                for v in waiting[:self.num_leaves - 1 - len(chosen)]:
                    node = nodes[v]
                    node.children = (len(nodes), len(nodes) + 1)
                    nodes += [Node(node.left_total, node.depth + 1), Node(node.total - node.left_total, node.depth + 1)]
                    asked += [(c, node.children[0]), (c, node.children[1])]
            if not asked:
                break
            self._open(table, number, pending, grown, asked, allowed)
        return [self._tree(nodes) for nodes in grown]

    def _tree(self, nodes: list[Node]) -> Tree:
        chosen, _ = grow(nodes, self.num_leaves)
        tree, todo = Tree([], [], [], [], [], [], []), [(0, -1, False)]
        while todo:
            v, parent, is_right = todo.pop()
            node, at = nodes[v], len(tree.feature)
            if parent >= 0:
                (tree.right if is_right else tree.left)[parent] = at
            split = v in chosen
            edges = self.edges[node.feature] if split else []
            tree.feature.append(node.feature if split else -1)
            tree.bin.append(node.bin if split else -1)
            tree.cut.append(float(edges[node.bin]) if split else 0.0)
            tree.left.append(-1)
            tree.right.append(-1)
            tree.value.append(0.0 if split or node.total[1] <= 0 else float(-self.step * node.total[0] / node.total[1]))
            tree.cover.append(float(node.total[2]))
            if split:
                todo += [(node.children[1], at, True), (node.children[0], at, False)]
        return tree

    # --- use --------------------------------------------------------------------------

    def predict(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((np.array(self.start), self.trees))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            start, rounds = shared.value
            for batch in batches:
                n = len(batch)
                x = np.stack(batch.to_numpy()).astype(float) if n else np.zeros((0, 1))
                score = np.tile(start, (n, 1))
                for trees in rounds:
                    for c, tree in enumerate(trees):
                        score[:, c] += np.array(tree.value)[tree.leaf_of(lambda rows, f: x[rows, f], n, False)]
                yield pd.Series(list(_softmax(score)) if n else [], dtype=object)

        out = df.withColumn("probability", probability(vector_to_array("features")))
        return out.withColumn("pred", arrays.argmax(F.col("probability")))

    def leaves(self, class_index: int) -> list[dict]:
        """Every leaf of one class: value, and per feature its interval and the share of rows that take it."""
        out = [{"value": self.start[class_index], "path": {}}]
        for trees in self.trees:
            tree = trees[class_index]
            todo = [(0, {})]
            while todo:
                v, path = todo.pop()
                f = tree.feature[v]
                if f < 0:
                    out.append({"value": tree.value[v], "path": path})
                    continue
                low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
                for child, bounds in ((tree.left[v], (low, min(high, tree.cut[v]))), (tree.right[v], (max(low, tree.cut[v]), high))):
                    todo.append((child, {**path, f: (*bounds, share * tree.cover[child] / max(tree.cover[v], 1e-12))}))
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {**self.__dict__, "trees": [[t.__dict__ for t in trees] for trees in self.trees]}
        save_meta(spark, path, json.loads(json.dumps(meta)))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Leafwise":
        meta = load_meta(spark, path)
        return cls(**{**meta, "trees": [[Tree(**t) for t in trees] for trees in meta["trees"]]})


def grow(nodes: list[Node], num_leaves: int) -> tuple[list[int], list[int]]:
    """(nodes split so far, highest gain first; leaves whose splits must be opened to go on).

    The second list is empty when the tree is done.
    """
    heap = [(-nodes[0].gain, 0)] if nodes[0].gain > 0 else []
    chosen: list[int] = []
    while heap and len(chosen) < num_leaves - 1:
        _, v = heapq.heappop(heap)
        if nodes[v].children is None:
            # whatever may still be split, also below nodes that wait for their turn: so that every job
            # opens a level everywhere and a tree takes about as many jobs as it is deep
            rest = [u for u, node in enumerate(nodes) if u != v and node.children is None and node.gain > 0]
            return chosen, [v, *sorted(rest, key=lambda u: (-nodes[u].gain, u))]
        chosen.append(v)
        for u in nodes[v].children:
            if nodes[u].gain > 0:
                heapq.heappush(heap, (-nodes[u].gain, u))
    return chosen, []


def _route(nodes: list[Node]) -> Tree:
    """The nodes as they stand, opened ones included; node numbers stay."""
    return Tree([n.feature if n.children else -1 for n in nodes], [n.bin for n in nodes], [], [n.children[0] if n.children else -1 for n in nodes],
                [n.children[1] if n.children else -1 for n in nodes], [], [])
