"""Leaf-wise boosting: exact best-first trees, histograms in blocks, state."""

import heapq

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardline.operators import leafwise, models
from wardline.operators.leafwise import Leafwise


def plain_tree(bins, g, h, leaves, depth, least):
    """Leaves of the tree that always splits the leaf of the highest gain: sets of rows."""
    def best(rows):
        top = (1e-12, None)
        for f in range(bins.shape[1]):
            for b in range(leafwise.BINS):
                left = rows[bins[rows, f] <= b]
                right = rows[bins[rows, f] > b]
                if min(len(left), len(right)) < least or min(h[left].sum(), h[right].sum()) < leafwise.LEAST_CURVATURE:
                    continue
                gain = g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum() - g[rows].sum() ** 2 / h[rows].sum()
                if gain > top[0] + 1e-9:
                    top = (gain, (left, right))
        return top
    heap, done, n = [], [], 1
    def push(rows, level):
        nonlocal n
        gain, split = best(rows) if level < depth else (0, None)
        if split is None:
            done.append(rows)
        else:
            n += 1
            heapq.heappush(heap, (-gain, n, level, rows, split))
    push(np.arange(len(g)), 0)
    count = 1
    while heap and count < leaves:
        _, _, level, _, split = heapq.heappop(heap)
        count += 1
        for part in split:
            push(part, level + 1)
    return done + [x[3] for x in heap]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(3)
    x = np.round(draw.normal(size=(600, 3)), 1)
    y = ((x[:, 0] > 0.3).astype(int) + (x[:, 1] * x[:, 0] > 0.4)).tolist()
    frame = spark.createDataFrame([(i, y[i], x[i].tolist()) for i in range(600)], "id long, y int, x array<double>")
    return frame.select("id", "y", array_to_vector("x").alias("features")).repartition(3).cache(), x, np.array(y)


@pytest.mark.parametrize("cells", [1 << 20, 800])
def test_trees_are_best_first(spark, table, cells, monkeypatch):
    """Also when the histograms of a level take several jobs and no sibling is subtracted."""
    monkeypatch.setattr(leafwise, "MOST_CELLS", cells)
    frame, x, y = table
    model = Leafwise(3, rounds=1, max_depth=4, num_leaves=7, subsample=1.0, columns=1.0).fit(frame, "y")
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(model.edges)], axis=1)
    p = np.bincount(y, minlength=3) / len(y)
    for c in range(3):
        g, h = p[c] - (y == c), np.full(len(y), p[c] * (1 - p[c]) * 1.5)
        tree = model.trees[0][c]
        at = tree.leaf_of(lambda rows, f: x[rows, f], len(y), False)
        ours = sorted(tuple(np.flatnonzero(at == v)) for v in np.unique(at))
        assert ours == sorted(map(tuple, plain_tree(bins, g, h, 7, 4, 20)))
        for v in np.unique(at):
            assert tree.value[v] == pytest.approx(-0.05 * g[at == v].sum() / h[at == v].sum()) and tree.cover[v] == (at == v).sum()


def test_learns_saves_and_handles_odd_tables(spark, table, tmp_path):
    frame, x, y = table
    fitted = models.Classifier("leafwise", {"rounds": 12, "step": 0.3}, 3).fit(frame, "y")
    net = fitted.parts[0]
    assert all(b < a for a, b in zip(net.losses, net.losses[1:])) and len(net.losses) == 12
    said = fitted.predict(frame)
    assert said.where("pred = y").count() > 0.93 * 600
    fitted.save(spark, str(tmp_path / "m"))
    again = models.Fitted.load(spark, str(tmp_path / "m")).predict(frame)
    assert said.select("id", "probability").exceptAll(again.select("id", "probability")).count() == 0
    empty = Leafwise(3, rounds=2).fit(frame.limit(0), "y")
    assert empty.trees == [] and empty.predict(frame).select("probability").distinct().count() == 1
    one = Leafwise(3, rounds=2).fit(frame.withColumn("y", F.lit(1)).withColumn("features", array_to_vector(F.array(F.lit(1.0)))), "y")
    assert {len(t.feature) for trees in one.trees for t in trees} == {1}
