"""The rectified-linear network: gradients, early stopping, state, and the same epochs after a restart."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardline.operators import models
from wardline.operators.perceptron import Perceptron, forward, gradient, log_loss, size_of
from wardline.streaming.incremental import incremental_perceptron, restore


def test_gradient_is_that_of_the_loss():
    layers, draw = [4, 7, 5, 3], np.random.default_rng(1)
    flat, x, y = draw.normal(size=size_of(layers)), draw.normal(size=(20, 4)), draw.integers(0, 3, 20)
    found = gradient(flat, layers, x, y)
    for i in draw.choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        slope = (log_loss(forward(flat + step, layers, x)[-1], y) - log_loss(forward(flat - step, layers, x)[-1], y)) / 2e-6 / len(y)
        assert found[i] == pytest.approx(slope, abs=1e-5)


@pytest.fixture(scope="module")
def rings(spark):
    """Two classes that no straight line parts, and a third one far off."""
    draw = np.random.default_rng(4)
    angle, kind = draw.uniform(0, 2 * np.pi, 3000), draw.integers(0, 3, 3000)
    radius = np.array([1.0, 3.0, 6.0])[kind] + draw.normal(0, 0.2, 3000)
    rows = [(i, int(k), [float(r * np.cos(a)), float(r * np.sin(a))]) for i, (k, r, a) in enumerate(zip(kind, radius, angle))]
    return spark.createDataFrame(rows, "id long, y int, x array<double>").select("id", "y", array_to_vector("x").alias("features")).cache()


def test_stops_early_with_the_best_weights(spark, rings, tmp_path):
    fitted = models.Classifier("mlp", {"hidden": [32, 16], "step": 0.01, "max_iter": 60, "patience": 4}, 3).fit(rings, "y")
    net = fitted.parts[0]
    hits = fitted.predict(rings).agg(F.avg((F.col("pred") == F.col("y")).cast("double"))).first()[0]
    assert hits > 0.97
    assert len(net.history) <= 61 and net.stop_epoch <= len(net.history) - 1
    if len(net.history) < 61:
        assert len(net.history) - 1 - net.stop_epoch == 5  # patience ran out
    fitted.save(spark, str(tmp_path / "net"))
    again = models.Fitted.load(spark, str(tmp_path / "net"))
    a, b = (m.predict(rings).orderBy("id").limit(50).collect() for m in (fitted, again))
    assert [r.probability for r in a] == [r.probability for r in b]
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in a)


def test_goes_on_from_stored_weights(spark, rings, tmp_path):
    state = str(tmp_path / "state")
    args = dict(hidden=[16], rate=0.01, batch_size=50)
    incremental_perceptron(rings, "y", 3, 2, epochs=1, state_path=state, **args)
    first = restore(spark, state)
    model = incremental_perceptron(rings, "y", 3, 2, epochs=4, state_path=state, **args)
    assert first.steps == 1 and model.steps == 4 and restore(spark, state).steps == 4
    assert model.state[-1] == 4 * first.state[-1] == 4 * 60  # mini-batches gone through
    assert np.array_equal(restore(spark, state).weights, model.weights)


def test_many_tasks_and_no_rows(spark, rings):
    net = Perceptron([2, 16, 3], 0.02, 32)
    rows, tasks = net.prepared(rings, "y", 0.1, task_rows=100)
    assert tasks == 30
    losses = [net.epoch(rows) for _ in range(6)]
    assert losses[-1] < 0.7 * losses[0]
    empty = Perceptron([2, 4, 3])
    before = empty.weights.copy()
    empty.fit(rings.limit(0), "y", max_epochs=2)
    assert np.array_equal(before, empty.weights) and empty.history == []
