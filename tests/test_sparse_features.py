"""Selection and components beside text: against dense numpy versions."""

import numpy as np
import pytest
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardline.operators import features, sparsefeat, trees


@pytest.fixture(scope="module")
def events(spark):
    draw = np.random.default_rng(6)
    words = ["alpha", "beta", "gamma", "delta", "login", "denied", "port", "scan"]
    rows = []
    for i in range(240):
        y = int(draw.integers(0, 2))
        own = [words[j] for j in draw.integers(0, 8, 6)] + (["scan denied"] if y and i % 5 else [])
        rows.append((i, y, float(draw.normal()), float(draw.normal() + y), " ".join(own) if i % 40 else ""))
    return spark.createDataFrame(rows, "id long, y int, a double, b double, msg string").cache()


def dense(frame):
    return np.array([r[0] for r in frame.orderBy("id").select(vector_to_array("features")).collect()])


def fit(events, **options):
    model = features.fit_features(events, ["a", "b"], "id", "y", "msg", text_options={"analyzer": "word", "ngram_range": (1, 2)}, **options)
    return model, dense(model.assemble(model.transform(events)))


def test_names_equal_the_vector_for_selection_and_text(spark, events, tmp_path):
    whole, full = fit(events)
    names = whole.feature_names()
    assert full.shape[1] == len(names) == len(whole.offered()) and "tfidf_0" in names
    y = np.array([r.y for r in events.orderBy("id").collect()])
    for selection in ("mutual_info", "model"):
        model, picked = fit(events, selection=selection, max_features=7, threshold="mean")
        chosen = model.feature_names()
        assert picked.shape[1] == len(chosen) <= 7 and any(n.startswith("tfidf_") for n in chosen)
        assert np.allclose(picked, full[:, [names.index(n) for n in chosen]])
        model.save(spark, str(tmp_path / selection))
        again = features.FeatureModel.load(spark, str(tmp_path / selection))
        assert np.allclose(dense(again.assemble(again.transform(events))), picked)
    cells = whole.transform(events, ["y"])
    table = {r.feature: r.importance for r in sparsefeat.presence_information(cells, "y", whole.text_columns()).collect()}
    for name in whole.text_columns():
        on, total = full[:, names.index(name)] > 0, 0.0
        for a in (on, ~on):
            for b in (y == 1, y == 0):
                both = (a & b).mean()
                total += both * np.log(both / (a.mean() * b.mean())) if both else 0.0
        assert table[name] == pytest.approx(total, abs=1e-9)


def test_components_of_sparse_rows(spark, events, tmp_path):
    whole, full = fit(events)
    for options, part in (({}, full), ({"selection": "mutual_info", "max_features": 9}, None)):
        model, scores = fit(events, pca_features=4, **options)
        if part is None:
            part = full[:, [whole.offered().index(n) for n in model.selected]]
        centred = part - part.mean(axis=0)
        values, axes = np.linalg.eigh(centred.T @ centred)
        known = centred @ axes[:, ::-1][:, :4]
        assert scores.shape == (240, 4) and model.feature_names() == [f"pca_{i}" for i in range(4)]
        assert np.allclose(np.abs(scores), np.abs(known), atol=1e-4)
        model.save(spark, str(tmp_path / f"m{len(options)}"))
        again = features.FeatureModel.load(spark, str(tmp_path / f"m{len(options)}"))
        assert np.allclose(dense(again.assemble(again.transform(events))), scores)
    none = spark.createDataFrame([], "indices array<int>, values array<double>")
    assert sparsefeat.sparse_pca(none, 5, 2)[1].shape == (5, 0)


def test_parts_of_a_sum_are_made_once(spark):
    """Ordering them in Spark would run the job again to sample its keys."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            pass
        made.add(1)
        yield trees.part_row(TaskContext.get().partitionId(), np.ones(3))

    total = trees.tree_sum(spark.range(8, numPartitions=4).mapInArrow(run, trees.PART), 3, tasks=4)
    assert total.tolist() == [4.0, 4.0, 4.0] and made.value == 4
