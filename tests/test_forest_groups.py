"""A deep forest over many rows is grown in groups of trees that vote together."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from heatwise.operators import ml as M


@pytest.fixture(scope="module")
def rows(spark):
    data = [(k, float(k % 7), float(k % 11), "abc"[(k % 7 > 3) + (k % 11 > 5)]) for k in range(3000)]
    return spark.createDataFrame(data, "sl_no long, x double, y double, kind string").repartition(3, "sl_no").cache()


def test_fits_of_a_deep_forest_are_bounded(rows, monkeypatch):
    fits, fit = [], M.RandomForestClassifier.fit
    monkeypatch.setattr(M, "FOREST_AT_ONCE", 25_000, raising=False)
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda self, df, *a: fits.append(self.getNumTrees()) or fit(self, df, *a))
    p = M.predict_label(rows, "kind", ["x", "y"], scaled=True, num_trees=20, max_depth=8)
    train, test = M.hash_split(rows)
    assert sum(fits) == 20 and max(fits) * train.count() <= 25_000
    assert p.columns == ["sl_no", "kind", "kind_idx", "prediction"] and p.count() == test.count() == p.distinct().count()
    assert p.where("prediction = kind_idx").count() == p.count()
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") <= 4 + 2 * len(fits), "a group of trees is asked more than once"


def test_groups_vote_as_one_forest(rows):
    data = M.index_labels(M.assemble(rows, ["x", "y"]), "kind")
    models = M._fit_forest(data, "kind_idx", 5, 2, [2, 2, 1])
    out = M._predicted(models, data).select("prediction", *[vector_to_array(f"_raw{k}").alias(f"r{k}") for k in range(3)]).collect()
    votes = np.array([[r[f"r{k}"] for k in range(3)] for r in out])
    assert votes.shape == (3000, 3, 3) and np.allclose(votes.sum(axis=2), [2, 2, 1])
    assert (votes.sum(axis=1).argmax(axis=1) == np.array([r.prediction for r in out])).all()
    assert len({m.getSeed() for m in models}) == 3


def test_groups_depend_on_rows_alone():
    assert M._groups(100, 10, 5_000_000) == M._groups(100, 5, 10**9) == [100]
    assert M._groups(100, 10, 27_600_000) == [20] * 5
    for n in (6_000_001, 166_000_000, 10**10):
        g = M._groups(100, 10, n)
        assert sum(g) == 100 and max(g) - min(g) <= 1 and max(g) <= max(1, M.FOREST_AT_ONCE // n)
