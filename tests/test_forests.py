from __future__ import annotations

import pytest
from pyspark.ml import functions as M
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tallyworks.ml.forests import NestedForestClassifier
from tallyworks.ml.tuning import grid_of


@pytest.fixture
def vectors(spark):
    """Three classes that the features tell about, with noise; few rows, so that leaves get small and are merged."""
    rows = spark.range(0, 1500, 1, 3).select(
        M.array_to_vector(F.array(*(F.floor(F.rand(k) * n).cast("double") for k, n in enumerate((3, 50, 7, 1000, 2))))).alias("features")
    )
    x = M.vector_to_array("features")
    return rows.withColumn("type", F.when(F.rand(9) < 0.3, F.floor(F.rand(8) * 3)).otherwise((x[1] > 20).cast("int") + (x[3] > 400).cast("int")).cast("double")).persist()


def test_settings_that_differ_in_depth_come_from_one_fit(vectors, monkeypatch):
    settings = {"impurity": ["entropy", "gini"], "maxDepth": [1, 2, 3, 5, 7], "numTrees": [1, 4]}
    fits, forest = [], NestedForestClassifier(labelCol="type", seed=42)
    fit = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, rows: fits.append(self.getMaxDepth()) or fit(self, rows))
    found = dict(forest.fitMultiple(vectors, grid_of(forest, settings)))
    assert fits == [7] * 4
    plain = RandomForestClassifier(labelCol="type", seed=42)
    merged = 0
    for i, params in enumerate(grid_of(plain, settings)):
        own, cut = plain.copy(params).fit(vectors), found[i]
        said = lambda model: model.toDebugString.split("\n", 1)[1]  # noqa: B023, E731
        assert said(own) == said(cut)
        assert (cut.getMaxDepth(), cut.getNumTrees, cut.getImpurity()) == (own.getMaxDepth(), own.getNumTrees, own.getImpurity())
        assert list(cut.featureImportances) == pytest.approx(list(own.featureImportances), abs=1e-12)
        columns = ["prediction", "probability", "rawPrediction"]
        assert cut.transform(vectors, params).select(columns).collect() == own.transform(vectors).select(columns).collect()
        merged += any(t.numNodes < 2 ** (own.getMaxDepth() + 1) - 1 for t in own.trees)
    assert merged > 5
