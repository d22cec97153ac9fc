"""Forests and boosted trees from histograms against Spark's own fits."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from holdshort.features import encoders
from holdshort.models import histograms, regression, trees


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    found = []
    for i in range(900):
        kind, hour, x = rnd.choice("abcd"), rnd.randrange(24), rnd.random()
        found.append((kind, rnd.choice(["0", "1"]), float(hour), x, {"a": 3.0, "b": 9.0}.get(kind, 5.0) * x + abs(hour - 9.0) + rnd.random()))
    df = spark.createDataFrame(found, "kind string, flag string, hour double, x double, y double")
    return encoders.feature_pipeline_lr(["kind"], ["hour", "x"], ["flag"]).fit(df).transform(df).select("y", "features").cache()


def predictions(model, rows):
    return np.array([r.prediction for r in model.transform(rows).orderBy("y").collect()])


def test_a_tree_equals_sparks(rows):
    params = dict(numTrees=1, maxDepth=7, bootstrap=False, minInstancesPerNode=2)
    spark_model = RandomForestRegressor(featuresCol="features", labelCol="y", seed=22, **params).fit(rows)
    model = regression.random_forest("y", **params).fit(rows)
    assert np.allclose(predictions(model, rows), predictions(spark_model, rows), atol=1e-9)
    # equally good splits of a small node may go to another feature
    assert np.allclose(model.featureImportances.toArray(), spark_model.featureImportances.toArray(), atol=5e-3)
    assert model.trees[0].numNodes == spark_model.trees[0].numNodes


@pytest.mark.parametrize("depth", [3, 5])
def test_boosting_equals_sparks(rows, monkeypatch, depth):
    monkeypatch.setattr(trees, "ROUNDS", 2)
    spark_model = GBTRegressor(featuresCol="features", labelCol="y", seed=22, maxIter=4, maxDepth=depth).fit(rows)
    model = regression.boosted_trees("y", maxIter=4, maxDepth=depth).fit(rows)
    assert np.allclose(predictions(model, rows), predictions(spark_model, rows), atol=1e-6)


def test_three_levels_of_boosting_take_one_pass(rows, monkeypatch):
    """Spark took a pass per level, and one for residuals."""
    passes, read = [], trees.Grower._read
    monkeypatch.setattr(trees.Grower, "_read", lambda self, path: passes.append(path) or read(self, path))
    regression.boosted_trees("y", maxIter=3, maxDepth=3, subsamplingRate=0.7).fit(rows)
    assert len(passes) == 1 + 3


def test_a_forest_keeps_nothing_per_row_and_tree(rows, monkeypatch, tmp_path):
    """Spark kept a weight per row and tree: 400 bytes a row for 100 trees."""
    kept = []
    store = trees.Grower._store

    def weigh(self, blocks):
        path = store(self, blocks)
        sizes = self.spark.read.schema(histograms.BLOCKS).parquet(path).agg(F.sum(F.length("codes") + F.length("y"))).first()
        kept.append(sizes[0] / 900)
        return path

    monkeypatch.setattr(trees.Grower, "_store", weigh)
    monkeypatch.setattr(trees, "BUDGET", 30_000)  # several batches of trees, and of a tree's nodes
    model = regression.random_forest("y", numTrees=20, maxDepth=3).fit(rows)
    assert len(kept) == 2 and max(kept) <= 8 + 4 * 8 and model.getNumTrees == 20
    spread = rows.agg(F.stddev("y")).first()[0]
    y = np.array([r.y for r in rows.orderBy("y").collect()])
    assert np.sqrt(((predictions(model, rows) - y) ** 2).mean()) < 0.7 * spread
    path = str(tmp_path / "forest")
    model.write().save(path)
    assert np.allclose(predictions(model, rows), predictions(RandomForestRegressionModel.load(path), rows), atol=1e-9)


def test_bags_follow_their_distributions():
    _, weight = histograms._bag(1, 2, 3, 1_000_000, 1.0, True)
    shares = np.bincount(weight.astype(int), minlength=6)[1:6] / 1_000_000
    assert np.allclose(shares, [np.exp(-1) / f for f in (1, 2, 6, 24, 120)], atol=2e-3)
    at, _ = histograms._bag(1, 2, 3, 1_000_000, 0.7, False)
    assert abs(len(at) / 1_000_000 - 0.7) < 2e-3


def test_missing_labels_are_refused(rows):
    with pytest.raises(Exception, match="null"):
        regression.random_forest("y", numTrees=2).fit(rows.withColumn("y", F.when(F.col("y") > 5, F.col("y"))))
