"""Naive Bayes from class sums against Spark's own fits."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdshort.models import bayes, search


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(6)
    data = [(float(i % 3), pick.choice([0.5, 1.0, 3.0]), float(pick.randint(0, 4) + i % 3), pick.random() * (1 + i % 3), float(i % 2)) for i in range(600)]
    df = spark.createDataFrame(data + [(None, 1.0, 1.0, 1.0, 1.0)], "label double, weight double, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize(("kind", "smoothing"), [("multinomial", 0.5), ("multinomial", 1.0), ("gaussian", 0.0)])
def test_models_equal_sparks(rows, kind, smoothing):
    known = rows.where("label IS NOT NULL")
    theirs = NaiveBayes(weightCol="weight", modelType=kind, smoothing=smoothing).fit(known)
    ours = bayes.ClassSums.of(rows, "label").model(kind, smoothing)
    assert np.allclose(ours.theta, theirs.theta.toArray(), atol=1e-9) and np.allclose(ours.prior, theirs.pi.toArray(), atol=1e-9)
    if kind == "gaussian":
        assert np.allclose(ours.sigma, theirs.sigma.toArray(), rtol=1e-6)
    both = theirs.transform(known).withColumn("ours", ours.predict(vector_to_array("features")))
    assert both.where("ours <> prediction").count() == 0


def test_search_in_one_pass(rows):
    known = rows.where("label IS NOT NULL")
    sums = bayes.ClassSums.of(known, "label")
    grid = search.param_grid(smoothing=[0.0, 1.0], modelType=["multinomial", "gaussian"])
    best, results = bayes.search(sums, grid, known, "label")
    assert max(r["accuracy"] for r in results) == next(r["accuracy"] for r in results if r["params"] == best)
    for r in results[2:]:
        scored = NaiveBayes(weightCol="weight", modelType=r["params"]["modelType"], smoothing=r["params"]["smoothing"]).fit(known).transform(known)
        assert r["accuracy"] == pytest.approx(search.accuracy(scored, "label"))


def test_zeros_say_nothing_without_smoothing(spark):
    df = spark.createDataFrame([(0.0, 1.0, 2.0, 0.0), (1.0, 1.0, 0.0, 3.0)], "label double, weight double, a double, b double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = bayes.ClassSums.of(df, "label").model("multinomial", 0.0)
    assert [r.p for r in df.select(model.predict(vector_to_array("features")).alias("p")).collect()] == [0.0, 1.0]


def test_rows_that_cannot_be_learned_from(rows):
    with pytest.raises(ValueError, match="no labelled rows"):
        bayes.ClassSums.of(rows.limit(0), "label").model()
    with pytest.raises(ValueError, match="negative"):
        negative = VectorAssembler(inputCols=["m"], outputCol="v").transform(rows.withColumn("m", -F.col("a") - 1))
        bayes.ClassSums.of(negative, "label", "v").model()
