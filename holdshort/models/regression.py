"""Wait-time regressors."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import math

from pyspark.ml.base import Estimator
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.features.splits import split_by_quantile
from holdshort.models.trees import HistogramBoosting, HistogramForest
from holdshort.session import freeze

# Parameter grids of the published runs.
LINEAR_GRID = {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100, 200]}
FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 5],
               "featureSubsetStrategy": ["sqrt", "0.5"]}
BOOST_GRID = {"maxIter": [100, 200], "maxDepth": [3, 6, 10], "stepSize": [0.01, 0.1, 0.3],
              "subsamplingRate": [0.7, 1.0], "featureSubsetStrategy": ["0.7", "all"]}
ADA_GRID = {"rounds": [50, 100, 200], "rate": [0.01, 0.1, 1.0], "loss": ["linear", "square", "exponential"]}


def linear_regression(target: str, features: str = "features", **params) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=target, **params)


def random_forest(target: str, features: str = "features", seed: int = 22, **params) -> RandomForestRegressor:
    return HistogramForest(featuresCol=features, labelCol=target, seed=seed, **params)


def boosted_trees(target: str, features: str = "features", seed: int = 22, **params) -> GBTRegressor:
    return HistogramBoosting(featuresCol=features, labelCol=target, seed=seed, **params)


def top_features(spark, names: Sequence[str], weights: Sequence[float], k: int = 20) -> DataFrame:
    """The k features with the largest absolute coefficient or importance (a model's own, bounded list)."""
    table = spark.createDataFrame(list(zip(names, map(float, weights))), "feature string, weight double")
    return table.orderBy(F.desc(F.abs("weight")), "feature").limit(k)


@dataclass
class AdaBoostModel:
    """Trees with their weights; the prediction is the weighted median of the trees' predictions."""

    trees: list
    weights: list[float]

    def transform(self, rows: DataFrame) -> DataFrame:
        out = rows
        for i, tree in enumerate(self.trees):
            out = tree.setPredictionCol(f"_p{i}").transform(out)
        pairs = F.array_sort(F.array(*[
            F.struct(F.col(f"_p{i}").alias("p"), F.lit(float(w)).alias("w")) for i, w in enumerate(self.weights)]))
        half = sum(self.weights) / 2
        step = F.aggregate(
            pairs, F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("p")),
            lambda acc, x: F.struct(
                (acc["sum"] + x["w"]).alias("sum"),
                F.when(acc["p"].isNull() & (acc["sum"] + x["w"] >= half), x["p"]).otherwise(acc["p"]).alias("p")))
        return out.withColumn("prediction", step["p"]).drop(*[f"_p{i}" for i in range(len(self.trees))])


def ada_boost(train: DataFrame, target: str, features: str = "features", rounds: int = 50, rate: float = 1.0,
              loss: str = "linear", max_depth: int = 3, seed: int = 22) -> AdaBoostModel:
    """AdaBoost.R2: rows that the last tree misses gain weight for the next one.

    Weights enter the trees directly instead of by resampling. Each round fits a tree, writes the rows with their errors to
    the shared folder and reads them once for sums; an exponential loss, which needs the largest error first, twice.
    """
    rows = freeze(train.select(features, target).withColumn("_w", F.lit(1.0)))
    trees, weights = [], []
    for i in range(rounds):
        tree = DecisionTreeRegressor(featuresCol=features, labelCol=target, weightCol="_w", maxDepth=max_depth,
                                     seed=seed + i).fit(rows)
        # errors are written each round: the next one neither repeats the trees before it nor grows its plan
        missed = freeze(tree.transform(rows).withColumn("_e", F.abs(F.col("prediction") - F.col(target))).drop("prediction"))
        w, e = F.col("_w"), F.col("_e")
        total, largest, first, second = missed.agg(F.sum(w), F.max(e), F.sum(w * e), F.sum(w * e * e)).first()
        if not largest:
            trees.append(tree)
            weights.append(1.0)
            break
        share = F.col("_e") / largest
        share = {"linear": share, "square": share * share, "exponential": 1 - F.exp(-share)}[loss]
        mean = {"linear": lambda: first / largest, "square": lambda: second / largest ** 2,
                "exponential": lambda: missed.agg(F.sum(w * share)).first()[0]}[loss]() / total
        if mean >= 0.5:
            if not trees:
                trees.append(tree)
                weights.append(1.0)
            break
        beta = mean / (1 - mean)
        trees.append(tree)
        weights.append(rate * math.log(1 / beta))
        rows = missed.withColumn("_w", w / total * F.pow(F.lit(beta), (1 - share) * rate)).drop("_e")
    return AdaBoostModel(trees, weights)


def model_per_group(train: DataFrame, test: DataFrame, group: str, make: Callable[[], Estimator],
                    groups: Sequence) -> DataFrame:
    """Fit one model per listed group (the runways) and union their predictions."""
    scored = [make().fit(train.where(F.col(group) == g)).transform(test.where(F.col(group) == g)) for g in groups]
    out = scored[0]
    for s in scored[1:]:
        out = out.unionByName(s)
    return out


@dataclass
class TwoRegimeScores:
    low: DataFrame
    high: DataFrame
    both: DataFrame
    cutoff: float


def two_regime_model(train: DataFrame, test: DataFrame, target: str, make: Callable[[], Estimator],
                     route: Callable[[DataFrame], DataFrame] | None = None, error: float = 0.01) -> TwoRegimeScores:
    """Separate models below and above the third quartile.

    By default test rows are routed by their true value, which only a comparison of regimes may do. `route` adds a
    boolean `is_high` from the features instead, for real predictions.
    """
    low, high, cutoff = split_by_quantile(train, target, 0.75, error)
    low_model, high_model = make().fit(low), make().fit(high)
    if route is None:
        to_low, to_high = test.where(F.col(target) <= cutoff), test.where(F.col(target) > cutoff)
    else:
        routed = route(test)
        to_low, to_high = routed.where("NOT is_high").drop("is_high"), routed.where("is_high").drop("is_high")
    a, b = low_model.transform(to_low), high_model.transform(to_high)
    return TwoRegimeScores(a, b, a.unionByName(b), cutoff)
