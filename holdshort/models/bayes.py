"""Naive Bayes of every kind and smoothing from the same sums: one pass over the rows.

Per class the sum of the weights, and of weighted values and squares of each feature, are all that any of the models needs.
Models score with expressions, so a whole grid is compared in one more pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.models.gram import piece_sums

#: Share of the largest variance that is added to all, as in Spark's estimator.
FLOOR = 1e-9


@dataclass(frozen=True)
class BayesModel:
    """Log-priors by class, and log-likelihoods by class and feature, or means and variances."""

    labels: list[int]
    prior: np.ndarray
    theta: np.ndarray
    sigma: np.ndarray | None = None

    def scores(self, features: Column) -> Column:
        """Log-joint of each class as an array; a feature of 0 says nothing where its likelihood is 0 (0 log 0 = 0)."""
        def total(terms: Column, start: float) -> Column:
            return F.aggregate(terms, F.lit(float(start)), lambda a, x: a + x)

        out = []
        for at in range(len(self.labels)):
            theta = _array(self.theta[at])
            if self.sigma is None:
                terms = F.zip_with(features, theta, lambda x, t: F.when(x == 0, 0.0).otherwise(x * t))
                out.append(total(terms, self.prior[at]))
            else:
                spread = _array(1 / (2 * self.sigma[at]))
                terms = F.zip_with(F.zip_with(features, theta, lambda x, m: (x - m) * (x - m)), spread, lambda d, s: -d * s)
                out.append(total(terms, self.prior[at] - 0.5 * np.log(2 * np.pi * self.sigma[at]).sum()))
        return F.array(*out)

    def predict(self, features: Column) -> Column:
        """The label of the highest score, the first of equals."""
        scores = self.scores(features)
        return F.element_at(_array(self.labels), F.array_position(scores, F.array_max(scores)).cast("int"))


def _array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


@dataclass(frozen=True)
class ClassSums:
    """Per class (rows): the sum of weights, and of weighted values and squares of the features."""

    labels: list[int]
    weights: np.ndarray
    values: np.ndarray
    squares: np.ndarray

    @classmethod
    def of(cls, rows: DataFrame, label: str, features: str = "features", weight: str | None = "weight") -> ClassSums:
        """Sums over rows with whole-number labels; a null label or weight does not count."""
        first = rows.select(vector_to_array(features)).first()
        width = len(first[0]) if first else 0
        heft = F.col(weight).cast("double") if weight else F.lit(1.0)
        given = rows.select(F.col(label).cast("int").alias("piece"), heft.alias("w"), vector_to_array(features).alias("x"))
        found = piece_sums(given.where("piece IS NOT NULL AND w IS NOT NULL"), 1 + 2 * width,
                           lambda x, w: np.concatenate([[w.sum()], w @ x, w @ (x * x)]))
        labels = sorted(found)
        table = np.array([found[x] for x in labels]).reshape(len(labels), 1 + 2 * width)
        return cls(labels, table[:, 0], table[:, 1:1 + width], table[:, 1 + width:])

    def model(self, kind: str = "multinomial", smoothing: float = 1.0) -> BayesModel:
        """The model that Spark's estimator would fit: `multinomial` wants values of 0 or more, `gaussian` ignores smoothing."""
        if not self.labels:
            raise ValueError("no labelled rows to learn from")
        with np.errstate(divide="ignore"):
            if kind == "gaussian":
                n = self.weights.sum()
                mean = self.values / self.weights[:, None]
                variance = self.squares / self.weights[:, None] - mean * mean
                whole = self.squares.sum(0) / n - (self.values.sum(0) / n) ** 2
                floor = FLOOR * max(float(whole.max(initial=0)), 1e-300)
                return BayesModel(self.labels, np.log(self.weights / n), mean, np.maximum(variance, 0) + floor)
            if (self.values < 0).any():
                raise ValueError("multinomial counts are negative")
            prior = np.log(self.weights + smoothing) - np.log(self.weights.sum() + smoothing * len(self.labels))
            totals = self.values.sum(1, keepdims=True) + smoothing * self.values.shape[1]
            return BayesModel(self.labels, prior, np.log(self.values + smoothing) - np.log(totals))


def search(sums: ClassSums, grid: Sequence[dict], validation: DataFrame, label: str,
           features: str = "features") -> tuple[dict, list[dict]]:
    """(best setting, accuracies) of all settings (modelType, smoothing) on held-out rows, in one pass over these."""
    models = [sums.model(p["modelType"], p["smoothing"]) for p in grid]
    read = validation.select(F.col(label).alias("_label"), vector_to_array(features).alias("_x"))
    hits = [F.avg((m.predict(F.col("_x")) == F.col("_label")).cast("double")).alias(f"a{i}") for i, m in enumerate(models)]
    found = read.agg(*hits).first()
    results = [{"params": p, "accuracy": x} for p, x in zip(grid, found)]
    return max(results, key=lambda r: r["accuracy"] or 0.0)["params"], results
