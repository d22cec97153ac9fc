"""Classifiers of wait class, wake category and day type."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.sql import DataFrame

# Parameter grid of the published runs.
BAYES_GRID = {"smoothing": [0.0, 0.5, 1.0], "modelType": ["multinomial", "gaussian"]}


def naive_bayes(label: str, features: str = "features", weight: str | None = "weight", **params) -> NaiveBayes:
    """Class-weighted naive Bayes; features must not be negative for the multinomial kind."""
    extra = {"weightCol": weight} if weight else {}
    return NaiveBayes(featuresCol=features, labelCol=label, **extra, **params)


def logistic_map(train: DataFrame, label: str, features: str = "features", family: str = "auto", **params):
    """Logistic regression with a standard normal prior on the coefficients, at the posterior mode.

    The prior's penalty is 1/(2n) per squared coefficient; the intercept is left free.
    """
    n = train.count()
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                              standardization=False, family=family, **params).fit(train)
