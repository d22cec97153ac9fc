"""Grid search over temporal folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.models import gram


def param_grid(**choices: Sequence) -> list[dict]:
    """Cartesian product of parameter values."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]


def regression_errors(scored: DataFrame, target: str, prediction: str = "prediction") -> tuple[float, float]:
    """(MAE, RMSE) from one pass."""
    e = F.col(prediction) - F.col(target)
    row = scored.agg(F.avg(F.abs(e)), F.sqrt(F.avg(e * e))).first()
    return row[0], row[1]


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    return scored.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]


def grid_search(make: Callable[..., Estimator], grid: Sequence[dict], folds: Sequence[tuple[DataFrame, DataFrame]],
                target: str, metric: str = "rmse", encoder: Estimator | None = None) -> tuple[dict, list[dict]]:
    """(best parameters, results): every setting is fitted on every fold, errors are averaged over the folds.

    Each fold is cached while its settings are fitted. A model always sees its own fold's training rows only, and so does
    the encoder, which is fitted once per fold and gives the features. Linear models that sums of products give
    (`gram.serves`) take two passes over a fold, whatever the number of settings, and no cache.
    """
    settings = [make(**params) for params in grid]
    from_sums = all(gram.serves(s, target) for s in settings)
    totals = [{"params": p, "train_mae": 0.0, "train_rmse": 0.0, "val_mae": 0.0, "val_rmse": 0.0} for p in grid]
    for train, validation in folds:
        if encoder is not None:
            fitted = encoder.fit(train)
            train, validation = (fitted.transform(x).select("features", target) for x in (train, validation))
        if from_sums:
            for result, errors in zip(totals, gram.split_errors(train, validation, target, settings)):
                for name, error in errors.items():
                    result[name] += (error or 0.0) / len(folds)
            continue
        train, validation = train.cache(), validation.cache()
        for setting, result in zip(settings, totals):
            model = setting.fit(train)
            for name, part in (("train", train), ("val", validation)):
                mae, rmse = regression_errors(model.transform(part), target)
                result[f"{name}_mae"] += (mae or 0.0) / len(folds)
                result[f"{name}_rmse"] += (rmse or 0.0) / len(folds)
        train.unpersist()
        validation.unpersist()
    best = min(totals, key=lambda r: r[f"val_{metric}"])
    return best["params"], totals


def classification_search(make: Callable[..., Estimator], grid: Sequence[dict], train: DataFrame, validation: DataFrame,
                          label: str) -> tuple[dict, list[dict]]:
    """(best parameters, results) by hold-out accuracy; the first of equals wins."""
    train, validation = train.cache(), validation.cache()
    results = [
        {"params": p, "accuracy": accuracy(make(**p).fit(train).transform(validation), label)} for p in grid]
    train.unpersist()
    validation.unpersist()
    return max(results, key=lambda r: r["accuracy"] or 0.0)["params"], results
