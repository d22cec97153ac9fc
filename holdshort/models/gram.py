"""Linear models of many folds and settings from sums of products, which one pass over the rows gives.

A table is cut at the times where a fold begins or ends. Each piece is reduced to its Gram matrix: the sums of all products
of the features, the target and 1. Running sums over the pieces give the matrix of any fold's training or validation
rows, and coordinate descent on a matrix gives the model of any penalty, so neither folds nor settings cost a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.base import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks that add up what the scanning tasks found; the driver gets so many tables of sums.
ADDERS = 16
#: Sweeps of coordinate descent and the change of a coefficient at which it stops.
SWEEPS, STILL = 10_000, 1e-12

Fold = tuple[datetime, datetime, datetime]


def piece(ts: str, cuts: Sequence[datetime]) -> Column:
    """Number of the cuts that are not after the time."""
    return reduce(Column.__add__, [(F.col(ts) >= F.lit(cut)).cast("int") for cut in cuts])


def piece_sums(rows: DataFrame, width: int, reduce_block: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Piece -> sum of `reduce_block(features, target)`, `width` numbers, over the rows (piece, target, features).

    A task adds its batches up and hands on one row per piece; a few tasks add these up, and the driver adds their sums.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).flatten().to_numpy().reshape(len(y), -1)
            for number in np.unique(at).tolist():
                here = at == number
                held[number] = held.get(number, 0.0) + reduce_block(x[here], y[here])
        yield _batch(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[number] = held.get(number, 0.0) + values.values.to_numpy()
        yield _batch(held)

    def _batch(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = pa.array(np.concatenate([*held.values(), np.empty(0)]))
        offsets = pa.array(np.arange(len(held) + 1, dtype=np.int32) * width)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.ListArray.from_arrays(offsets, values)], ["piece", "sums"])

    schema = "piece int, sums array<double>"
    added = rows.mapInArrow(scan, schema).repartition(ADDERS).mapInArrow(add, schema)
    out: dict[int, np.ndarray] = {}
    for row in added.toLocalIterator():
        out[row.piece] = out.get(row.piece, 0.0) + np.array(row.sums)
    return out


@dataclass(frozen=True)
class Gram:
    """Sums of products of (1, target, features...) over some rows."""

    sums: np.ndarray

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def fit(self, reg: float = 0.0, elastic: float = 0.0) -> tuple[np.ndarray, float]:
        """(coefficients, intercept) that minimise half the mean squared error plus the elastic-net penalty.

        As Spark's estimator does by default, the penalty counts coefficients of features and target divided by their
        standard deviations. A feature that does not vary has coefficient 0; without rows all is 0.
        """
        width = len(self.sums) - 2
        if not self.n:
            return np.zeros(width), 0.0
        mean = self.sums[0, 1:] / self.n
        spread = self.sums[1:, 1:] / self.n - np.outer(mean, mean)
        square = np.diag(self.sums)[1:] / self.n
        deviation = np.sqrt(np.where(np.diag(spread) > 1e-12 * np.maximum(square, 1e-300), np.diag(spread), 0.0))
        if not deviation[0]:
            return np.zeros(width), float(mean[0])
        varies = np.flatnonzero(deviation[1:])
        scale = deviation[1:][varies]
        both = spread[1:, 1:][np.ix_(varies, varies)] / np.outer(scale, scale)
        with_target = spread[1:, 0][varies] / (scale * deviation[0])
        found = np.zeros(width)
        found[varies] = descend(both, with_target, elastic * reg / deviation[0], (1 - elastic) * reg / deviation[0])
        found[varies] *= deviation[0] / scale
        return found, float(mean[0] - found @ mean[1:])

    def rmse(self, coefficients: np.ndarray, intercept: float) -> float | None:
        """Root of the mean squared error of a model on the rows; none without rows."""
        if not self.n:
            return None
        error = np.concatenate([[intercept, -1.0], coefficients])
        return float(np.sqrt(max(error @ self.sums @ error, 0.0) / self.n))


def descend(both: np.ndarray, with_target: np.ndarray, first: float, second: float) -> np.ndarray:
    """Minimise b'Cb/2 - c'b + first |b|_1 + second |b|_2^2 / 2 by coordinate descent; in closed form without |b|_1."""
    if not first:
        return np.linalg.lstsq(both + second * np.eye(len(both)), with_target, rcond=None)[0]
    found, left = np.zeros(len(both)), with_target.copy()  # left = c - C b
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(len(both)):
            pull = left[j] + both[j, j] * found[j]
            new = np.sign(pull) * max(abs(pull) - first, 0.0) / (both[j, j] + second)
            if new != found[j]:
                left -= both[:, j] * (new - found[j])
                most = max(most, abs(new - found[j]))
                found[j] = new
        if most < STILL:
            break
    return found


class Folds:
    """Gram matrices of the training and validation rows of temporal folds: (end of training, validation from, until)."""

    def __init__(self, rows: DataFrame, target: str, folds: Sequence[Fold], features: str = "features", ts: str = "timestamp"):
        self.folds = folds
        self.cuts = sorted({cut for fold in folds for cut in fold})
        self.width = len(first[0]) if (first := rows.select(vector_to_array(features)).first()) else 0
        self.rows = rows.where(F.col(target).isNotNull() & F.col(ts).isNotNull()).select(
            piece(ts, self.cuts).alias("piece"), F.col(target).cast("double").alias("y"), vector_to_array(features).alias("x"))
        size = self.width + 2

        def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = np.column_stack([np.ones(len(y)), y, x])
            return (z.T @ z).ravel()

        found = piece_sums(self.rows, size * size, products)
        self.running = self._running({k: v.reshape(size, size) for k, v in found.items()}, (size, size))

    def _running(self, found: dict[int, np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        return np.cumsum([np.zeros(shape), *[found.get(i, np.zeros(shape)) for i in range(len(self.cuts) + 1)]], axis=0)

    def _parts(self, running: np.ndarray, fold: Fold) -> tuple[np.ndarray, np.ndarray]:
        """(training, validation) values of a fold out of running sums over the pieces."""
        end, start, until = (self.cuts.index(cut) + 1 for cut in fold)
        return running[end], running[until] - running[start]

    def grams(self, fold: Fold) -> tuple[Gram, Gram]:
        train, validation = self._parts(self.running, fold)
        return Gram(train), Gram(validation)

    def search(self, grid: Sequence[dict], absolute: bool = True) -> list[dict]:
        """One row per fold and setting (regParam, elasticNetParam, and whatever else it names) with its errors.

        Models and squared errors come from the matrices; one more pass gives the absolute errors of all models at once.
        """
        fitted, out = {}, []
        for number, fold in enumerate(self.folds):
            train, validation = self.grams(fold)
            for params in grid:
                penalty = params.get("regParam", 0.0), params.get("elasticNetParam", 0.0)
                model = fitted.setdefault((number, penalty), train.fit(*penalty))
                out.append({"fold": number, "params": params, "coefficients": model[0], "intercept": model[1],
                            "train_rmse": train.rmse(*model), "val_rmse": validation.rmse(*model)})
        if absolute:
            at = {key: i for i, key in enumerate(fitted)}
            weights = np.column_stack([np.append(b, a) for b, a in fitted.values()])

            def misses(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                return np.abs(x @ weights[:-1] + weights[-1] - y[:, None]).sum(0)

            running = self._running(piece_sums(self.rows, len(at), misses), (len(at),))
            for row in out:
                fold = self.folds[row["fold"]]
                model = at[row["fold"], (row["params"].get("regParam", 0.0), row["params"].get("elasticNetParam", 0.0))]
                sizes = [g.n for g in self.grams(fold)]
                for name, sums, n in zip(("train", "val"), self._parts(running, fold), sizes):
                    row[f"{name}_mae"] = float(sums[model]) / n if n else None
        return out


def serves(estimator: Estimator, target: str) -> bool:
    """Whether models from sums stand for the estimator's: least squares with default scaling, run until they are still."""
    return (isinstance(estimator, LinearRegression) and estimator.getLoss() == "squaredError" and estimator.getFitIntercept()
            and estimator.getStandardization() and not estimator.isDefined("weightCol") and estimator.getLabelCol() == target
            and estimator.getMaxIter() >= 50)


def split_errors(train: DataFrame, validation: DataFrame, target: str, settings: Sequence[LinearRegression]) -> list[dict]:
    """train_mae, train_rmse, val_mae and val_rmse of each setting fitted on the training rows, from two passes over both."""
    features = settings[0].getFeaturesCol()
    width = len(first[0]) if (first := train.select(vector_to_array(features)).first()) else 0
    part = lambda df, number: df.where(F.col(target).isNotNull()).select(
        F.lit(number).alias("piece"), F.col(target).cast("double").alias("y"), vector_to_array(features).alias("x"))
    rows, size = part(train, 0).unionAll(part(validation, 1)), width + 2

    def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(y)), y, x])
        return (z.T @ z).ravel()

    found = piece_sums(rows, size * size, products)
    if 0 not in found:
        raise ValueError("a fold has no training rows")
    grams = [Gram(found.get(i, np.zeros(size * size)).reshape(size, size)) for i in (0, 1)]
    penalties = [(s.getRegParam(), s.getElasticNetParam()) for s in settings]
    fitted = {p: grams[0].fit(*p) for p in dict.fromkeys(penalties)}
    weights = np.column_stack([np.append(b, a) for b, a in fitted.values()])

    def misses(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.abs(x @ weights[:-1] + weights[-1] - y[:, None]).sum(0)

    sums, at, out = piece_sums(rows, len(fitted), misses), {p: i for i, p in enumerate(fitted)}, []
    for penalty in penalties:
        out.append({})
        for i, name in enumerate(("train", "val")):
            out[-1][f"{name}_mae"] = float(sums[i][at[penalty]]) / grams[i].n if grams[i].n else None
            out[-1][f"{name}_rmse"] = grams[i].rmse(*fitted[penalty])
    return out


def best_setting(results: Sequence[dict], metric: str = "val_rmse") -> dict:
    """The setting with the smallest mean error over the folds that have validation rows; the first of equals."""
    errors: dict[tuple, list[float]] = {}
    for row in results:
        if row[metric] is not None:
            errors.setdefault(tuple(row["params"].items()), []).append(row[metric])
    return dict(min(errors, key=lambda p: sum(errors[p]) / len(errors[p])))
