"""Search over temporal folds, refit on the whole training period, report on the test period."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.features import splits
from holdshort.models import search
from holdshort.operators import reports


@dataclass
class Trained:
    """The chosen setting, errors of all settings, the fitted encoder and model, and the scored test rows."""

    best: dict
    results: list[dict]
    encoder: PipelineModel
    model: object
    scored: DataFrame

    def report(self) -> DataFrame:
        return reports.metrics_long(reports.regression_report(self.scored))

    def importances(self) -> DataFrame:
        """(feature, weight) of every slot of the feature vector: coefficients, or importances of trees."""
        weights = getattr(self.model, "coefficients", None)
        weights = self.model.featureImportances if weights is None else weights
        names = slot_names(self.scored, len(weights))
        return self.scored.sparkSession.createDataFrame(
            list(zip(names, (float(w) for w in weights.toArray()))), "feature string, weight double")


def slot_names(encoded: DataFrame, size: int, column: str = "features") -> list[str]:
    """Names of the slots of a feature vector, from the attributes that the encoder left on its column."""
    found = encoded.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a.get("name", f"{column}_{a['idx']}") for kind in found.values() for a in kind}
    return [names.get(i, f"{column}_{i}") for i in range(size)]


def train(rows: DataFrame, test_start: str, folds: Sequence[tuple[str, str, str]], encoder: Estimator,
          make: Callable[..., Estimator], grid: Sequence[dict], target: str = "takeoff_time", ts: str = "timestamp",
          metric: str = "rmse") -> Trained:
    """The training job.

    Rows from `test_start` on are only scored. Each fold fits the encoder and every setting on its own training rows; the
    setting with the least mean error over the folds is fitted again, with a new encoder, on the whole training period.
    """
    before, after = splits.time_split(rows, test_start, ts)
    best, results = search.grid_search(make, grid, splits.expanding_folds(before, folds, ts), target, metric, encoder)
    fitted = encoder.fit(before)
    model = make(**best).fit(fitted.transform(before).select("features", target))
    return Trained(best, results, fitted, model, model.transform(fitted.transform(after)))
