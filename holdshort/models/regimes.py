"""Two regimes of a target behind a learned gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.features.splits import split_by_quantile


@dataclass
class GatedModel:
    """A model per regime and a classifier that tells from the features how likely the high one is."""

    gate: Model | None
    low: Model
    high: Model
    cutoff: float

    def _odds(self, rows: DataFrame) -> DataFrame:
        if self.gate is None:
            return rows.withColumn("high_probability", F.lit(0.0))
        gate = self.gate.setPredictionCol("_gate").setProbabilityCol("_gate_p").setRawPredictionCol("_gate_raw")
        scored = gate.transform(rows).withColumn("high_probability", vector_to_array("_gate_p")[1])
        return scored.drop("_gate", "_gate_p", "_gate_raw")

    def route(self, rows: DataFrame) -> DataFrame:
        """Adds `is_high`, the likelier regime."""
        return self._odds(rows).withColumn("is_high", F.col("high_probability") >= 0.5).drop("high_probability")

    def transform(self, rows: DataFrame, weighted: bool = False) -> DataFrame:
        """Adds `high_probability` and `prediction`: the likelier regime's, or both regimes' weighted by their probability.

        The target is not read, so rows may lack it.
        """
        scored = self.high.setPredictionCol("_high").transform(self.low.setPredictionCol("_low").transform(self._odds(rows)))
        p = F.col("high_probability")
        mixed: Column = p * F.col("_high") + (1 - p) * F.col("_low")
        hard = F.when(p >= 0.5, F.col("_high")).otherwise(F.col("_low"))
        return scored.withColumn("prediction", mixed if weighted else hard).drop("_low", "_high")


def gated_regimes(train: DataFrame, target: str, make: Callable[[], Estimator], prob: float = 0.75, error: float = 0.01,
                  features: str = "features") -> GatedModel:
    """Fit both regimes and the gate on training rows alone. If no row lies above the cut-off there is one regime."""
    low, high, cutoff = split_by_quantile(train, target, prob, error)
    low_model = make().fit(low)
    if high.isEmpty():
        return GatedModel(None, low_model, low_model.copy(), cutoff)
    marked = train.where(F.col(target).isNotNull()).withColumn("_is_high", (F.col(target) > cutoff).cast("double"))
    gate = LogisticRegression(featuresCol=features, labelCol="_is_high", regParam=1e-3).fit(marked)
    return GatedModel(gate, low_model, make().fit(high), cutoff)
