"""Held-out scenarios to the filled answer sheet, all scenarios in one job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame

from holdshort.operators import scenarios
from holdshort.operators.cleaning import clean_basic
from holdshort.operators.joins import join_meteo_hourly
from holdshort.plans.features import Settings, feature_table


def scenario_features(raw: DataFrame, answers: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Foreign recordings keyed by `scenario_name` to feature rows, with the asked stop appended to each."""
    s = replace(settings, scenario=True, by=("scenario_name",))
    messages = scenarios.inject_synthetic_rows(scenarios.normalise_scenario(raw), answers)
    return feature_table(messages, s)


def score_scenarios(features: DataFrame, answers: DataFrame, predict: Callable[[DataFrame], DataFrame],
                    meteo: DataFrame | None = None) -> DataFrame:
    """Add weather, clean, predict (a function that adds `prediction`) and fill the answer sheet."""
    rows = features if meteo is None else join_meteo_hourly(features, meteo, "timestamp")
    return scenarios.scenario_answers(answers, predict(clean_basic(rows)))
