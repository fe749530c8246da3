"""Scoring: stored models applied to a table of requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablaris.operators.scoring import Exercise, Messages, score_requests, score_with_models
from tablaris.sources.models import load_models, stored_models


def score_with_stored_models(
    spark: SparkSession,
    requests: DataFrame,
    model_path: str,
    exercises: Sequence[Exercise],
    messages: Messages | None = None,
    version: int | None = None,
) -> DataFrame:
    """Answers to ``(request_id, exercise, fields)`` rows, lazily, by the models of a version."""
    models = load_models(spark, model_path, [e.model for e in exercises], version)
    return score_requests(requests, exercises, models, messages)


def score_with_many_models(
    spark: SparkSession,
    requests: DataFrame,
    model_path: str,
    exercises: DataFrame,
    messages: Messages | None = None,
    version: int | None = None,
) -> DataFrame:
    """The same with exercises as a table, and as many stored models as they name."""
    return score_with_models(requests, exercises, stored_models(spark, model_path, version), messages)
