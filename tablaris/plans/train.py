"""Training: fit, explain, evaluate and cross-validate one linear model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.functions.parse import parse_number
from tablaris.operators.ordering import WINDOW_ROWS
from tablaris.operators.regression import (
    LinearModel,
    Moments,
    assign_folds,
    check_folds,
    coefficient_signs,
    coefficient_table,
    equation,
    evaluate_moments,
    fold_scores,
    merged,
    moments_by,
    performance_band,
    precise_by,
)
from tablaris.operators.split import train_test_split
from tablaris.sources.staging import stage


@dataclass(frozen=True)
class TrainReport:
    """A fitted model with everything known about it."""

    model: LinearModel
    train: Moments
    test: Moments
    mse: float
    r2: float
    folds: list[tuple[int, int, float, float]]

    @property
    def columns(self) -> list[str]:
        return [*self.model.features, self.model.target]

    def correlations(self) -> dict[tuple[str, str], float]:
        """Pearson correlation of every pair, from the moments at hand."""
        cov = self.train.merge(self.test).cov
        return {
            (a, b): _ratio(cov[i, j], math.sqrt(cov[i, i] * cov[j, j]))
            for i, a in enumerate(self.columns)
            for j, b in enumerate(self.columns)
        }

    def trends(self) -> dict[str, tuple[float, float]]:
        """Slope and intercept of the target on each single feature."""
        whole = self.train.merge(self.test)
        slopes = {
            f: _ratio(whole.cov[i, -1], whole.cov[i, i]) for i, f in enumerate(self.model.features)
        }
        return {
            f: (s, float(whole.means[-1] - s * whole.means[i]))
            for i, (f, s) in enumerate(slopes.items())
        }

    def by_impact(self) -> list[str]:
        """Features by absolute coefficient, largest first, ties by name."""
        size = dict(zip(self.model.features, map(abs, self.model.coefficients)))
        return sorted(size, key=lambda f: (-size[f], f))

    def explanation(self, spark: SparkSession) -> DataFrame:
        """The report in words: equation, direction of each feature, and grade."""
        table = coefficient_table(spark, self.model)
        equations = equation(table).select(F.lit("equation").alias("about"), F.col("equation").alias("text"))
        signs = coefficient_signs(table).select(F.concat(F.lit("effect_"), "term").alias("about"), F.col("effect").alias("text"))
        grade = performance_band(spark.createDataFrame([(float(self.r2),)], "r2 double"))
        return equations.union(signs).union(grade.select(F.lit("band").alias("about"), F.col("band").alias("text")))

    def summary(self, spark: SparkSession) -> DataFrame:
        """The report as rows of metric and value."""
        rows = [
            ("train_rows", self.train.n),
            ("test_rows", self.test.n),
            ("intercept", self.model.intercept),
            *[(f"coefficient_{f}", c) for f, c in zip(self.model.features, self.model.coefficients)],
            ("mse", self.mse),
            ("rmse", math.sqrt(self.mse)),
            ("r2", self.r2),
            *[(f"fold_{fold}_mse", mse) for fold, _, mse, _ in self.folds],
            *[(f"fold_{fold}_r2", r2) for fold, _, _, r2 in self.folds],
            ("cv_mse", math.fsum(s[2] for s in self.folds) / len(self.folds)),
            ("cv_r2", math.fsum(s[3] for s in self.folds) / len(self.folds)),
            *[(f"correlation_{f}", self.correlations()[f, self.model.target]) for f in self.model.features],
            *[(f"correlation_{a}_{b}", r) for (a, b), r in self.correlations().items() if a < b],
            *[(f"impact_rank_{f}", rank) for rank, f in enumerate(self.by_impact(), 1)],
            *[(f"sign_{f}", (c > 0) - (c < 0)) for f, c in zip(self.model.features, self.model.coefficients)],
            *[(f"trend_{f}", slope) for f, (slope, _) in self.trends().items()],
        ]
        return spark.createDataFrame(
            [(m, float(v)) for m, v in rows], "metric string, value double"
        )


def _ratio(a: float, b: float) -> float:
    return float(a / b) if b else math.nan


def prepare(
    df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Features and label as numbers, incomplete rows dropped, ``keep`` along."""
    wanted = [*features, label]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    numbers = [
        (F.col(c) if df.schema[c].dataType.typeName() == "double" else parse_number(F.col(c))).alias(c)
        for c in wanted
    ]
    extra = [c for c in dict.fromkeys(keep) if c not in wanted]
    return df.select(*numbers, *extra).na.drop("any", subset=wanted)


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    name: str = "model",
    test_share: float = 0.2,
    seed: int = 42,
    exact_split: bool = False,
    folds: int = 5,
    window_rows: int = WINDOW_ROWS,
    display: str = "",
) -> TrainReport:
    """Split by ``keys``, fit on the training part, evaluate, cross-validate.

    Fit, test scores, correlations, trends and folds all come from one pass that
    gathers the moments of both parts in every fold, after the edges of the folds,
    which are contiguous in ``order_by``.
    """
    order = list(order_by or keys)
    # The source is read once; every later pass scans these few columns.
    data = stage(prepare(df, features, label, [*keys, *order]), "prepared")
    split = train_test_split(data, keys, test_share, seed, exact_split)
    sides = assign_folds(split, order, folds, window_rows).withColumn("part", F.col("fold") * 2 + F.col("is_test"))
    found = moments_by(sides, features, label, "part")
    check_folds([None if p is None else p // 2 for p in found], folds, order[0])
    if {p % 2 for p in found} != {0, 1}:
        raise ValueError("the split left one side empty")
    precise = precise_by(sides, features, label, "part", found)
    parts = [merged(m for p, m in precise.items() if p % 2 == side) for side in (0, 1)]
    intercept, coefficients, dependent = parts[0].solve()
    model = LinearModel(
        tuple(features), label, intercept, tuple(map(float, coefficients)), name, dependent, display, datetime.now()
    )
    mse, r2 = evaluate_moments(parts[0], parts[1])
    scores = fold_scores({fold: merged(m for p, m in precise.items() if p // 2 == fold) for fold in range(folds)})
    known = [merged(m for p, m in found.items() if p % 2 == side) for side in (0, 1)]
    return TrainReport(model, known[0], known[1], mse, r2, scores)
