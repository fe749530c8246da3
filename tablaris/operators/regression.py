"""Ordinary least squares from co-moments.

One pass gathers means and population covariances of features and label (as
deviations, unlike raw sums of products), by fold where folds are asked for. What reaches the driver is a matrix of
``(features + 1)`` squared numbers per fold; the solve happens there. Where these
show that features nearly depend on each other, a second pass takes triangles
(:mod:`tsqr`), which keep the digits that co-moments lose.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.operators.moments import PairMoments, pair_moments
from tablaris.operators.ordering import WINDOW_ROWS, cut_by_rank
from tablaris.operators.tsqr import Triangle, triangles

# FIXED VALUES: lower R² limits of the performance bands.
GOOD_R2 = 0.80
ACCEPTABLE_R2 = 0.50

# Columns up to which co-moments are single aggregates; wider tables take products of matrices.
NARROW = 12
# Least eigenvalue of the features' correlations from which on their co-moments are enough.
DISTINCT = 1e-6


@dataclass(frozen=True)
class LinearModel:
    """Fitted line with everything needed to store, explain and apply it."""

    features: tuple[str, ...]
    target: str
    intercept: float
    coefficients: tuple[float, ...]
    name: str = "model"
    # True when features were linearly dependent (shortest solution taken).
    rank_deficient: bool = False
    # Shown in answers instead of the name, if given.
    display: str = ""
    # When it was fitted; not part of what makes models equal.
    fitted_at: datetime | None = field(default=None, compare=False)


@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariances of features, then label."""

    n: int
    means: np.ndarray
    cov: np.ndarray

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        if n == 0:
            return self
        delta = other.means - self.means
        cov = (self.n * self.cov + other.n * other.cov) / n
        cov = cov + np.outer(delta, delta) * (self.n * other.n / n**2)
        return Moments(n, self.means + delta * (other.n / n), cov)


    def distinct(self) -> bool:
        """Whether the features are far enough from dependent to be solved for from here."""
        sxx = self.cov[:-1, :-1]
        scale = np.sqrt(np.diag(sxx))
        if not len(scale) or not np.isfinite(sxx).all():
            return True
        if (scale == 0).any():
            return False
        return bool(np.linalg.eigvalsh(sxx / np.outer(scale, scale))[0] > DISTINCT)

    def solve(self) -> tuple[float, np.ndarray, bool]:
        return solve(self)

    def score(self, intercept: float, coefficients: np.ndarray) -> tuple[float, float]:
        """Mean squared error and R² of a fit on these rows."""
        w, spread = coefficients, self.cov[-1, -1]
        bias = self.means[-1] - intercept - self.means[:-1] @ w
        mse = bias**2 + spread - 2 * (w @ self.cov[:-1, -1]) + w @ self.cov[:-1, :-1] @ w
        mse = max(float(mse), 0.0)
        if spread == 0:
            return mse, 1.0 if mse == 0 else 0.0
        return mse, 1 - mse / spread


def _from_pairs(found: PairMoments | None, width: int) -> Moments:
    """Rows are complete here, so every pair has the same rows."""
    if found is None:
        return Moments(0, np.zeros(width), np.zeros((width, width)))
    return Moments(int(found.n[0, 0]), found.mean[:, 0], found.joint / found.n[0, 0])


def _complete(df: DataFrame, columns: Sequence[str], *extra: str) -> DataFrame:
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*doubles, *extra).na.drop("any", subset=list(columns))


def _aggregated(rows: DataFrame, columns: Sequence[str], by: Sequence[str]) -> dict[object, Moments]:
    """Moments by single aggregates, which stay inside generated code."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    found = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in columns]).alias("means"),
        F.array(*[F.covar_pop(columns[i], columns[j]) for i, j in pairs]).alias("cov"),
    )
    out = {}
    for row in found.collect():
        if row["n"]:
            cov = np.zeros((len(columns),) * 2)
            for (i, j), value in zip(pairs, row["cov"]):
                cov[i, j] = cov[j, i] = value
            out[row[0] if by else None] = Moments(row["n"], np.array(row["means"]), cov)
    return out


def moments(df: DataFrame, features: Sequence[str], label: str) -> Moments:
    columns = [*features, label]
    rows = _complete(df, columns)
    if len(columns) <= NARROW:
        return _aggregated(rows, columns, []).get(None) or _from_pairs(None, len(columns))
    return _from_pairs(pair_moments(rows, columns).get(None), len(columns))


def moments_by(df: DataFrame, features: Sequence[str], label: str, by: str) -> dict[int, Moments]:
    """Moments per value of a column of a stated few values, such as a fold."""
    columns = [*features, label]
    rows = _complete(df, columns, by)
    if len(columns) <= NARROW:
        return _aggregated(rows, columns, [by])
    return {k: _from_pairs(m, len(columns)) for k, m in pair_moments(rows, columns, by).items()}


def merged(parts: Iterable[Moments] | Iterable[Triangle]) -> Moments | Triangle:
    return reduce(lambda a, b: a.merge(b), parts)


def precise_by(
    df: DataFrame, features: Sequence[str], label: str, by: str, found: dict[int, Moments]
) -> dict[int, Moments] | dict[int, Triangle]:
    """``found``, or triangles of the same rows if the features are close to dependent."""
    if not found or merged(found.values()).distinct():
        return found
    columns = [*features, label]
    return triangles(_complete(df, columns, by), columns, by)


def solve(m: Moments) -> tuple[float, np.ndarray, bool]:
    """Intercept, coefficients, and whether the features were dependent."""
    if m.n == 0:
        raise ValueError("no complete rows to fit")
    sxx, sxy = m.cov[:-1, :-1], m.cov[:-1, -1]
    scale = np.sqrt(np.diag(sxx))
    dependent = bool((scale == 0).any())
    if not dependent:
        # Correlations, not covariances: columns of very different size stay comparable.
        scaled = sxx / np.outer(scale, scale)
        dependent = np.linalg.matrix_rank(scaled, tol=1e-10, hermitian=True) < len(scale)
    if dependent:
        coefficients = np.linalg.pinv(sxx, rcond=1e-10, hermitian=True) @ sxy
    else:
        coefficients = np.linalg.solve(scaled, sxy / scale) / scale
    return float(m.means[-1] - m.means[:-1] @ coefficients), coefficients, dependent


def solve_rows(df: DataFrame, features: Sequence[str], label: str, found: Moments) -> tuple[float, np.ndarray, bool]:
    """The solution for ``df``, whose moments are ``found``; one more pass if features are close to dependent."""
    if found.n == 0 or found.distinct():
        return solve(found)
    columns = [*features, label]
    center = dict(zip(columns, found.means.tolist()))
    intercept, coefficients, dependent = triangles(_complete(df, columns), columns, center=center)[None].solve()
    return float(intercept + found.means[-1] - found.means[:-1] @ coefficients), coefficients, dependent


def fit(df: DataFrame, features: Sequence[str], label: str, name: str = "model") -> LinearModel:
    """Least-squares fit with intercept over the rows where all columns are known."""
    intercept, coefficients, dependent = solve_rows(df, features, label, moments(df, features, label))
    return LinearModel(
        tuple(features), label, intercept, tuple(map(float, coefficients)), name, dependent, fitted_at=datetime.now()
    )


def coefficient_table(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Intercept at position 0, then one row per feature."""
    terms = [("intercept", model.intercept), *zip(model.features, model.coefficients)]
    rows = [
        (model.name, model.target, term, position, float(value))
        for position, (term, value) in enumerate(terms)
    ]
    return spark.createDataFrame(
        rows, "model string, target string, term string, position int, coefficient double"
    )


def equation(coefficients: DataFrame) -> DataFrame:
    """One row per model: the fitted equation as text, four decimals."""
    term = F.format_string("(%.4f * %s)", "coefficient", "term")
    text = F.when(F.col("position") == 0, F.format_string("%.4f", "coefficient")).otherwise(term)
    parts = F.sort_array(F.collect_list(F.struct("position", text.alias("text"))))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), " + ")
    # A model has one row per term, so the list is as long as the feature list.
    return coefficients.groupBy("model", "target").agg(
        F.concat(F.first("target"), F.lit(" = "), joined).alias("equation")
    )


def coefficient_signs(coefficients: DataFrame) -> DataFrame:
    """Direction in which each feature moves the target."""
    c = F.col("coefficient")
    sign = F.when(c > 0, "positive").when(c < 0, "negative").otherwise("none")
    return coefficients.where("position > 0").withColumn("effect", sign)


def coefficient_impact(coefficients: DataFrame) -> DataFrame:
    """Features by absolute coefficient, largest first, ties by name."""
    impact = F.abs("coefficient")
    return (
        coefficients.where("position > 0")
        .withColumn("impact", impact)
        .orderBy(F.desc("impact"), "term")
    )


def predict(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    """Add the model's value: plain arithmetic on literals, no join."""
    value = F.lit(model.intercept)
    for feature, coefficient in zip(model.features, model.coefficients):
        value = value + F.lit(coefficient) * F.col(feature)
    return df.withColumn(out, value)


def evaluate(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: rows, mean squared error, its root, R²."""
    y, p = F.col(label), F.col(prediction)
    known = df.where(y.isNotNull() & p.isNotNull())
    sums = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("spread"),
    )
    flat = F.when(F.col("mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("spread") == 0, flat).otherwise(
        1 - F.col("mse") / F.nullif(F.col("spread"), F.lit(0.0))
    )
    return sums.select(
        "n", "mse", F.sqrt("mse").alias("rmse"), F.when(F.col("n") > 0, r2).alias("r2")
    )


def performance_band(metrics: DataFrame) -> DataFrame:
    """Verbal grade of R²."""
    r2 = F.col("r2")
    band = (
        F.when(r2 >= GOOD_R2, "good")
        .when(r2 >= ACCEPTABLE_R2, "acceptable")
        .when(r2.isNotNull(), "low")
    )
    return metrics.withColumn("band", band)


def assign_folds(
    df: DataFrame, order_by: Sequence[str], folds: int, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Contiguous folds in row order, the first ``n % folds`` one row longer."""

    def ends(n: int) -> list[int]:
        size, longer = divmod(n, folds)
        return [size * i + min(i, longer) for i in range(1, folds)]

    return cut_by_rank(df, order_by, ends, "fold", window_rows)


def evaluate_moments(train: Moments | Triangle, test: Moments | Triangle) -> tuple[float, float]:
    """MSE and R² of the train fit on the test rows, from what is known of both."""
    intercept, w, _ = train.solve()
    return test.score(intercept, w)


def fold_scores(parts: dict[int, Moments] | dict[int, Triangle]) -> list[tuple[int, int, float, float]]:
    """(fold, rows, MSE, R²) per fold; every fold is scored by a fit on the others."""
    scores = []
    for fold in sorted(parts):
        train = merged(part for other, part in parts.items() if other != fold)
        scores.append((fold, parts[fold].n, *evaluate_moments(train, parts[fold])))
    return scores


def check_folds(found: Iterable[int | None], folds: int, lead: str) -> None:
    """Every row must have a fold, and every fold a row."""
    if None in found:
        raise ValueError(f"rows without {lead} have no place in the order")
    if len(set(found)) < folds:
        raise ValueError(f"{folds} folds need at least {folds} rows")


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    order_by: Sequence[str],
    folds: int = 5,
    window_rows: int = WINDOW_ROWS,
) -> list[tuple[int, int, float, float]]:
    """(fold, rows, MSE, R²) per fold; every fold is scored by a fit on the others.

    The table is read for the fold edges and once more for the moments of all
    folds together, however many there are.
    """
    columns = [*features, label]
    keep = [c for c in order_by if c not in columns]
    complete = df.select(*columns, *keep).na.drop("any", subset=columns)
    folded = assign_folds(complete, order_by, folds, window_rows)
    found = moments_by(folded, features, label, "fold")
    check_folds(found, folds, order_by[0])
    return fold_scores(precise_by(folded, features, label, "fold", found))


def cross_validation_table(
    spark: SparkSession, scores: Sequence[tuple[int, int, float, float]]
) -> DataFrame:
    """Scores per fold and their mean (fold NULL)."""
    mse = math.fsum(s[2] for s in scores) / len(scores)
    r2 = math.fsum(s[3] for s in scores) / len(scores)
    rows = [*scores, (None, sum(s[1] for s in scores), mse, r2)]
    return spark.createDataFrame(
        [(f, n, float(m), float(r)) for f, n, m, r in rows],
        "fold int, n long, mse double, r2 double",
    )
