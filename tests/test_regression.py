import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablaris.operators import regression, tsqr
from tablaris.operators.regression import (
    LinearModel,
    assign_folds,
    coefficient_impact,
    coefficient_signs,
    coefficient_table,
    cross_validate,
    cross_validation_table,
    equation,
    evaluate,
    fit,
    performance_band,
    predict,
)
from tablaris.operators.split import train_test_split
from tablaris.plans.train import train


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(9)
    n = 403
    pdf = pd.DataFrame(
        {
            "id": rng.permutation(n),
            "a": rng.normal(1e6, 3, n),
            "b": rng.normal(0, 1e-3, n),
            "c": rng.integers(0, 7, n).astype(float),
        }
    )
    pdf["y"] = 5 + 2 * pdf.a - 300 * pdf.b + pdf.c + rng.normal(0, 0.1, n)
    return pdf


@pytest.fixture(scope="module")
def df(spark, sample):
    return spark.createDataFrame(sample).repartition(4)


FEATURES = ["a", "b", "c"]


def least_squares(pdf):
    x = np.column_stack([np.ones(len(pdf)), pdf[FEATURES] - pdf[FEATURES].mean()])
    w = np.linalg.lstsq(x, pdf.y, rcond=None)[0]
    return w[0] - w[1:] @ pdf[FEATURES].mean(), w[1:]


def test_exact_line(spark):
    rows = [(float(i), float(i * i % 7), 2.0 + 3 * i - i * i % 7) for i in range(10)]
    line = spark.createDataFrame(rows, "x1 double, x2 double, y double")
    model = fit(line, ["x1", "x2"], "y")
    assert model.intercept == pytest.approx(2)
    assert model.coefficients == pytest.approx((3, -1))
    assert evaluate(predict(line, model), "y").first()["r2"] == pytest.approx(1)


def test_badly_scaled_fit_agrees_with_least_squares(df, sample):
    model = fit(df, FEATURES, "y")
    intercept, w = least_squares(sample)
    assert model.coefficients == pytest.approx(w, rel=1e-8)
    assert model.intercept == pytest.approx(intercept, rel=1e-6)
    assert not model.rank_deficient


def test_incomplete_rows_do_not_count(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (None, 50.0), (3.0, None), (4.0, 4.0)]
    model = fit(spark.createDataFrame(rows, "x double, y double"), ["x"], "y")
    assert model.coefficients == pytest.approx((1,))


def test_dependent_features_are_flagged_and_share_the_weight(spark):
    rows = [(float(i), float(i), 2.0 * i + 1) for i in range(5)]
    model = fit(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y")
    assert model.rank_deficient
    assert model.coefficients == pytest.approx((1, 1))
    assert model.intercept == pytest.approx(1)


def test_fit_without_rows_is_an_error(spark):
    with pytest.raises(ValueError):
        fit(spark.createDataFrame([], "x double, y double"), ["x"], "y")


def test_metrics_and_bands(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (None, 1.0)]
    scored = spark.createDataFrame(rows, "y double, prediction double")
    m = evaluate(scored, "y").first()
    assert (m["n"], m["mse"], m["rmse"], m["r2"]) == pytest.approx((3, 0.5 / 3, math.sqrt(0.5 / 3), 0.75))
    table = spark.createDataFrame([(0.8,), (0.79,), (0.5,), (0.49,), (-1.0,), (None,)], "r2 double")
    bands = [r["band"] for r in performance_band(table).collect()]
    assert bands == ["good", "acceptable", "acceptable", "low", "low", None]


@pytest.mark.parametrize("prediction, r2", [(2.0, 1.0), (3.0, 0.0)])
def test_r2_of_a_constant_label(spark, prediction, r2):
    scored = spark.createDataFrame([(2.0, prediction)] * 3, "y double, prediction double")
    assert evaluate(scored, "y").first()["r2"] == r2


def test_r2_of_nothing_is_null(spark):
    scored = spark.createDataFrame([], "y double, prediction double")
    assert evaluate(scored, "y").first() == (0, None, None, None)


def test_explanations(spark):
    model = LinearModel(("a", "b", "c"), "y", 1.25, (0.5, -2.0, 0.0), "m")
    table = coefficient_table(spark, model)
    assert equation(table).first()["equation"] == (
        "y = 1.2500 + (0.5000 * a) + (-2.0000 * b) + (0.0000 * c)"
    )
    effects = {r["term"]: r["effect"] for r in coefficient_signs(table).collect()}
    assert effects == {"a": "positive", "b": "negative", "c": "none"}
    assert [r["term"] for r in coefficient_impact(table).collect()] == ["b", "a", "c"]


def test_fold_sizes(spark):
    folds = assign_folds(spark.range(12), ["id"], 5)
    rows = folds.groupBy("fold").agg(F.count("*"), F.min("id")).orderBy("fold").collect()
    assert [tuple(r) for r in rows] == [(0, 3, 0), (1, 3, 3), (2, 2, 6), (3, 2, 8), (4, 2, 10)]


def test_cross_validation_agrees_with_refits(spark, df, sample):
    scores = cross_validate(df, FEATURES, "y", ["id"])
    ordered = sample.sort_values("id").reset_index(drop=True)
    for fold, part in enumerate(np.array_split(np.arange(len(ordered)), 5)):
        test, rest = ordered.iloc[part], ordered.drop(index=part)
        intercept, w = least_squares(rest)
        error = test.y - intercept - test[FEATURES] @ w
        mse = float((error**2).mean())
        assert scores[fold][:2] == (fold, len(part))
        assert scores[fold][2] == pytest.approx(mse, rel=1e-5)
        assert scores[fold][3] == pytest.approx(1 - mse / test.y.var(ddof=0), rel=1e-6)
    table = cross_validation_table(spark, scores).collect()
    assert table[-1]["mse"] == pytest.approx(np.mean([s[2] for s in scores]))


def test_too_few_rows_for_the_folds(spark):
    tiny = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 2.0)], "id int, x double, y double")
    with pytest.raises(ValueError):
        cross_validate(tiny, ["x"], "y", ["id"])


def test_split_is_repeatable_and_near_its_share(spark):
    ids = spark.range(5_000)
    first = train_test_split(ids, ["id"])
    again = train_test_split(ids.repartition(7), ["id"])
    assert sorted(first.collect()) == sorted(again.collect())
    assert 900 < first.where("is_test = 1").count() < 1_100
    other = train_test_split(ids, ["id"], seed=1)
    assert sorted(first.collect()) != sorted(other.collect())


@pytest.mark.parametrize("n", [1, 7, 1_001])
def test_exact_split_takes_the_rounded_up_share(spark, n):
    split = train_test_split(spark.range(n), ["id"], exact=True)
    assert split.where("is_test = 1").count() == math.ceil(n / 5)


def test_training_report(spark, df, sample):
    report = train(df.withColumn("c", F.col("c").cast("string")), FEATURES, "y", ["id"], name="m")
    assert report.train.n + report.test.n == len(sample)
    corr = sample[[*FEATURES, "y"]].corr()
    for pair, r in report.correlations().items():
        assert r == pytest.approx(corr.loc[pair], abs=1e-9)
    slope, intercept = report.trends()["c"]
    assert (slope, intercept) == pytest.approx(tuple(np.polyfit(sample.c, sample.y, 1)), rel=1e-6)
    scored = train_test_split(df, ["id"]).where("is_test = 1")
    direct = evaluate(predict(scored, report.model), "y").first()
    assert (report.mse, report.r2) == pytest.approx((direct["mse"], direct["r2"]), rel=1e-5)
    metrics = {r["metric"]: r["value"] for r in report.summary(spark).collect()}
    assert metrics["rmse"] == pytest.approx(math.sqrt(report.mse))
    assert len([m for m in metrics if m.startswith("fold_")]) == 10


def test_training_names_missing_columns(df):
    with pytest.raises(ValueError, match="zz"):
        train(df, ["a", "zz"], "y", ["id"])


def test_cross_validation_needs_a_place_for_every_row(spark):
    rows = [(i, float(i), float(i)) for i in range(9)] + [(None, 1.0, 1.0)]
    with pytest.raises(ValueError, match="id"):
        cross_validate(spark.createDataFrame(rows, "id int, x double, y double"), ["x"], "y", ["id"], 3)


def exact_fit(rows):
    """Least squares in rational arithmetic, which loses nothing; rows end with the label."""
    design = [[Fraction(1), *map(Fraction, r)] for r in rows]
    width = len(design[0]) - 1
    normal = [[sum(r[i] * r[j] for r in design) for j in range(width + 1)] for i in range(width)]
    for i in range(width):
        pivot = next(k for k in range(i, width) if normal[k][i])
        normal[i], normal[pivot] = normal[pivot], normal[i]
        normal[i] = [v / normal[i][i] for v in normal[i]]
        for k in range(width):
            if k != i:
                normal[k] = [a - normal[k][i] * b for a, b in zip(normal[k], normal[i])]
    return [float(r[-1]) for r in normal]


def close_columns(apart, count=400):
    pick = random.Random(3)
    rows = []
    for _ in range(count):
        a, b, d = pick.random(), pick.random(), pick.randrange(1, 9)
        rows.append((a, a + apart * d, b, 2 + a - 3 * b + d + pick.random() / 100))
    return rows


@pytest.mark.parametrize("apart", [1e-3, 1e-6, 1e-9])
def test_nearly_dependent_columns_keep_their_digits(spark, apart):
    rows = close_columns(apart)
    df = spark.createDataFrame(rows, "a double, c double, b double, y double").repartition(7)
    model = regression.fit(df, ["a", "c", "b"], "y")
    assert not model.rank_deficient
    assert [model.intercept, *model.coefficients] == pytest.approx(exact_fit(rows), rel=1e-4)


def test_triangles_say_what_depends(spark):
    rows = [(float(i), 3.0 * i, float(i * i % 7), float(2 * i)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, c double, b double, y double")
    model = regression.fit(df, ["a", "c", "b"], "y")
    assert model.rank_deficient and model.coefficients == pytest.approx((0.2, 0.6, 0.0), abs=1e-9)  # the shortest
    one = regression.fit(df.limit(1), ["a", "b"], "y")
    assert one.rank_deficient and one.coefficients == pytest.approx((0.0, 0.0)) and one.intercept == pytest.approx(rows[0][3])
    with pytest.raises(ValueError, match="no complete rows"):
        regression.fit(df.limit(0), ["a"], "y")


def test_triangles_are_merged_in_a_tree(spark, monkeypatch):
    rows = close_columns(1e-7, 90)
    df = spark.createDataFrame(rows, "a double, c double, b double, y double").withColumn("side", F.expr("int(a * 3)")).repartition(20)
    want = tsqr.triangles(df, ["a", "c", "b", "y"], "side")
    monkeypatch.setattr(tsqr, "FAN_IN", 3)
    got = tsqr.triangles(df, ["a", "c", "b", "y"], "side")
    assert set(got) == {0, 1, 2} and sum(t.n for t in got.values()) == 90
    for side, t in got.items():
        own = [r for r in rows if int(r[0] * 3) == side]
        assert [t.solve()[0], *t.solve()[1]] == pytest.approx(exact_fit(own), rel=1e-3)
        assert t.score(1.0, np.array([1.0, 2.0, 3.0])) == pytest.approx(want[side].score(1.0, np.array([1.0, 2.0, 3.0])))
        y = np.array([r[3] for r in own])
        left = y - 1 - np.array([r[:3] for r in own]) @ [1, 2, 3]
        assert t.score(1.0, np.array([1.0, 2.0, 3.0])) == pytest.approx((np.mean(left**2), 1 - np.mean(left**2) / np.var(y)))


def test_wide_and_narrow_moments_agree(spark, monkeypatch):
    df = spark.range(300).selectExpr("id % 7 * 1.5D AS a", "rand(1) AS b", "rand(2) + id AS y", "if(id % 11 = 0, null, id % 2) AS side")
    narrow = regression.moments_by(df, ["a", "b"], "y", "side")
    monkeypatch.setattr(regression, "NARROW", 1)
    wide = regression.moments_by(df, ["a", "b"], "y", "side")
    assert set(narrow) == set(wide) == {None, 0, 1}
    for side, m in narrow.items():
        assert m.n == wide[side].n and m.means == pytest.approx(wide[side].means) and m.cov == pytest.approx(wide[side].cov)


def test_folds_of_nearly_dependent_columns(spark):
    rows = [(i, *r) for i, r in enumerate(close_columns(1e-9, 100))]
    df = spark.createDataFrame(rows, "id int, a double, c double, b double, y double")
    for fold, n, mse, _ in regression.cross_validate(df, ["a", "c", "b"], "y", ["id"]):
        inside = [r[1:] for r in rows if r[0] // 20 == fold]
        b0, *b = exact_fit([r[1:] for r in rows if r[0] // 20 != fold])
        left = [r[3] - b0 - sum(x * c for x, c in zip(r, b)) for r in inside]
        assert n == 20 and mse == pytest.approx(sum(e * e for e in left) / 20, rel=1e-3)
