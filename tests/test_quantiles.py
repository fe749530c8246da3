import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tablaris.operators import quantiles as selection
from tablaris.operators.outliers import iqr_fences, winsorize
from tablaris.operators.quantiles import interpolated_quantiles, order_statistics, quantiles
from tablaris.operators.stats import correlation_matrix, describe, fitted_trends, null_counts


def expected(values, rank):
    ordered = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    value = ordered[rank - 1]
    if isinstance(value, float) and math.isnan(value):
        sane = [v for v in values if not math.isnan(v)]
        return len(sane), len(values) - len(sane)
    return sum(v < value for v in values), sum(v == value for v in values)


def check(spark, values, kind, ranks, rank_rows):
    df = spark.createDataFrame([(v,) for v in [*values, None]], f"x {kind}").repartition(4)
    n, found = order_statistics(df, {"x": lambda n: ranks}, rank_rows)["x"]
    assert n == len(values)
    ordered = sorted(values, key=lambda v: (isinstance(v, float) and math.isnan(v), v))
    for rank, s in zip(ranks, found):
        want = ordered[rank - 1]
        assert s.value == want or (math.isnan(s.value) and math.isnan(want))
        assert (s.below, s.equal) == expected(values, rank)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.sampled_from([-1.5, 0.0, 2.0, 3.25, 1e300, math.nan]), min_size=1, max_size=40),
    st.data(),
)
def test_selection_with_ties_and_nan(spark, values, data):
    ranks = data.draw(st.lists(st.integers(1, len(values)), min_size=1, max_size=3))
    check(spark, values, "double", ranks, rank_rows=2)


def test_selection_narrows_over_several_passes(spark):
    rng = random.Random(7)
    values = [rng.gauss(0, 1) ** 5 for _ in range(20_000)] + [0.5] * 7_000
    ranks = [1, 2, 6_750, 13_500, 20_000, 26_999, 27_000]
    check(spark, values, "double", ranks, rank_rows=10)


def test_selection_keeps_every_digit_of_long_keys(spark):
    base = 2**60
    check(spark, [base + i for i in range(3_000)], "long", [1, 1_500, 1_501, 3_000], rank_rows=5)


def test_selection_with_one_value_for_a_third_of_the_rows(spark):
    values = [7] * 1_000 + list(range(2_000))
    check(spark, values, "int", [1, 8, 9, 1_008, 1_009, 3_000], rank_rows=20)


def test_selection_rejects_impossible_rank(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        order_statistics(df, {"x": lambda n: [2]})


def test_quantile_rule_and_modes(spark):
    df = spark.createDataFrame([(float(i), i % 7) for i in range(1, 1001)], "x double, y int")
    for mode in ("exact", "approx"):
        assert quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], mode) == {
            "x": [250.0, 500.0, 750.0],
            "y": [1, 3, 5],
        }


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_quantiles_of_nothing(spark, mode):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles(df, ["x"], [0.25, 0.75], mode) == {"x": [None, None]}
    assert quantiles(df.where("false"), ["x"], [0.5], mode) == {"x": [None]}
    assert iqr_fences(df, ["x"], mode) == {"x": None}


def test_approximate_quartiles_stay_within_their_rank_error(spark):
    rng = np.random.default_rng(3)
    values = rng.lognormal(size=60_000)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(8)
    ordered = np.sort(values)
    for p, v in zip((0.25, 0.75), quantiles(df, ["x"], [0.25, 0.75], "approx")["x"]):
        assert abs(np.searchsorted(ordered, v) - p * len(values)) <= len(values) / 10_000 + 1


@pytest.mark.parametrize("rank_rows", [1, 100_000])
def test_describe_agrees_with_pandas(spark, rank_rows):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "b": rng.integers(0, 9, 501)})
    df = spark.createDataFrame(pdf)
    want = pdf.describe()
    got = interpolated_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75], rank_rows)
    for c in "ab":
        assert np.allclose(got[c], want[c][["25%", "50%", "75%"]])
    for row in describe(df, ["a", "b"]).collect():
        assert np.allclose(list(row)[1:], want[row["column"]])


def test_null_counts_on_empty_table_are_zero(spark):
    df = spark.createDataFrame([], "a int, b int")
    assert [r["nulls"] for r in null_counts(df, ["a", "b"]).collect()] == [0, 0]


def test_correlations_and_trends_agree_with_numpy(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200)})
    pdf["y"] = 3 * pdf.a - pdf.b + rng.normal(size=200)
    df = spark.createDataFrame(pdf)
    want = pdf.corr()
    for r in correlation_matrix(df, ["a", "b", "y"]).collect():
        assert r["r"] == pytest.approx(want.loc[r["variable_a"], r["variable_b"]])
    line = np.poly1d(np.polyfit(pdf.a, pdf.y, 1))
    fitted = fitted_trends(df, ["a"], "y").toPandas()
    assert np.allclose(fitted["trend_a"], line(fitted["a"]))


def test_constant_column_flags_and_caps_the_odd_value(spark):
    df = spark.createDataFrame([(5.0,)] * 9 + [(6.0,)], "x double")
    rows = winsorize(df, iqr_fences(df, ["x"])).collect()
    assert {tuple(r) for r in rows} == {(5.0, 0), (5.0, 1)}


def test_value_on_the_limit_is_no_outlier(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    fence = iqr_fences(df, ["x"])["x"]
    assert (fence.q1, fence.q3, fence.low, fence.high) == (1.0, 3.0, -2.0, 6.0)
    probe = spark.createDataFrame([(-2.0,), (6.0,), (-2.1,), (6.1,), (None,)], "x double")
    rows = winsorize(probe, {"x": fence}).collect()
    assert [tuple(r) for r in rows] == [(-2.0, 0), (6.0, 0), (-2.0, 1), (6.0, 1), (None, 0)]


def many_columns(spark, width, rows):
    kinds = [F.rand(1) * 10, F.lit(3.5), (F.col("id") % 7).cast("int"), F.when(F.col("id") % 3 != 0, F.col("id")), (F.col("id") % 11 / 4).cast("decimal(20,2)")]
    kinds += [F.when(F.col("id") % 4 == 0, F.lit(float("nan"))).otherwise(-F.col("id") / 8.0), F.lit(None).cast("double")]
    return spark.range(rows).select(*[kinds[i % len(kinds)].alias(f"c{i}") for i in range(width)])


@pytest.mark.parametrize("rank_rows", [50, 5_000])
def test_parts_ranked_as_rows_agree_with_arrays(spark, monkeypatch, rank_rows):
    df = many_columns(spark, 14, 2_000).repartition(3)
    of = {c: lambda n: [1, max(1, n // 3), max(1, n // 2), n] if n else [] for c in df.columns}
    arrays = selection.order_statistics(df, of, rank_rows)
    monkeypatch.setattr(selection, "TASK_VALUES", 0)
    monkeypatch.setattr(selection, "COLUMNS", 5)
    rows = selection.order_statistics(df, of, rank_rows)
    assert str(rows) == str(arrays) and list(rows) == df.columns  # as text, for NaN
    pandas = df.toPandas()
    for c, (n, found) in rows.items():
        values = sorted((float(v) for v in pandas[c].dropna() if v is not None)) if n and "nan" not in str(found) else []
        for rank, s in zip(of[c](n), found):
            if values:
                assert (float(s.value), s.below, s.equal) == (values[rank - 1], values.index(values[rank - 1]), values.count(values[rank - 1]))


def test_many_parts_never_meet_in_one_task(spark, monkeypatch):
    """Columns of fewer rows than a part may have are still ranked in their own partitions."""
    monkeypatch.setattr(selection, "TASK_VALUES", 10_000)
    df = many_columns(spark, 60, 3_000)
    found = selection.quantiles(df, df.columns, [0.25, 0.75])
    assert found["c2"] == [1, 5] and found["c1"] == [3.5, 3.5] and found["c6"] == [None, None]
    assert found["c3"] == [749, 2249] and len(found) == 60
