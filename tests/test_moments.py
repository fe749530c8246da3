import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablaris.operators.impute import impute
from tablaris.operators.moments import PairMoments, pair_moments
from tablaris.operators.ordering import neighbours, row_positions
from tablaris.operators.regression import fit
from tablaris.operators.stats import correlation_matrix, describe
from tablaris.operators.tiles import TileMoments, correlation_table


def known_pairs(x):
    known = ~np.isnan(x)
    return [[np.flatnonzero(known[:, i] & known[:, j]) for j in range(x.shape[1])] for i in range(x.shape[1])]


def test_moments_of_parts_merge_to_those_of_the_whole():
    pick = np.random.default_rng(1)
    x = pick.normal(1e6, 2, (200, 4))
    x[pick.random((200, 4)) < 0.3] = np.nan
    x[:50, 0] = np.nan  # a part without any row for some pairs
    parts = [PairMoments.of(x[a : a + 50], ~np.isnan(x[a : a + 50])) for a in range(0, 200, 50)]
    total = parts[0]
    for p in parts[1:]:
        total = total.merge(p)
    for i, row in enumerate(known_pairs(x)):
        for j, at in enumerate(row):
            a, b = x[at, i], x[at, j]
            assert total.n[i, j] == len(at)
            assert total.mean[i, j] == pytest.approx(a.mean())
            assert total.joint[i, j] == pytest.approx(((a - a.mean()) * (b - b.mean())).sum(), rel=1e-6, abs=1e-6)


def test_wide_correlations_equal_numpy(spark):
    width = 100
    rows = spark.range(5000).select(*[(F.rand(i) + F.col("id") % (i + 2)).alias(f"c{i}") for i in range(width)]).cache()
    x = np.array(rows.collect())
    r = np.corrcoef(x.T)
    for row in correlation_matrix(rows, rows.columns).collect():
        assert row.r == pytest.approx(r[int(row.variable_a[1:]), int(row.variable_b[1:])], abs=1e-9)


def test_pairwise_nulls_flat_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, None, 3.0), (3.0, 5.0, 3.0), (None, 1.0, 3.0), (4.0, 6.0, None)], "a double, b double, flat double")
    got = {(r.variable_a, r.variable_b): r.r for r in correlation_matrix(df, df.columns).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 6])[0, 1])
    assert got["a", "flat"] is None and got["flat", "flat"] is None and got["a", "a"] == pytest.approx(1)
    assert {r.r for r in correlation_matrix(df.limit(0), df.columns).collect()} == {None}
    assert pair_moments(df.limit(0), df.columns) == {}


def test_moments_by_value(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("int").alias("k"))
    found = pair_moments(df, ["x"], "k")
    assert set(found) == {0, 1, 2} and sum(m.n[0, 0] for m in found.values()) == 1000
    assert fit(df.withColumn("y", 3 * F.col("x") + 1), ["x"], "y").coefficients[0] == pytest.approx(3)


TIED = [(1, 1, "a", 10.0), (1, 1, "b", None), (1, 1, "c", 20.0), (1, 2, "a", 40.0), (1, 2, "b", None), (1, 3, "a", None)]


@pytest.mark.parametrize("window_rows", [1_000_000, 2])
def test_tied_rows_have_the_same_neighbours_in_any_layout(spark, window_rows):
    seen = set()
    for rows in (TIED, TIED[::-1], [*TIED[3:], *TIED[:3]]):
        df = spark.createDataFrame(rows, "g int, o int, name string, x double").repartition(3)
        out = neighbours(df, ["x"], ["o"], ["g"], window_rows=window_rows)
        seen.add(tuple(sorted((r.o, r.name, r._prev_x, r._next_x) for r in out.where("x IS NULL").collect())))
    assert seen == {((1, "b", 10.0, 20.0), (2, "b", 40.0, None), (3, "a", 40.0, None))}
    positions = row_positions(spark.createDataFrame(TIED[::-1], "g int, o int, name string, x double"), ["o"], ["g"], window_rows=window_rows)
    assert [r.name for r in positions.orderBy("position").collect()] == ["a", "b", "c", "a", "b", "a"]


def test_imputing_tied_rows(spark):
    df = spark.createDataFrame(TIED[::-1], "g int, o int, name string, x double")
    got = {(r.o, r.name): r.x for r in impute(df, ["x"], ["o"], ["g"]).collect()}
    assert (got[1, "b"], got[2, "b"], got[3, "a"]) == (15.0, 40.0, 40.0)


def test_describe_decimals(spark):
    df = spark.createDataFrame([("1.25",), ("2.50",), (None,), ("4.00",)], "t string").select(F.col("t").cast("decimal(38,2)").alias("d"))
    row = describe(df, ["d"]).first()
    assert (row["count"], row["min"], row["q50"], row["max"]) == (3, 1.25, 2.5, 4.0) and row["q25"] == pytest.approx(1.875)


def test_tiles_of_parts_merge_to_those_of_the_whole():
    pick = np.random.default_rng(2)
    x, y = pick.normal(1e6, 2, (200, 3)), pick.normal(-5, 9, (200, 4))
    for m in (x, y):
        m[pick.random(m.shape) < 0.3] = np.nan
    x[:50, 0] = np.nan
    parts = [TileMoments.of(x[a : a + 50], ~np.isnan(x[a : a + 50]), y[a : a + 50], ~np.isnan(y[a : a + 50])) for a in range(0, 200, 50)]
    total = parts[0]
    for p in parts[1:]:
        total = total.merge(p)
    for i in range(3):
        for j in range(4):
            at = ~np.isnan(x[:, i]) & ~np.isnan(y[:, j])
            assert total.n[i, j] == at.sum()
            assert total.correlations()[i, j] == pytest.approx(np.corrcoef(x[at, i], y[at, j])[0, 1], rel=1e-6)


def test_tiles_equal_the_whole_matrix(spark):
    df = spark.range(400).select(
        *[F.when((F.col("id") + i) % 4 != 0, F.rand(i) + F.col("id") % (i + 2)).alias(f"c.{i}") for i in range(11)],
        F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("none"),
    ).repartition(5)
    want = {(r.variable_a, r.variable_b): r.r for r in correlation_matrix(df.toDF(*[c.replace(".", "_") for c in df.columns]), [c.replace(".", "_") for c in df.columns]).collect()}
    for block, tasks, stripe in ((4, 2, 3), (13, 1, 1), (100, 8, 32), (1, 3, 1)):
        got = {(r.variable_a.replace(".", "_"), r.variable_b.replace(".", "_")): r.r for r in correlation_table(df, df.columns, block, tasks, stripe).collect()}
        assert got == {k: None if v is None else pytest.approx(v, abs=1e-9) for k, v in want.items()}
    assert {r.r for r in correlation_table(df.limit(0), df.columns, 4).collect()} == {None}


def test_three_thousand_columns(spark, tmp_path):
    """The matrix is a table; only what is asked of it comes to the driver."""
    width = 3000
    x = np.random.default_rng(4).integers(0, 1000, (200, width)).astype(float)
    x[:, 7] = x[:, 5] * 2 + 1
    pq.write_table(pa.table({f"c{i}": x[:, i] for i in range(width)}), str(tmp_path / "wide.parquet"))
    df = spark.read.parquet(str(tmp_path / "wide.parquet"))
    rows = correlation_matrix(df, df.columns).where("variable_a IN ('c5', 'c2999')").collect()
    assert len(rows) == 2 * width
    r = np.corrcoef(x.T)
    for row in rows:
        assert row.r == pytest.approx(r[int(row.variable_a[1:]), int(row.variable_b[1:])], abs=1e-9)
    assert [row.r for row in rows if (row.variable_a, row.variable_b) == ("c5", "c7")] == [pytest.approx(1.0)]
