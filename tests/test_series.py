import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablaris.operators import ordering
from tablaris.operators.dedup import drop_exact, ingest_order, keep_first
from tablaris.operators.gapfill import fill_gaps, fill_gaps_per_entity, key_bounds
from tablaris.operators.impute import impute
from tablaris.operators.ordering import _slices, cut_by_rank, neighbours, row_positions, slice_count, total_order
from tablaris.sources.staging import stage


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, seq int, v string")
    assert sorted(keep_first(df, ["k"], ["seq"]).collect()) == [(1, 1, "a"), (2, 5, "c")]


def test_first_row_is_chosen_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = physical(keep_first(df, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan


def test_ingest_order_follows_the_file(spark, tmp_path):
    file = tmp_path / "rows.csv"
    file.write_text("k,v\n" + "".join(f"{i % 5},{i}\n" for i in range(100)))
    df = spark.read.csv(str(file), header=True).withColumn("o", ingest_order())
    got = {r["k"]: r["v"] for r in keep_first(df, ["k"], ["o"]).collect()}
    assert got == {str(i): str(i) for i in range(5)}


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, v string")
    assert drop_exact(df).count() == 3


def test_gaps_take_the_mean_of_their_neighbours(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (6, 4.0), (7, 7.0), (10, 9.0)], "day int, x double")
    dense = fill_gaps(df, "day")
    assert dense.count() == 10
    assert dense.agg(F.sum("inserted")).first()[0] == 5
    got = {r["day"]: (r["x"], r["imputed_x"]) for r in impute(dense, ["x"], ["day"]).collect()}
    assert [got[d] for d in (3, 4, 5)] == [(3.0, 1)] * 3
    assert [got[d] for d in (8, 9)] == [(8.0, 1)] * 2
    assert got[6] == (4.0, 0)


def test_gap_fill_on_dates_and_empty_tables(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28), 1.0), (dt.date(2024, 3, 2), 2.0)], "day date, x double")
    days = [r["day"] for r in fill_gaps(df, "day").orderBy("day").collect()]
    assert days == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    empty = df.where("false")
    assert fill_gaps(empty, "day").collect() == []
    assert key_bounds(empty, "day").first() == (None, None)


def test_gap_fill_per_entity_with_long_ranges_and_null_entity(spark):
    rows = [("a", 1, 1.0), ("a", 10_000, 2.0), ("b", 5, 3.0), (None, 2, 4.0), (None, 4, 5.0)]
    df = spark.createDataFrame(rows, "e string, day int, x double")
    out = fill_gaps_per_entity(df, ["e"], "day")
    counts = {r["e"]: (r["n"], r["i"]) for r in out.groupBy("e").agg(F.count("*").alias("n"), F.sum("inserted").alias("i")).collect()}
    assert counts == {"a": (10_000, 9_998), "b": (1, 0), None: (3, 1)}
    assert out.where("x is not null").count() == 5


def test_edges_use_the_one_neighbour(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None)], "day int, x double")
    assert [r["x"] for r in impute(df, ["x"], ["day"]).orderBy("day").collect()] == [5.0] * 3


def test_group_without_values_takes_the_global_median(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 4.0), ("a", 4, 9.0), ("b", 1, None), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g string, o int, x double")
    out = {(r["g"], r["o"]): r["x"] for r in impute(df, ["x"], ["o"], ["g"]).collect()}
    assert out["a", 2] == 2.5
    assert out["b", 1] == out["b", 2] == 4.0


def test_column_without_any_value_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "day int, x double")
    assert [r["x"] for r in impute(df, ["x"], ["day"]).collect()] == [None, None]


def test_known_values_are_left_alone_and_cost_no_window(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "day int, x double")
    out = impute(df, ["x"], ["day"])
    assert "Window" not in physical(out)
    assert sorted(out.collect()) == [(1, 1.0, 0), (2, 2.0, 0)]


def test_total_order_extends_the_order(spark):
    df = spark.createDataFrame([], "g int, o int, a double, b double")
    assert total_order(df, ["o"], ["g"]) == ["o", "a", "b"]


@pytest.fixture(scope="module")
def hot_groups(spark):
    """One group with most rows, one tiny, one NULL; long runs without values."""
    rng = random.Random(2)
    rows = []
    for i in range(3_000):
        g = "hot" if i % 3 else rng.choice(["a", None, f"g{i % 40}"])
        x = None if rng.random() < 0.5 or 900 < i < 2_100 else float(i)
        rows.append((g, i // 4, i, x, None if g == "hot" and i < 2_990 else float(-i)))
    return spark.createDataFrame(rows, "g string, o int, id int, x double, y double").repartition(5)


def test_sliced_neighbours_equal_the_plain_window(hot_groups):
    order = ["o", "id"]
    plain = neighbours(hot_groups, ["x", "y"], order, ["g"]).collect()
    sliced = neighbours(hot_groups, ["x", "y"], order, ["g"], window_rows=100)
    assert "_slice" not in sliced.columns
    assert "SinglePartition" not in physical(sliced).split("BroadcastExchange")[0]
    assert sorted(sliced.collect(), key=str) == sorted(plain, key=str)


def test_sliced_neighbours_without_groups(hot_groups):
    plain = neighbours(hot_groups, ["x"], ["id"]).collect()
    sliced = neighbours(hot_groups, ["x"], ["id"], window_rows=70).collect()
    assert sorted(sliced, key=str) == sorted(plain, key=str)


def test_slices_do_not_grow_with_the_rows_of_a_large_table(spark, hot_groups):
    assert slice_count(60_000, 10_000, 200) == 6
    assert slice_count(216_000_000, 10_000, 200) == slice_count(36_000_000, 500, 200) == 256
    assert slice_count(36_000_000, 500, 1_000) == 1_000
    assert slice_count(10**9, 500, 200) == slice_count(10**9, 1_000_000, 200) == 1_000
    staged = _slices(hot_groups, [], ["id"], 3_000, 2)
    held = staged.groupBy("_slice").agg(F.min("id").alias("first"), F.max("id").alias("last")).orderBy("_slice").collect()
    assert 2 <= len(held) <= 256 and staged.count() == 3_000
    assert all(a["last"] < b["first"] for a, b in zip(held, held[1:]))


def test_tied_rows_in_many_small_slices(spark, monkeypatch):
    rows = spark.range(2_500).select("id", (F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("o"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("x"))
    staged = []
    monkeypatch.setattr(ordering, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    plain = impute(rows, ["x"], ["o"], ["g"])
    sliced = impute(rows, ["x"], ["o"], ["g"], window_rows=2)
    assert sorted(sliced.collect()) == sorted(plain.collect())
    assert len(staged) == 1 and len(staged[0].inputFiles()) <= 256


@pytest.mark.parametrize("group_by", [[], ["g"]])
def test_sliced_positions_equal_the_plain_ones(hot_groups, group_by):
    plain = row_positions(hot_groups, ["o", "id"], group_by).collect()
    sliced = row_positions(hot_groups, ["o", "id"], group_by, window_rows=90).collect()
    assert sorted(sliced, key=str) == sorted(plain, key=str)


def test_imputation_does_not_depend_on_slicing(hot_groups):
    args = (["x", "y"], ["o", "id"], ["g"])
    plain = impute(hot_groups, *args).collect()
    sliced = impute(hot_groups, *args, window_rows=120).collect()
    assert sorted(sliced, key=str) == sorted(plain, key=str)


@pytest.mark.parametrize("window_rows", [50, 1_000_000])
def test_rank_cuts_split_ties_by_the_later_columns(spark, window_rows):
    rows = [(7 if i % 3 == 0 else i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "lead int, id int").repartition(3)
    ranks = [0, 5, 100, 250, 600, 900]
    out = cut_by_rank(df, ["lead", "id"], lambda n: ranks, "bin", window_rows, rank_rows=10)
    got = {r["id"]: r["bin"] for r in out.collect()}
    for position, (_, i) in enumerate(sorted(rows), 1):
        assert got[i] == sum(position > r for r in ranks)


def test_clean_rank_cut_needs_no_shuffle(spark):
    df = spark.range(1_000)
    out = cut_by_rank(df, ["id"], lambda n: [n // 2], "bin")
    assert "Exchange" not in physical(out)
    assert out.groupBy("bin").count().count() == 2


def test_rank_cut_through_an_unordered_tie_is_an_error(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(ValueError):
        cut_by_rank(df, ["id"], lambda n: [1], "bin")


def test_rows_without_a_place_are_kept(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4)], "lead int, id int")
    out = cut_by_rank(df, ["lead", "id"], lambda n: [1], "bin")
    assert {r["id"]: r["bin"] for r in out.collect()} == {1: 0, 2: 1, 3: 1, 4: None}
