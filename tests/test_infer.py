import pytest
from pyspark.sql import functions as F

from tablaris.operators.infer import infer_types, with_types
from tablaris.operators.ordering import neighbours
from tablaris.sources.csv import scan_csv_inferred

CASES = {
    "int": ["1", " -7 ", None, "+2147483647", "000000000000000000000000000000000000000000000000012"],
    "bigint": ["1", "2147483648", ""],
    "decimal(20,0)": ["12345678901234567890", "0", "-1"],
    "double": ["1", "1.5", ".5", "2.", "1e3", "-Infinity", "nan", "12345678901234567890"],
    "double ": ["9" * 39, "1"],
    "date": ["2024-02-29", None, " 1999-12-31"],
    "timestamp": ["2024-02-29", "2024-02-29 10:11", "2024-02-29T10:11:12.123456Z"],
    "boolean": ["true", "FALSE", " True"],
    "string": ["1", "x"],
    "string ": [None, "", " \t "],
    "string  ": ["2023-02-29"],
    "string   ": ["1", "true"],
    "string    ": ["2024-01-01", "5"],
    "string     ": ["1d", "1"],
    "string      ": ["1,5"],
}


def test_types(spark):
    for want, values in CASES.items():
        df = spark.createDataFrame([(v, 1) for v in values], "`a.b c` string, n int").repartition(3)
        row = infer_types(df, ["a.b c"]).first()
        filled = sum(v is not None and v.strip() != "" for v in values)
        assert (row["position"], row["column"], row["type"], row["filled"], row["empty"]) == (0, "a.b c", want.strip(), filled, len(values) - filled), want


def test_an_empty_table_is_text(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert [tuple(r) for r in infer_types(df).collect()] == [(0, "a", "string", 0, 0), (1, "b", "string", 0, 0)]


def test_one_aggregate(spark):
    plan = infer_types(spark.createDataFrame([("1", "x")], "a string, b string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Exchange SinglePartition" in plan


def test_columns_are_read_as_their_types(spark):
    df = spark.createDataFrame([(" 1", "2024-02-29", "", "x "), ("2", None, "12345678901234567890", " y")], "a string, d string, big string, t string")
    out = with_types(df, infer_types(df))
    assert [t for _, t in out.dtypes] == ["int", "date", "decimal(20,0)", "string"]
    assert [str(v) for v in out.first()] == ["1", "2024-02-29", "None", "x "]


def test_csv_of_two_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Day,Price,day\n1,2.5,x\n2,,y\n")
    (tmp_path / "b.csv").write_text("price,day\n1e2,3000000000\n")
    out = scan_csv_inferred(spark, str(tmp_path))
    assert dict(out.dtypes) == {"Day": "bigint", "Price": "double", "day_2": "string"}
    assert sorted(map(str, map(tuple, out.collect()))) == ["(1, 2.5, 'x')", "(2, None, 'y')", "(3000000000, 100.0, None)"]


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_both_neighbours_come_from_one_sort(spark, groups):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("x"), F.when(F.col("id") % 9 == 1, -F.col("id")).alias("y"), "id")
    out = neighbours(df, ["x", "y"], ["id"], groups)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    assert out._jdf.queryExecution().sparkPlan().toString().count("Sort [") <= 1
    rows = [r.asDict() for r in df.collect()]
    for r in out.collect():
        own = sorted((o for o in rows if not groups or o["g"] == r["g"]), key=lambda o: o["id"])
        for c in ("x", "y"):
            before = [o[c] for o in own if o["id"] <= r["id"] and o[c] is not None]
            after = [o[c] for o in own if o["id"] >= r["id"] and o[c] is not None]
            assert (r[f"_prev_{c}"], r[f"_next_{c}"]) == (before[-1] if before else None, after[0] if after else None)
