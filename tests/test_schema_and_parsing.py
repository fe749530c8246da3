import pytest
from pyspark.sql import functions as F

from tablaris.functions import normalize_name, parse_double, parse_int
from tablaris.operators.conform import (
    apply_types,
    column_sources,
    conform,
    normalize_columns,
    required_columns,
)
from tablaris.operators.validate import drop_nulls, spec_validity, validity_counts
from tablaris.plans.presets import DOLLAR, ENERGY, GLUCOSE
from tablaris.sources.csv import scan_csv, scan_csv_inferred, write_csv


@pytest.mark.parametrize(
    "header, plain",
    [
        (" Día ", "dia"),
        ("Inflación", "inflacion"),
        ("TASA de  interés", "tasa_de_interes"),
        ("Precio del dólar!", "precio_del_dolar"),
        ("__a--b__", "a_b"),
        ("日本", ""),
    ],
)
def test_normalize_name(header, plain):
    assert normalize_name(header) == plain


def test_messy_headers_reach_canonical_names():
    headers = [" Día ", "Inflación", "TASA de  interés", "Precio del dólar!"]
    assert list(column_sources(headers, DOLLAR.aliases)) == DOLLAR.names


@pytest.mark.parametrize("headers", [["Day", "Dia", "x"], ["Dia", "dia", "x"]])
def test_clashing_headers_keep_the_first(spark, headers):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    out = normalize_columns(df, DOLLAR.aliases, headers)
    assert out.columns == ["dia", "x"]
    assert out.first() == (1, 3)


def test_missing_column_becomes_null_text(spark):
    df = spark.createDataFrame([(" 1 ", "2", "3", "z")], "Day string, t string, `dollar price` string, x string")
    out = conform(df, DOLLAR)
    assert out.columns == DOLLAR.names
    assert out.first() == ("1", None, None, "3")
    assert set(t for _, t in out.dtypes) == {"string"}


def test_required_columns_reports_absent_ones(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    rows = {r["column"]: (r["present"], r["filled"]) for r in required_columns(df, ["a", "b", "c"]).collect()}
    assert rows == {"a": (True, 2), "b": (True, 1), "c": (False, 0)}


INTS = {
    "12.5": 12, "12.": 12, ".5": 0, " 7 ": 7, "+8": 8, "1e3": None, "1d": None, "-3.9": -3,
    "-": None, ".": None, "2147483648": None, "7.x": None, "-0.5": 0, "": None,
}


def test_parse_int(spark):
    df = spark.createDataFrame([(t,) for t in INTS], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", parse_int(F.col("t")).alias("v")).collect()}
    assert got == INTS


def test_decimal_comma(spark):
    df = spark.createDataFrame([("1,5",), ("1.234,5",), (" -2,0 ",)], "t string")
    assert [r[0] for r in df.select(parse_double(F.col("t"))).collect()] == [1.5, None, -2.0]
    assert df.select(parse_double(F.col("t"), decimal_comma=False)).first()[0] is None


def typed(spark, spec, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in spec.names))
    return apply_types(conform(df, spec), spec)


@pytest.mark.parametrize(
    "spec, row, valid",
    [
        (DOLLAR, ("1", "0,1", "2", "3"), True),
        (DOLLAR, ("0", "0,1", "2", "3"), False),
        (DOLLAR, ("1,0", "0,1", "2", "3"), False),
        (DOLLAR, ("1", "NaN", "2", "3"), False),
        (DOLLAR, ("1", "-Infinity", "2", "3"), False),
        (DOLLAR, ("1", "", "2", "3"), False),
        (ENERGY, ("1", "1", "1", "1"), True),
        (ENERGY, ("1", "24,0", "7", "1"), True),
        (ENERGY, ("1", "0", "7", "1"), False),
        (ENERGY, ("1", "25", "7", "1"), False),
        (ENERGY, ("1", "1", "0", "1"), False),
        (ENERGY, ("1", "1", "8", "1"), False),
        (GLUCOSE, ("0", "0.01", "0", "20"), True),
        (GLUCOSE, ("120", "80", "24", "600"), True),
        (GLUCOSE, ("-1", "20", "0", "20"), False),
        (GLUCOSE, ("121", "20", "0", "20"), False),
        (GLUCOSE, ("1", "0", "0", "20"), False),
        (GLUCOSE, ("1", "80.01", "0", "20"), False),
        (GLUCOSE, ("1", "20", "25", "20"), False),
        (GLUCOSE, ("1", "20", "0", "19.99"), False),
        (GLUCOSE, ("1", "20", "0", "600.01"), False),
    ],
)
def test_rule_edges(spark, spec, row, valid):
    counts = validity_counts(typed(spark, spec, [row]), spec_validity(spec)).first()
    assert counts == (1, int(valid), int(not valid))


def test_typed_values_are_parsed_once(spark):
    plan = typed(spark, DOLLAR, [("1", "2", "3", "4")]).where(spec_validity(DOLLAR))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_cast") + text.count("cast(") < 20
    assert "Generate inline" in text


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert drop_nulls(df).collect() == [(3, 4)]
    assert drop_nulls(df, ["a"]).count() == 2


def test_ragged_csv(spark, tmp_path):
    file = tmp_path / "ragged.csv"
    file.write_text("a,b\n1\n2,3\n4,5,6\n,\n\n")
    rows, header = scan_csv(spark, str(file))
    assert header == ["a", "b"]
    assert sorted(rows.collect(), key=str) == sorted(
        [("1", None), ("2", "3"), ("4", "5"), (None, None)], key=str
    )


def test_csv_header_is_kept_as_written(spark, tmp_path):
    file = tmp_path / "clash.csv"
    file.write_text('Dia,dia,"Precio, dólar"\n1,2,3\n')
    rows, header = scan_csv(spark, str(file))
    assert header == ["Dia", "dia", "Precio, dólar"]
    assert rows.first() == ("1", "2", "3")


def test_csv_single_file_and_inferred_types(spark, tmp_path):
    df = spark.range(100).repartition(4).withColumn("half", F.col("id") / 2)
    write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    back = scan_csv_inferred(spark, str(tmp_path / "one"))
    assert [t for _, t in back.dtypes] == ["int", "double"]
    assert back.count() == 100
