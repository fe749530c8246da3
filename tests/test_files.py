"""Headers of many files, one reading of raw rows, one sort for all sinks."""

import csv as plain_csv

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.plans import clean as plan
from tablaris.plans.presets import DOLLAR, GLUCOSE
from tablaris.sources import csv
from tablaris.sources.tables import read_parquet


@pytest.fixture
def folder(tmp_path):
    texts = {
        "a": "﻿\n \nDía,X,x\n1,2,3\n4,5\n\n6,7,8,9\n",
        "b": "x,dia\nq,w\n",
        "c": "",
        "d": "\n\n",
        "e": 'X,Dia,"ne,w"\nu,9,"1,5"\n',
        "f": '"X","Dia","ne,w"\nv,10,\n',
    }
    path = tmp_path / "in"
    path.mkdir()
    for name, text in texts.items():
        (path / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("small", [csv.SMALL_FILE, 4, 20])
def test_layouts_are_found_by_a_job(spark, folder, monkeypatch, small):
    """The same for files read whole and for files of which only the first lines are."""
    monkeypatch.setattr(csv, "SMALL_FILE", small)
    monkeypatch.setattr(csv, "FIRST_LINES", 1)
    found = csv.csv_layouts(spark, folder)
    assert found.headers == [("Día", "X", "x"), ("x", "dia"), ("X", "Dia", "ne,w")]
    assert found.lines == [["Día,X,x"], ["x,dia"], ['X,Dia,"ne,w"', '"X","Dia","ne,w"']]
    assert found.files == [1, 1, 2] and found.table.count() == 4


def test_rows_of_several_layouts(spark, folder):
    rows, header = csv.scan_csv(spark, folder, order="place")
    assert header == ["Día", "X", "x", "ne,w"]
    got = [tuple(r)[:4] for r in rows.orderBy("place").collect()]
    assert got == [
        ("1", "2", "3", None), ("4", "5", None, None), ("6", "7", "8", None), ("w", "q", None, None), ("9", "u", None, "1,5"), ("10", "v", None, None),
    ]


def test_a_schema_is_matched_by_name_where_layouts_differ(spark, folder):
    schema = T.StructType.fromDDL("`NE w` string, dia int, x string, other double")
    rows, header = csv.scan_csv(spark, folder, schema)
    assert header == schema.fieldNames() and rows.schema == schema
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(None, 1, "2", None), (None, 4, "5", None), (None, 6, "7", None), (None, None, "q", None), ("1,5", 9, "u", None), (None, 10, "v", None)], key=str
    )


def test_no_files_with_a_line(spark, tmp_path):
    (tmp_path / "one.csv").write_text("")
    rows, header = csv.scan_csv(spark, str(tmp_path))
    assert header == [] and rows.count() == 0


def day_files(tmp_path, days=400):
    for part in range(4):
        lines = ["day,inflation,interest rate,dollar price"]
        lines += [f"{(d * 37) % days},{d % 9 / 10},4.{d % 7},{'bad' if d % 50 == 0 else 4000 + d}" for d in range(part, days, 4)]
        lines += lines[-2:]  # a repeated day
        (tmp_path / f"part{part}.csv").write_text("\n".join(lines))
    return str(tmp_path)


def test_raw_rows_are_read_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    raw, header = csv.scan_csv(spark, day_files(source))
    result = plan.clean(raw, DOLLAR, header)
    for file in source.iterdir():  # the report does without
        file.write_text("")
    report = result.report().first()
    assert report["filas_raw"] == 408 and report["filas_invalidas_eliminadas"] == 8
    assert report["duplicados_dia_eliminados"] == 8 and report["filas_finales"] == 399


def test_combined_rows_stand_for_all(spark):
    raw = spark.createDataFrame(
        [("40", "30", "2", "100")] * 3 + [("20", "25,5", "9", "90"), ("200", "1", "1", "1"), ("x", None, "3", "95")],
        "Age string, BMI string, `Actividad Física` string, `Glucose Level` string",
    )
    for spec in (GLUCOSE, GLUCOSE.optional("imc")):
        rows = plan.combined(plan.typed_rows(raw, spec, raw.columns), spec).collect()
        assert sorted((r["_valid"], r["_rows"], r["edad"]) for r in rows if r["_valid"]) == [(True, 1, 20), (True, 3, 40)]
        assert [(r["_rows"], r["edad"], r["imc"]) for r in rows if not r["_valid"]] == [(2, None, None)]


def test_both_sinks_come_from_one_sort(spark, tmp_path, monkeypatch):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    plans = []

    def watched(df, path, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        csv.write_csv(df, path, *more)

    monkeypatch.setattr(plan, "write_csv", watched)
    plan.clean_csv(spark, day_files(source), str(out), str(tmp_path / "report"), DOLLAR)
    outside, cached = plans[0].split("InMemoryRelation", 1)
    assert "Exchange" not in outside and "Sort" not in outside
    assert cached.split("Initial Plan")[0].count("Exchange") == 1
    sinks = []
    for kind in ("parquet", "csv"):
        parts = sorted((out / kind).glob(f"part-*.{kind}"))
        assert len(parts) > 1
        days = []
        for part in parts:
            if kind == "csv":
                days += [int(r["dia"]) for r in plain_csv.DictReader(part.open())]
            else:
                days += [r["dia"] for r in read_parquet(spark, str(part)).orderBy(F.col("_metadata.row_index")).collect()]
        sinks.append(days)
    assert sinks[0] == sinks[1] == sorted(sinks[0]) and len(sinks[0]) == 399
