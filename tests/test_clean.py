import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablaris.jobs import clean as clean_job
from tablaris.jobs import train as train_job
from tablaris.plans.clean import clean, clean_csv
from tablaris.plans.presets import DOLLAR, ENERGY, GLUCOSE
from tablaris.sources.models import load_models
from tablaris.sources.staging import stage, staged_run, staging_root

DAYS = """ Día ,Inflación,TASA de  interés,Precio del dólar!,extra
1,"0,01",5.0,4000,x
2,0.02,5.1,4100,x
2,0.99,9.9,9999,late copy
6,0.03,5.3,4300,x
7,0.04,5.2,abc,x
8,0.05,5.5,4500,x
-1,0.05,5.5,4500,x
"""


@pytest.fixture
def day_csv(tmp_path):
    file = tmp_path / "days.csv"
    file.write_text(DAYS)
    return str(file)


def test_daily_series_from_file_to_report(spark, day_csv, tmp_path):
    out, rep = str(tmp_path / "out"), str(tmp_path / "report")
    clean_job.main(
        ["--preset", "dolar", "--input", day_csv, "--output", out, "--report", rep, "--single-csv"]
    )
    rows = spark.read.parquet(f"{out}/parquet").orderBy("dia").collect()
    assert rows[0].asDict().keys() == dict.fromkeys(
        "dia inflacion tasa_interes precio_dolar dia_insertado imputado_inflacion "
        "imputado_tasa_interes imputado_precio_dolar outlier_inflacion outlier_tasa_interes "
        "outlier_precio_dolar".split()
    ).keys()
    assert [r["dia"] for r in rows] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [r["dia_insertado"] for r in rows] == [0, 0, 1, 1, 1, 0, 1, 0]
    assert rows[1]["precio_dolar"] == 4100.0
    assert [rows[i]["precio_dolar"] for i in (2, 3, 4)] == [4200.0] * 3
    assert rows[6]["precio_dolar"] == 4400.0
    csv = spark.read.csv(f"{out}/csv", header=True, inferSchema=True)
    assert csv.count() == 8 and csv.columns == list(rows[0].asDict())

    lines = [line for f in (tmp_path / "report").glob("*.json") for line in f.read_text().splitlines()]
    report = json.loads(lines[0])
    assert len(lines) == 1
    assert report["filas_raw"] == report["filas_tipadas"] == 7
    assert report["filas_invalidas_eliminadas"] == 2
    assert report["duplicados_dia_eliminados"] == 1
    assert report["rango_dia"] == {"min": 1, "max": 8}
    assert report["dias_faltantes_rellenados"] == 4
    assert report["nulos_antes_imputacion"]["inflacion"] == 4
    assert set(report["nulos_despues_imputacion"].values()) == {0}
    assert report["imputaciones_por_columna"]["precio_dolar"] == 4
    assert report["filas_finales"] == 8
    limits = report["outliers_iqr"]["precio_dolar"]
    assert limits == {"detectados": 0, "limite_inferior": 3800.0, "limite_superior": 4600.0}
    assert report["input_path"] == day_csv


def test_exact_duplicates_and_outliers_of_readings(spark):
    rows = [("20,0", "5", "1", str(100 + i)) for i in range(20)]
    rows += [("20,0", "5", "1", "100"), ("20", "5", "1", "9000"), ("20", "25", "1", "100")]
    raw = spark.createDataFrame(rows, "Temperature string, Hour string, `day of week` string, `energy_consumption` string")
    result = clean(raw, ENERGY)
    data = result.data.collect()
    assert len(data) == 21
    flagged = [r for r in data if r["outlier_consumo_energia"] == 1]
    fence = result.fences["consumo_energia"]
    assert [r["consumo_energia"] for r in flagged] == [fence.high]
    report = result.report().first()
    assert report["filas_raw"] == 23
    assert report["filas_invalidas_eliminadas"] == 1
    assert report["duplicados_exactos_eliminados"] == 1
    assert "rango_dia" not in report.asDict()
    assert report["outliers_iqr"]["consumo_energia"]["detectados"] == 1


def test_measurements_come_out_sorted(spark):
    raw = spark.createDataFrame(
        [("40", "30", "2", "100"), ("20", "25,5", "9", "90"), ("20", "25", "3", "95")],
        "Age string, BMI string, `Actividad Física` string, `Glucose Level` string",
    )
    got = [(r["edad"], r["actividad_fisica"]) for r in clean(raw, GLUCOSE).data.collect()]
    assert got == [(20, 3), (20, 9), (40, 2)]


@pytest.mark.parametrize("spec", [DOLLAR, ENERGY, GLUCOSE])
def test_nothing_valid_gives_an_empty_table_and_a_report(spark, spec):
    raw = spark.createDataFrame([("1",), ("2",)], "only string")
    result = clean(raw, spec)
    assert result.data.collect() == []
    report = result.report().first()
    assert (report["filas_raw"], report["filas_invalidas_eliminadas"]) == (2, 2)
    assert report["filas_finales"] == 0
    assert report["outliers_iqr"][spec.cap[0]] == (0, None, None)


def test_single_row(spark):
    raw = spark.createDataFrame([("3", "1", "2", "3")], "dia string, inflacion string, tasa_interes string, precio_dolar string")
    row = clean(raw, DOLLAR).data.first()
    assert tuple(row)[:5] == (3, 1.0, 2.0, 3.0, 0)


def test_long_gaps_do_not_depend_on_slicing(spark):
    rows = spark.range(2_000).where("id % 5 <> 0 AND id NOT BETWEEN 300 AND 900").select(
        F.col("id").cast("string").alias("dia"),
        (F.col("id") * 37 % 101).cast("string").alias("inflacion"),
        (F.col("id") % 13).cast("string").alias("tasa_interes"),
        (F.col("id") * F.col("id")).cast("string").alias("precio_dolar"),
    )
    plain = clean(rows, DOLLAR)
    sliced = clean(rows, DOLLAR, window_rows=150)
    assert plain.data.collect() == sliced.data.collect()
    assert plain.data.count() == 1_999


def test_capped_values_stay_within_the_limits(spark):
    rows = spark.range(1, 500).select(
        F.col("id").cast("string").alias("dia"),
        F.pow(F.col("id") % 97, F.lit(3)).cast("string").alias("inflacion"),
        F.lit("1").alias("tasa_interes"),
        F.exp(F.col("id") % 40).cast("string").alias("precio_dolar"),
    )
    result = clean(rows, DOLLAR)
    for c in DOLLAR.cap:
        low, high = result.data.agg(F.min(c), F.max(c)).first()
        assert result.fences[c].low <= low and high <= result.fences[c].high
    assert result.report().first()["outliers_iqr"]["precio_dolar"]["detectados"] > 0


def test_training_job(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 1.0D AS x", "id % 7 AS z", "3.0D * id - (id % 7) AS y").write.parquet(str(tmp_path / "in"))
    train_job.main(
        ["--input", str(tmp_path / "in"), "--features", "x,z", "--label", "y", "--keys", "id", "--name", "m",
         "--model-out", str(tmp_path / "m"), "--summary-out", str(tmp_path / "s")]
    )
    model = load_models(spark, str(tmp_path / "m"), ["m"])["m"]
    assert model.coefficients == pytest.approx((3, -1))
    assert spark.read.parquet(str(tmp_path / "s")).where("metric = 'r2'").first()["value"] == pytest.approx(1)


def test_a_run_deletes_what_it_staged_and_nothing_else(spark):
    hadoop = spark._jvm.org.apache.hadoop.fs

    def there(df) -> bool:
        folder = hadoop.Path(path[df].rsplit("/", 1)[0])
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)

    path = {}
    outside = stage(spark.range(10), "trial")
    path[outside] = outside.inputFiles()[0]
    assert staging_root(spark).removeprefix("file:") in path[outside]
    with staged_run(spark):
        outer = stage(spark.range(10), "trial")
        path[outer] = outer.inputFiles()[0]
        with pytest.raises(ZeroDivisionError), staged_run(spark):
            inner = stage(spark.range(10), "trial")
            path[inner] = inner.inputFiles()[0]
            assert there(inner)
            1 / 0
        assert not there(inner) and there(outer)
    assert not there(outer) and there(outside)


def test_optional_fields_are_imputed_in_their_group(spark):
    raw = spark.createDataFrame(
        [("20", "1", "1", "5"), ("x", "2", "1", "6"), ("30", "3", "1", None), ("n/a", "1", "2", "7"), ("10", "99", "2", "8")],
        "Temperature string, HOUR string, day_of_week string, energy_consumption string",
    )
    result = clean(raw, ENERGY.optional("temperatura", "consumo_energia"))
    rows = {(r.dia_semana, r.hora): r for r in result.data.collect()}
    assert set(rows) == {(1, 1), (1, 2), (1, 3), (2, 1)}  # hour 99 breaks a rule of a required field
    assert (rows[1, 2].temperatura, rows[1, 2].imputado_temperatura, rows[1, 3].consumo_energia) == (25.0, 1, 6.0)
    assert (rows[2, 1].temperatura, rows[1, 1].imputado_temperatura) == (20.0, 0)  # no neighbour: the table's median
    report = result.report().first()
    assert report["imputaciones_por_columna"] == {"temperatura": 2, "consumo_energia": 1}
    assert report[ENERGY.labels.nulls_before] == {"temperatura": 2, "consumo_energia": 1}
    strict = clean(raw, ENERGY)
    assert strict.data.count() == 1


def test_gaps_and_groups_exclude_each_other(spark):
    with pytest.raises(ValueError, match="exclude"):
        clean(spark.createDataFrame([("1",)], "dia string"), replace(DOLLAR, group_by=("dia",)))


# FIXED VALUES: published limits and outlier counts of the daily series.
PUBLISHED = {
    "inflacion": (0.006469943659148013, 0.033189385983055285, 4),
    "tasa_interes": (3.7573676331362282, 6.265740362485191, 5),
    "precio_dolar": (2771.1235828138233, 7650.911674994488, 0),
}


@pytest.mark.skipif("TABLARIS_GOLDEN_CSV" not in os.environ, reason="needs the published series")
@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_published_limits(spark, tmp_path, mode):
    """The seven published figures: three pairs of limits' outlier counts and the rows."""
    clean_csv(spark, os.environ["TABLARIS_GOLDEN_CSV"], str(tmp_path / "out"), str(tmp_path / "report"), DOLLAR, quantile_mode=mode)
    report = spark.read.json(str(tmp_path / "report")).first()
    for column, (low, high, count) in PUBLISHED.items():
        found = report[DOLLAR.labels.outliers][column]
        assert (found[DOLLAR.labels.low_limit], found[DOLLAR.labels.high_limit]) == pytest.approx((low, high), rel=1e-12)
        assert found[DOLLAR.labels.detected] == count
    assert report[DOLLAR.labels.final_rows] == 500
