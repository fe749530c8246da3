import pytest
from pyspark.sql import functions as F

from tablaris.operators.regression import LinearModel
from tablaris.operators.scoring import bind_features, score_named, score_requests
from tablaris.plans.presets import EXERCISES, MESSAGES
from tablaris.plans.score import score_with_stored_models
from tablaris.sources.models import ModelError, load_models, read_model_table, save_models
from tablaris.streaming.row_local import write_stream

DOLAR = LinearModel(("dia", "Inflación", "Tasa Interes"), "precio_dolar", 10.0, (1.0, 2.0, 4.0), "dolar")
GLUCOSA = LinearModel(("edad", "humedad"), "nivel_glucosa", 0.0, (1.0, 1.0), "glucosa")
GOOD = {"dia": "15", "inflacion": " 0.5 ", "tasa_interes": "1e1"}
SCHEMA = "request_id long, exercise string, fields map<string,string>"


def answer(spark, exercise, fields):
    requests = spark.createDataFrame([(1, exercise, fields)], SCHEMA)
    return score_requests(requests, EXERCISES, {"dolar": DOLAR, "glucosa": GLUCOSA}, MESSAGES).first()


def test_good_request(spark):
    row = answer(spark, " dolar ", GOOD)
    assert row["error"] is None
    assert row["title"] == "Prediccion del precio del dolar"
    assert (row["model"], row["target"]) == ("dolar", "precio_dolar")
    assert (row["value"], row["value_text"]) == (66.0, "66.00")


@pytest.mark.parametrize(
    "exercise, fields, error",
    [
        ("euro", GOOD, "Debes seleccionar un ejercicio valido."),
        (None, GOOD, "Debes seleccionar un ejercicio valido."),
        ("dolar", {}, "El campo 'Dia' es obligatorio."),
        ("dolar", None, "El campo 'Dia' es obligatorio."),
        ("dolar", {**GOOD, "dia": "  "}, "El campo 'Dia' es obligatorio."),
        ("dolar", {**GOOD, "inflacion": "abc"}, "El campo 'Inflacion' debe ser numerico."),
        ("dolar", {"dia": "abc"}, "El campo 'Dia' debe ser numerico."),
        ("dolar", {**GOOD, "tasa_interes": None}, "El campo 'Tasa de interes' es obligatorio."),
        ("dolar", {**GOOD, "dia": "NaN"}, "No se pudo realizar la prediccion: NaN"),
        (
            "glucosa",
            {"edad": "1", "imc": "2", "actividad_fisica": "3"},
            "No se pudieron mapear variables del modelo: humedad",
        ),
        (
            "energia",
            {"temperatura": "1", "hora": "2", "dia_semana": "3"},
            "No se encontro el archivo del modelo: energia",
        ),
        ("energia", {"temperatura": "x"}, "El campo 'Temperatura' debe ser numerico."),
    ],
)
def test_first_failure_is_reported(spark, exercise, fields, error):
    row = answer(spark, exercise, fields)
    assert row["error"] == error
    assert row["value"] is None and row["title"] is None


def test_requests_are_not_shuffled(spark):
    requests = spark.range(10).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") > 3, "dolar").otherwise("euro").alias("exercise"),
        F.create_map(F.lit("dia"), F.lit("1")).alias("fields"),
    )
    out = score_requests(requests, EXERCISES, {"dolar": DOLAR}, MESSAGES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_named_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "`DIA ` double, `inflación!` double, tasa_interes double")
    out = score_named(df, DOLAR)
    assert out.columns == [*df.columns, "prediction"]
    assert out.first()["prediction"] == 10 + 1 + 4 + 12
    with pytest.raises(ValueError, match="humedad"):
        bind_features(df.withColumn("edad", F.lit(1)), GLUCOSA)


def test_models_survive_storage(spark, tmp_path):
    path = str(tmp_path / "models")
    save_models(spark, [DOLAR, GLUCOSA], path)
    assert load_models(spark, path, ["dolar", "glucosa", "absent"]) == {"dolar": DOLAR, "glucosa": GLUCOSA}
    requests = spark.createDataFrame([(1, "dolar", GOOD)], SCHEMA)
    assert score_with_stored_models(spark, requests, path, EXERCISES, MESSAGES).first()["value"] == 66.0


def test_bad_model_tables_are_refused(spark, tmp_path):
    with pytest.raises(ModelError):
        load_models(spark, str(tmp_path / "nowhere"), ["a", "dolar", "m", "x"])
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ModelError, match="lacks"):
        load_models(spark, str(tmp_path / "other"), ["a", "dolar", "m", "x"])
    save_models(spark, [DOLAR], str(tmp_path / "whole"))
    holed = read_model_table(spark, str(tmp_path / "whole")).where("position <> 1")
    holed.write.parquet(str(tmp_path / "holed"))
    with pytest.raises(ModelError, match="incomplete"):
        load_models(spark, str(tmp_path / "holed"), ["a", "dolar", "m", "x"])


def test_stream_of_requests(spark, tmp_path):
    requests = spark.range(200).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 3 == 0, "euro").otherwise("dolar").alias("exercise"),
        F.create_map(
            F.lit("dia"), F.col("id").cast("string"), F.lit("inflacion"), F.lit("1"),
            F.lit("tasa_interes"), F.lit("2"),
        ).alias("fields"),
    )
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    requests.repartition(4).write.parquet(source)

    def score(df):
        return score_requests(df, EXERCISES, {"dolar": DOLAR}, MESSAGES)

    stream = spark.readStream.schema(requests.schema).parquet(source)
    write_stream(stream, score, sink, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(sink)
    assert sorted(got.collect(), key=str) == sorted(score(requests).collect(), key=str)
