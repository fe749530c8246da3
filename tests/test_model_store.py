"""Versions of stored models, and requests scored by tables of models."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablaris.functions.parse import trimmed
from tablaris.operators import scoring
from tablaris.operators.regression import LinearModel, fit
from tablaris.plans.presets import EXERCISES, MESSAGES
from tablaris.plans.score import score_with_many_models, score_with_stored_models
from tablaris.sources import models as store

A = LinearModel(("x", "Z é"), "y", 1.5, (2.0, -3.0), "a", display="Shown", fitted_at=datetime(2024, 5, 1, 12))
B = LinearModel(("x",), "y", 0.0, (1.0,), "b", rank_deficient=True)
SCHEMA = "request_id long, exercise string, fields map<string,string>"


def test_versions(spark, tmp_path):
    path = str(tmp_path / "m")
    assert store.save_models(spark, [A, B], path) == 1
    assert store.save_models(spark, [replace(A, intercept=9.0), replace(B, name="c")], path) == 2
    assert store.load_models(spark, path, ["a", "b", "c"], 1) == {"a": A, "b": B}
    latest = store.load_models(spark, path, ["a", "b", "c", "d"])
    assert latest == {"a": replace(A, intercept=9.0), "b": B, "c": replace(B, name="c")}
    assert latest["a"].display == "Shown" and latest["a"].fitted_at == A.fitted_at and latest["b"].rank_deficient
    versions = {r["model"]: r["version"] for r in store.stored_models(spark, path).collect()}
    assert versions == {"a": 2, "b": 1, "c": 2}
    terms = store.read_model_table(spark, path, 1).where("model = 'a'").orderBy("position").select(*store.REQUIRED).collect()
    assert [tuple(t) for t in terms] == [("a", "y", "intercept", 0, 1.5), ("a", "y", "x", 1, 2.0), ("a", "y", "Z é", 2, -3.0)]
    assert store.load_models(spark, path, [], 1) == {} and store.stored_models(spark, path, 0).count() == 0


def test_a_save_that_fails_leaves_what_was_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    store.save_models(spark, [A], path)

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(store, "publish", broken)
        with pytest.raises(OSError):
            store.save_models(spark, [replace(A, intercept=7.0), B], path)
    assert store.load_models(spark, path, ["a", "b"]) == {"a": A}
    assert store.save_models(spark, [B], path) == 2
    assert store.load_models(spark, path, ["a", "b"]) == {"a": A, "b": B}


def test_a_first_save_that_fails_is_no_store(spark, tmp_path):
    store.packed(spark, [A]).write.parquet(f"{tmp_path}/m/models/run=x")
    with pytest.raises(store.ModelError):
        store.load_models(spark, f"{tmp_path}/m", ["a"])


def test_one_row_a_term_is_read_too(spark, tmp_path):
    path = str(tmp_path / "plain")
    store.save_models(spark, [A, B], str(tmp_path / "m"))
    store.read_model_table(spark, str(tmp_path / "m")).select(*store.REQUIRED).write.parquet(path)
    assert store.load_models(spark, path, ["a", "b"]) == {"a": replace(A, display=""), "b": replace(B, rank_deficient=False)}


def test_the_name_filter_reaches_the_scan(spark, tmp_path):
    store.save_models(spark, [A, B], str(tmp_path / "m"))
    wanted = store.stored_models(spark, str(tmp_path / "m")).where(F.col("model").isin("a"))
    assert "EqualTo(model,a)" in wanted._jdf.queryExecution().executedPlan().toString()


def test_fitted_models_know_when(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "x double, y double")
    model = fit(rows, ["x"], "y")
    assert isinstance(model.fitted_at, datetime) and model == replace(model, fitted_at=None)


def mixed_requests(spark, hot=40):
    good = {"dia": "1", "inflacion": "2", "tasa_interes": "3"}
    rows = [(i, " dolar", good) for i in range(hot)]
    rows += [(100, "euro", good), (101, None, good), (102, "dolar", {}), (103, "dolar", None), (104, "dolar", {**good, "dia": "x"})]
    rows += [(105, "glucosa", {"edad": "1", "imc": "2", "actividad_fisica": "3"}), (106, "energia", {"temperatura": "1", "hora": "2", "dia_semana": "3"})]
    rows += [(107, "dolar", {**good, "dia": "NaN"}), (100, "euro", good)]
    return spark.createDataFrame(rows, SCHEMA)


MODELS = {
    "dolar": LinearModel(("dia", "Inflación", "Tasa Interes"), "", 10.0, (1.0, 2.0, 4.0), "dolar", display="Dollar"),
    "glucosa": LinearModel(("edad", "humedad", "viento"), "nivel_glucosa", 0.0, (1.0, 1.0, 2.0), "glucosa"),
}


@pytest.mark.parametrize("salts", [1, 4, 32])
@pytest.mark.parametrize("hot", [0, 40])
def test_tables_of_models_answer_as_few_models_do(spark, tmp_path, salts, hot):
    asked = mixed_requests(spark, hot)
    want = scoring.score_requests(asked, EXERCISES, MODELS, MESSAGES)
    got = scoring.score_with_models(asked, scoring.catalogue(spark, EXERCISES), store.packed(spark, list(MODELS.values())), MESSAGES, salts)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert scoring.score_with_models(asked.limit(0), scoring.catalogue(spark, EXERCISES), store.packed(spark, []), MESSAGES).collect() == []


def test_stored_models_keep_their_display_name(spark, tmp_path):
    path = str(tmp_path / "m")
    store.save_models(spark, list(MODELS.values()), path)
    store.save_models(spark, [replace(MODELS["dolar"], display="Newer", intercept=11.0)], path)
    asked = mixed_requests(spark, 1).where("request_id = 0")
    plain = [score_with_stored_models(spark, asked, path, EXERCISES, MESSAGES, v).first() for v in (1, None)]
    many = [score_with_many_models(spark, asked, path, scoring.catalogue(spark, EXERCISES), MESSAGES, v).first() for v in (1, None)]
    assert plain == many
    assert [(r["model"], r["value"], r["target"]) for r in plain] == [("Dollar", 27.0, "precio_dolar"), ("Newer", 28.0, "precio_dolar")]


def test_a_hot_exercise_is_spread_over_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = scoring.score_with_models(mixed_requests(spark, 200), scoring.catalogue(spark, EXERCISES), store.packed(spark, list(MODELS.values())), MESSAGES, 8)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(exercise" in plan and "_salt" in plan
        assert out.where("error IS NULL").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_requests_of_a_hot_exercise_are_not_shuffled(spark):
    asked = mixed_requests(spark, 300).cache()
    assert asked.count() == 309
    out = scoring.score_with_models(asked, scoring.catalogue(spark, EXERCISES), store.packed(spark, list(MODELS.values())), MESSAGES)
    out = out.where("exercise = 'dolar'").select("request_id", "error", "value")
    moved = 0
    plan = out._jdf.queryExecution().executedPlan()
    plan.execute().count()
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() in ("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage"):
            stack.append(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())
        if node.nodeName() == "Exchange":
            moved += node.metrics().apply("shuffleRecordsWritten").value()
        stack += [node.children().apply(i) for i in range(node.children().size())]
    assert moved < 300
    assert out.where("error IS NULL").count() == 300
    asked.unpersist()


def test_first_bad_field_with_a_label_is_named(spark):
    forms = [("e", "Title", "m", "t", "d", [("a", None), ("b", "B"), ("c", "C"), (None, "N")])]
    models = store.packed(spark, [LinearModel(("a", "c", "x"), "", 1.0, (2.0, 3.0, 4.0), "m")])
    exercises = spark.createDataFrame(forms, scoring.CATALOGUE)
    rows = [(1, "e", {"a": "", "b": "x", "c": ""}), (2, "e", {"a": "1", "b": "2", "c": " "}), (3, "e", {"a": "1", "b": "2", "c": "3"}), (4, None, {})]
    got = scoring.score_with_models(spark.createDataFrame(rows, SCHEMA), exercises, models).orderBy("request_id").collect()
    texts = scoring.Messages()
    assert [r["error"] for r in got] == [texts.not_numeric.format("B"), texts.empty.format("C"), texts.empty.format("N"), texts.unknown]


def test_names_are_normalized_once_a_batch(spark):
    rows = [(1, ["Täx ", None, "Quantity"]), (2, None), (3, []), (4, ["Quantity"]), (5, [None])]
    df = spark.createDataFrame(rows, "id int, names array<string>").coalesce(1)
    got = {r["id"]: r["n"] for r in df.select("id", scoring._normalized("names").alias("n")).collect()}
    assert got == {1: ["tax", None, "quantity"], 2: None, 3: [], 4: ["quantity"], 5: [None]}


def test_only_exercises_that_are_asked_meet_their_models(spark):
    rows = [(f"e{i}", "Title", f"m{i}", "t", "d", [("a", "A")]) for i in range(300)]
    exercises = spark.createDataFrame(rows, scoring.CATALOGUE)
    models = store.packed(spark, [LinearModel(("a",), "", float(i), (1.0,), f"m{i}") for i in range(300)])
    asked = spark.createDataFrame([(i, f" e{i}\t", {"a": "1"}) for i in (1, 2, 3, 400)], SCHEMA)
    out = scoring.score_with_models(asked, exercises, models, salts=4)
    plan = out._jdf.queryExecution().executedPlan()
    got = out.orderBy("request_id").collect()
    assert [(r["value"], r["error"]) for r in got] == [(2.0, None), (3.0, None), (4.0, None), (None, scoring.Messages().unknown)]
    plan.execute().count()
    stack, bound = [plan], []
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
        if node.nodeName() == "ArrowEvalPython":
            bound.append(node.metrics().apply("pythonNumRowsReceived").value())
        stack += [node.children().apply(i) for i in range(node.children().size())]
    assert bound and max(bound) <= 4


def test_white_space_of_any_kind_around_names_and_values(spark):
    texts = [" 1", "1 ", "  1 \t", "\x0b1\x85", "　", " \t ", "1 1", "​1", "é", "~", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["x"] for r in df.orderBy("i").select(trimmed("t").alias("x")).collect()]
    assert got == ["1", "1", "1", "1", "", "", "1 1", "​1", "é", "~", "", None]
    asked = df.select(F.col("i").alias("request_id"), F.concat(F.lit("  e "), F.lit("\n")).alias("exercise"), F.create_map(F.lit("a"), "t").alias("fields"))
    exercises = spark.createDataFrame([("e", "T", "m", "t", "d", [("a", "A")])], scoring.CATALOGUE)
    models = store.packed(spark, [LinearModel(("a",), "", 1.0, (1.0,), "m")])
    errors = [r["error"] for r in scoring.score_with_models(asked, exercises, models).orderBy("request_id").collect()]
    empty, wrong = "Field 'A' is required.", "Field 'A' must be numeric."
    assert errors == [None] * 4 + [empty] * 2 + [wrong] * 4 + [empty] * 2
