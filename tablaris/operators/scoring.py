"""Apply stored models to tables of records and to loosely typed requests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablaris.functions.names import normalize_name
from tablaris.functions.parse import is_finite, parse_trimmed, trimmed
from tablaris.operators.conform import column_sources
from tablaris.operators.regression import LinearModel, predict
from tablaris.sources.staging import stage

# Keys that a frequent exercise is spread over, and the share of requests that makes it one.
SALTS = 32


@dataclass(frozen=True)
class Exercise:
    """A kind of scoring request: its form fields (name, label) and its model."""

    key: str
    title: str
    fields: tuple[tuple[str, str], ...]
    target: str
    model: str
    # What answers call the model; its own name, or this, where that is empty.
    display: str = "Model"


@dataclass(frozen=True)
class Messages:
    """Texts of the outcomes; ``{}`` takes the label, model or variable names."""

    unknown: str = "Unknown exercise."
    empty: str = "Field '{}' is required."
    not_numeric: str = "Field '{}' must be numeric."
    no_model: str = "No model found: {}"
    unmapped: str = "Model variables without a value: {}"
    failed: str = "Prediction failed: {}"


def bind_features(df: DataFrame, model: LinearModel) -> DataFrame:
    """Add the model's variables as columns, found by normalized name."""
    sources = column_sources(df.columns, {})
    wanted = {v: normalize_name(v) for v in model.features}
    missing = [v for v, plain in wanted.items() if plain not in sources]
    if missing:
        raise ValueError(f"Model variables without a value: {', '.join(missing)}")
    extra = [
        F.col(f"`{df.columns[sources[plain]]}`").alias(v)
        for v, plain in wanted.items()
        if v not in df.columns
    ]
    return df.select("*", *extra)


def score_named(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    """Bind by name, predict, and drop the helper columns again."""
    return predict(bind_features(df, model), model, out).select(*df.columns, out)


_LOOKUP = """exercise string, title string, model string, target string, problem string,
 fields array<struct<name: string, label: string>>, intercept double,
 terms array<struct<field: string, coefficient: double>>"""


def exercise_lookup(
    df: DataFrame,
    exercises: Sequence[Exercise],
    models: Mapping[str, LinearModel],
    messages: Messages,
) -> DataFrame:
    """One row per exercise with its model already bound to its fields.

    What is wrong with the model itself is settled here, once per exercise.
    """
    rows = []
    for e in exercises:
        model = models.get(e.model)
        by_name = {normalize_name(name): name for name, _ in e.fields}
        problem, terms = None, []
        if model is None:
            problem = messages.no_model.format(e.model)
        else:
            terms = [
                (by_name.get(normalize_name(v)), c)
                for v, c in zip(model.features, model.coefficients)
            ]
            lost = [v for v, (f, _) in zip(model.features, terms) if f is None]
            problem = messages.unmapped.format(", ".join(lost)) if lost else None
        rows.append(
            (
                e.key,
                e.title,
                (model.display or model.name or e.display) if model else None,
                (model.target if model else None) or e.target,
                problem,
                list(e.fields),
                model.intercept if model else None,
                terms,
            )
        )
    # As an Arrow table this is a local relation, whose size Spark knows when it plans a join.
    schema = T.StructType.fromDDL(_LOOKUP)
    names = schema.names
    columns = [pa.array(v, f.type) for v, f in zip(zip(*map(_plain, rows)), to_arrow_schema(schema))] if rows else None
    if columns is None:
        return df.sparkSession.createDataFrame([], schema)
    return df.sparkSession.createDataFrame(pa.table(columns, names), schema)


def _plain(row: tuple) -> list:
    """A lookup row with its structs as dictionaries."""
    fields = [{"name": n, "label": text} for n, text in row[5]]
    return [*row[:5], fields, row[6], [{"field": f, "coefficient": c} for f, c in row[7]]]


def _message(template: str, value: Column) -> Column:
    before, _, after = template.partition("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def catalogue(spark: SparkSession, exercises: Sequence[Exercise]) -> DataFrame:
    """Exercises as rows, for :func:`score_with_models`; any table of these columns will do."""
    rows = [(e.key, e.title, e.model, e.target, e.display, list(e.fields)) for e in exercises]
    return spark.createDataFrame(rows, CATALOGUE)


CATALOGUE = "exercise string, title string, model string, target string, display string, fields array<struct<name: string, label: string>>"


@F.arrow_udf(T.ArrayType(T.StringType()))
def _normalized(names: pa.Array) -> pa.Array:
    """Lists of names, each distinct name of a batch normalized once."""
    flat = names.flatten().dictionary_encode()
    plain = pa.array([None if n is None else normalize_name(n) for n in flat.dictionary.to_pylist()], pa.string())
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(names), 0))
    offsets = pa.concat_arrays([pa.array([0], ends.type), ends])
    return pa.ListArray.from_arrays(offsets.cast(pa.int32()), plain.take(flat.indices), mask=names.is_null())


def model_lookup(exercises: DataFrame, models: DataFrame, messages: Messages) -> DataFrame:
    """The columns of :func:`exercise_lookup` from tables: exercises, and models packed as stored.

    Models are joined by name, and variables bound to fields by normalized name (of
    fields that share one, the last), in columns: nothing is fetched, however many
    there are. Names of exercises and of models are distinct.
    """
    known = models.select("model", F.col("target").alias("m_target"), F.col("display").alias("m_display"), "intercept", "terms")
    joined = exercises.join(known, "model", "left").select(
        "*",
        _normalized(F.reverse(F.transform("fields", lambda f: f["name"]))).alias("f_plain"),
        _normalized(F.transform("terms", lambda t: t["term"])).alias("t_plain"),
    )
    # f_plain runs backwards, so its first match is the last field; no match gives a place beyond the end.
    place = lambda i: F.size("fields") - F.array_position("f_plain", F.get("t_plain", i)).cast("int")
    bound = F.transform(
        "terms",
        lambda t, i: F.struct(F.get("fields", place(i))["name"].alias("field"), t["coefficient"].alias("coefficient"), t["term"].alias("term")),
    )
    joined = joined.withColumn("bound", bound)
    lost = F.transform(F.filter("bound", lambda b: b["field"].isNull()), lambda b: b["term"])
    problem = F.when(F.col("intercept").isNull(), _message(messages.no_model, F.col("model"))).when(
        F.size(lost) > 0, _message(messages.unmapped, F.array_join(lost, ", "))
    )
    found = F.col("intercept").isNotNull()
    return joined.select(
        "exercise",
        "title",
        F.when(found, F.coalesce(F.nullif("m_display", F.lit("")), F.nullif("model", F.lit("")), "display")).alias("model"),
        F.coalesce(F.nullif("m_target", F.lit("")), "target").alias("target"),
        problem.alias("problem"),
        "fields",
        "intercept",
        F.transform("bound", lambda b: F.struct(b["field"].alias("field"), b["coefficient"].alias("coefficient"))).alias("terms"),
    )


def score_requests(
    requests: DataFrame,
    exercises: Sequence[Exercise],
    models: Mapping[str, LinearModel],
    messages: Messages | None = None,
) -> DataFrame:
    """Answer a table of requests ``(request_id, exercise, fields map)``.

    Each row comes back with exercise title, model, target and value, or with
    the first error found. White space around names and values does not count, and
    a number is what :func:`parse_number` reads. The lookup is a local table, so the
    sizes that Spark knows decide how it is joined; where that is by shuffle, adaptive
    execution splits an exercise that most requests name. After that all is row-local.
    """
    texts = messages or Messages()
    return _answers(requests, exercise_lookup(requests, exercises, models, texts), texts)


def score_with_models(
    requests: DataFrame, exercises: DataFrame, models: DataFrame, messages: Messages | None = None, salts: int = SALTS
) -> DataFrame:
    """:func:`score_requests` with exercises and models as tables, of any size.

    ``exercises`` has the columns of :func:`catalogue`, ``models`` those of stored
    models. Exercises named by more than one request in ``salts`` (there are fewer
    than that many, found by one aggregate) are looked up apart from the others, in
    a staged table of a few rows: their requests are not shuffled where Spark may
    broadcast it, and spread over as many keys where not. ``requests`` is read once
    for the counts and once for each of the two kinds. Only exercises that the counts
    name meet their models.
    """
    texts = messages or Messages()
    hashed = [f.name for f in requests.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant", "interval"))]
    asked = trimmed(F.col("exercise"))
    counts = requests.groupBy(asked.alias("exercise")).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "asked")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r["exercise"] for r in counts.where((F.col("n") * salts > total) & F.col("exercise").isNotNull()).collect()]
    others = counts.where(~F.col("exercise").isin(hot)) if hot else counts
    lookup = model_lookup(exercises.join(others, "exercise", "left_semi"), models, texts)
    if not hot:
        return _answers(requests, lookup, texts)
    named = exercises.where(F.col("exercise").isin(hot))
    names = [r["model"] for r in named.select("model").distinct().limit(salts + 1).collect()]
    # By name the scan finds their models; only a table that repeats exercises can have more names than this.
    few = model_lookup(named, models.where(F.col("model").isin(names)) if len(names) <= salts else models, texts)
    few = stage(few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "hot-lookup")
    # A filter computes its text anew wherever it is named, so most requests are known by their first comparison.
    is_hot = F.coalesce(F.trim("exercise").isin(hot) | asked.isin(hot), F.lit(False))
    salt = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    return _answers(requests.where(is_hot), few, texts, salt).unionByName(_answers(requests.where(~is_hot), lookup, texts))


def _number(text: Column) -> Column:
    """The number in a text without spaces at its ends; only one that is none as it stands is trimmed of other white space."""
    return F.coalesce(parse_trimmed(text), parse_trimmed(trimmed(text)))


def _answers(requests: DataFrame, lookup: DataFrame, texts: Messages, salt: Column | None = None) -> DataFrame:
    # What is the same for all requests of an exercise is done in the lookup: a term's field becomes its place in the form.
    lookup = lookup.withColumnRenamed("fields", "form")
    names = F.transform("form", lambda f: f["name"])
    place = F.transform("terms", lambda t: F.struct((F.array_position(names, t["field"]).cast("int") - 1).alias("at"), t["coefficient"].alias("coefficient")))
    lookup = lookup.withColumn("terms", place)
    asked = requests.withColumns({"exercise": trimmed(F.col("exercise")), **({} if salt is None else {"_salt": salt})})
    joined = asked.join(lookup, "exercise" if salt is None else ["exercise", "_salt"], "left")

    # Each value is read once; what is wrong with one is looked at only where one is bad.
    given = F.transform("form", lambda f: F.trim(F.try_element_at("fields", f["name"])))
    joined = joined.withColumn("numbers", F.transform(given, _number))
    unread = F.transform("numbers", lambda n, i: n.isNull() & F.get("form", i)["label"].isNotNull())
    first = F.get("form", F.array_position(unread, True).cast("int") - 1)
    text = trimmed(F.coalesce(F.try_element_at("fields", first["name"]), F.lit("")))
    wrong = F.when(text == "", _message(texts.empty, first["label"])).otherwise(_message(texts.not_numeric, first["label"]))
    field_error = F.when(F.exists("numbers", lambda n: n.isNull()), wrong)
    value = F.aggregate("terms", F.col("intercept"), lambda total, t: total + F.get("numbers", t["at"]) * t["coefficient"])
    checked = joined.withColumns(
        {"error": F.when(F.col("form").isNull(), texts.unknown).otherwise(F.coalesce(field_error, "problem")), "value": value}
    ).withColumn("value", F.when(F.col("error").isNull(), F.col("value")))
    failed = F.col("error").isNull() & ~is_finite(F.col("value"))
    error = F.when(failed, _message(texts.failed, F.col("value").cast("string"))).otherwise(
        F.col("error")
    )
    good = error.isNull()
    return checked.select(
        *[c for c in requests.columns if c not in ("fields",)],
        error.alias("error"),
        F.when(good, F.col("title")).alias("title"),
        F.when(good, F.col("model")).alias("model"),
        F.when(good, F.col("target")).alias("target"),
        F.when(good, F.col("value")).alias("value"),
        F.when(good, F.format_string("%.2f", "value")).alias("value_text"),
    )
