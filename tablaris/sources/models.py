"""Stored models: a folder of versions, any number of models in each.

``models/run=<id>`` holds one row a model, its coefficients packed in order.
``manifest`` gets one row a save, written when the run is complete, in one file
that appears as a whole: a reader sees all of a save or nothing of it, and a save
that fails leaves what was there. A model's latest row up to a version counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.operators.regression import LinearModel

#: Columns of models kept as one row a term, which can be read as well.
REQUIRED = ("model", "target", "term", "position", "coefficient")
PACKED = (
    "model string, target string, display string, intercept double, "
    "terms array<struct<term: string, coefficient: double>>, rank_deficient boolean, fitted_at timestamp"
)
_PACKED = [c.split()[0] for c in PACKED.replace("array<struct<term: string, coefficient: double>>", "array").split(", ")]
_MANIFEST = "version long, run string, saved_at timestamp"


class ModelError(ValueError):
    """A model table that is missing, of the wrong kind, or incomplete."""


def packed(spark: SparkSession, models: Sequence[LinearModel]) -> DataFrame:
    """One row for each model."""
    rows = [
        (m.name, m.target, m.display, float(m.intercept), [(f, float(c)) for f, c in zip(m.features, m.coefficients)], bool(m.rank_deficient), m.fitted_at)
        for m in models
    ]
    return spark.createDataFrame(rows, PACKED)


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException:
        return None


def save_model_rows(models: DataFrame, path: str) -> int:
    """Add rows as of :func:`packed`, however many, as the next version; returns its number.

    Models of a name that is there already are replaced from this version on, all
    others stay. Of two saves at once, either may get a number the other has; the
    later one counts then.
    """
    spark, run = models.sparkSession, uuid.uuid4().hex
    models.select(*_PACKED).write.parquet(f"{path}/models/run={run}")
    before = _manifest(spark, path)
    version = 1 + ((before.agg(F.max("version")).first()[0] or 0) if before is not None else 0)
    publish(spark, path, version, run)
    return version


def publish(spark: SparkSession, path: str, version: int, run: str) -> None:
    """Make a complete run visible: one row, in a file that is renamed into place."""
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(run).alias("run"), F.current_timestamp().alias("saved_at"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def save_models(spark: SparkSession, models: Sequence[LinearModel], path: str) -> int:
    return save_model_rows(packed(spark, models).coalesce(1), path)


def stored_models(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Packed rows and their ``version``: each model as of a version, the last one by default.

    A table with one row a term is read as models of version 0.
    """
    manifest = _manifest(spark, path)
    if manifest is None:
        return _unpacked_table(spark, path)
    if version is not None:
        manifest = manifest.where(F.col("version") <= version)
    rows = spark.read.schema(f"{PACKED}, run string").parquet(f"{path}/models").join(manifest, "run")
    place = F.struct("version", "saved_at", "run")
    latest = rows.groupBy("model").agg(F.max_by(F.struct(*_PACKED[1:], "version"), place).alias("m"))
    return latest.select("model", "m.*")


def _unpacked_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        table = spark.read.parquet(path)
    except AnalysisException as problem:
        raise ModelError(f"no readable model table at {path}: {problem}") from problem
    missing = [c for c in REQUIRED if c not in table.columns]
    if missing:
        raise ModelError(f"model table at {path} lacks {', '.join(missing)}")
    # A model has one row per term, so its list is as long as its features.
    listed = table.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("position", "term", "coefficient"))).alias("t"), F.max("target").alias("target"))
    whole = F.transform("t", lambda t: t["position"].cast("long")) == F.sequence(F.lit(0).cast("long"), (F.size("t") - 1).cast("long"))
    first = F.get("t", F.lit(0))
    terms = F.transform(F.slice("t", 2, F.size("t")), lambda t: F.struct(t["term"].alias("term"), t["coefficient"].alias("coefficient")))
    return listed.select(
        "model", "target", F.lit("").alias("display"), F.when(whole, first["coefficient"]).alias("intercept"), terms.alias("terms"),
        F.lit(False).alias("rank_deficient"), F.lit(None).cast("timestamp").alias("fitted_at"), F.lit(0).cast("long").alias("version"),
    )


def read_model_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row a term, the intercept at position 0, with what is known of the model."""
    models = stored_models(spark, path, version)
    first = F.array(F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("coefficient")))
    terms = models.withColumn("terms", F.concat(first, "terms"))
    return terms.select("model", "target", "display", "rank_deficient", "fitted_at", "version", F.posexplode("terms").alias("position", "t")).select(
        "model", "target", "t.term", "position", "t.coefficient", "display", "rank_deficient", "fitted_at", "version"
    )


def load_models(spark: SparkSession, path: str, names: Sequence[str], version: int | None = None) -> dict[str, LinearModel]:
    """The named models that the store has; those without an intercept or a term are refused.

    Only their rows are read (the filter reaches the Parquet scan) and fetched, one
    for each model, however many models the store holds.
    """
    wanted = stored_models(spark, path, version).where(F.col("model").isin(list(names)))
    models = {}
    for row in wanted.collect():
        if row["intercept"] is None or not row["terms"] or any(t["coefficient"] is None for t in row["terms"]):
            raise ModelError(f"model {row['model']} is incomplete")
        models[row["model"]] = LinearModel(
            tuple(t["term"] for t in row["terms"]),
            row["target"],
            row["intercept"],
            tuple(t["coefficient"] for t in row["terms"]),
            row["model"],
            row["rank_deficient"],
            row["display"] or "",
            row["fitted_at"],
        )
    return models
