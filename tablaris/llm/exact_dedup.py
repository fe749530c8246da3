"""Exact deduplication by skew-safe combining, DataFrame functions only.

Rows whose digest is unique are settled by a count of digests, which needs no
text. The rest are combined in three steps, each on the full content: within
each input partition (the map side of the first aggregation), within salted
digest groups, and among the winners of the salts. The answer travels back the
same way, so a group that holds a third of all rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import stage, table

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became
    one space; null counts as empty. The smallest id of a group stays. Rows that
    repeat an id within a group count singly in ``group_size`` and share its
    fate; a null id stays only where its group has no other id. Other columns
    are ignored, whatever their names. An empty table gives an empty result.
    """
    norm = normalised(F.col(text_col))
    base = df.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn("digest", F.xxhash64("norm"))
    repeated = base.groupBy("digest").count().where("count > 1").select("digest", F.lit(True).alias("repeated"))
    # Text is kept only where its digest repeats.
    marked = stage(
        base.join(repeated, "digest", "left").select(
            "id",
            "digest",
            F.sha2("norm", 256).alias("sha"),
            F.when(F.col("repeated"), F.col("norm")).alias("norm"),
            F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"),
        ),
        "exact",
    )
    single = marked.where("norm IS NULL").select(
        "id", F.col("id").alias("keep"), F.lit(1).cast("long").alias("size"), "sha"
    )
    several = marked.where("norm IS NOT NULL")
    group = ["digest", "norm"]
    salted = several.groupBy(*group, "salt").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    winners = salted.groupBy(*group).agg(F.min("first").alias("keep"), F.sum("n").alias("size"))
    settled = salted.select(*group, "salt").join(winners, group)
    combined = several.join(settled, [*group, "salt"]).select("id", "keep", "size", "sha")
    return single.union(combined).select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH n AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
    SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
    FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
