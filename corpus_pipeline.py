"""Documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns the columns of the
documents table; the last returns packed pieces. Between stages the rows are
written as Parquet and read again, so a lost executor never costs more than the
stage it was working on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import stage, table
from tablaris.llm.language import UNKNOWN, fit_documents, identify
from tablaris.llm.line_dedup import line_dedup
from tablaris.llm.ngram_join import ngram_join
from tablaris.llm.packing import packed_documents
from tablaris.llm.secrets import redact_secrets

#: Model scoring, similarity and packing are not expressible in SQL.
ORACLE_SQL = None


def counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of documents whose text was rewritten, with n_chars brought up to date."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised; those without a letter, or null, go."""
    said = identify(docs, fit_documents(docs))
    return said.where(F.col("lang_pred") != UNKNOWN).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that many share; emptied documents stay."""
    return counted(line_dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows that repeat an id stay or go together.
    """
    kept = ngram_join(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets found in them marked out."""
    return counted(redact_secrets(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
