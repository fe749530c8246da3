"""Quality scores of texts by a sparse ensemble of rules over text statistics.

Statistics of a text are column expressions. A random forest of shallow trees is
grown on the labelled rows; every path from a root to a node is a rule, the
conjunction of its comparisons. A logistic regression with an absolute-value
penalty over the rules keeps few of them, and the kept ones are compiled to one
column expression. Growing, weighting and scoring are Spark jobs over a table of
statistics; only the trees and weights, whose number is a parameter, come to the
driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import stage, table

BLANKS = "[\\x20\\x09-\\x0D]+"
MARKS = "!?"
SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~"
STATISTICS = [
    "chars", "words", "word_length", "letters", "capitals", "digits", "marks", "symbols", "ended", "echoed", "distinct", "line_words", "lines_repeated",
]


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the struct ``statistics`` of each text; a column of that name is replaced.

    Doubles, never null: chars and words (natural logarithms, plus one); the mean
    length of a word; of all characters the shares of letters, of capitals, of
    digits, of ``!`` and ``?``, of symbols; of all words the shares that end in a
    punctuation mark, that equal the word before, and of distinct ones; words a
    line; the share of lines that repeat another. All 0 for null and empty texts.
    """
    text = F.col("_quality.text")
    kept = [c for c in df.columns if c != "statistics"]
    plain = df.select(*[F.col(f"`{c}`") for c in kept], F.struct(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("_quality"))
    split = plain.withColumn("_words", F.filter(F.split(text, BLANKS), lambda w: w != "")).withColumn("_lines", F.split(text, "\n"))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    def without(pattern: str) -> Column:
        return chars - F.char_length(F.regexp_replace(text, pattern, ""))

    def among(characters: str) -> Column:
        return chars - F.char_length(F.translate(text, characters, ""))

    chars, words, lines = F.char_length(text), F.size("_words"), F.size("_lines")
    echoes = F.zip_with(F.slice("_words", 2, F.greatest(words - 1, F.lit(0))), F.slice("_words", 1, F.greatest(words - 1, F.lit(0))), lambda a, b: a == b)
    values = {
        "chars": F.log1p(chars),
        "words": F.log1p(words),
        "word_length": share(chars, words),
        "letters": share(without("\\p{L}+"), chars),
        "capitals": share(without("\\p{Lu}+"), chars),
        "digits": share(among("0123456789"), chars),
        "marks": share(among(MARKS), chars),
        "symbols": share(among(SYMBOLS), chars),
        "ended": share(F.regexp_count(text, F.lit("[.,;:!?][\\x20\\x09-\\x0D]")), words),
        "echoed": share(F.size(F.filter(echoes, lambda e: e)), words),
        "distinct": share(F.size(F.array_distinct("_words")), words),
        "line_words": share(words, lines),
        "lines_repeated": F.when(chars > 0, 1 - share(F.size(F.array_distinct("_lines")), lines)).otherwise(0.0),
    }
    statistics = F.struct(*[values[name].alias(name) for name in STATISTICS]).alias("statistics")
    return split.select(*[F.col(f"`{c}`") for c in kept], statistics)


@dataclass(frozen=True)
class Rule:
    """Statistics that lie above and up to limits, all of them."""

    limits: tuple[tuple[str, float, float], ...]  # name, low (exclusive), high (inclusive)

    def column(self) -> Column:
        tests = []
        for name, low, high in self.limits:
            value = F.col(f"statistics.{name}")
            tests += [value > low] if low > -math.inf else []
            tests += [value <= high] if high < math.inf else []
        return reduce(Column.__and__, tests)

    def __str__(self) -> str:
        return " and ".join(f"{low:.4g} < {name} <= {high:.4g}" for name, low, high in self.limits)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; the score is the logistic function of their sum."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def column(self) -> Column:
        total = reduce(Column.__add__, [F.when(rule.column(), weight).otherwise(0.0) for rule, weight in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def paths(node, limits: dict[str, tuple[float, float]]) -> Iterator[Rule]:
    """The conjunctions that lead to each node below one of a grown tree."""
    if node.subtreeDepth() == 0:
        return
    name, cut = STATISTICS[node.split().featureIndex()], node.split().threshold()
    low, high = limits.get(name, (-math.inf, math.inf))
    for child, own in ((node.leftChild(), (low, min(high, cut))), (node.rightChild(), (max(low, cut), high))):
        narrowed = {**limits, name: own}
        yield Rule(tuple((n, *narrowed[n]) for n in STATISTICS if n in narrowed))
        yield from paths(child, narrowed)


def fit(df: DataFrame, label_col: str = "label", trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> RuleEnsemble:
    """Rules and weights from ``statistics`` and a 0/1 label; rows with a null or other label are not used.

    At most ``trees`` x (2 ** (depth + 1) - 2) rules. Repeated rows count as often
    as they occur. Where not both labels occur there are no rules, and the
    intercept is the smoothed share of ones (one half for an empty table).
    """
    rows = df.select("statistics", F.col(label_col).cast("double").alias("label")).where("label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleEnsemble(math.log((counts.get(1.0, 0) + 1) / (counts.get(0.0, 0) + 1)), ())
    assembled = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows.select("label", "statistics.*"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="onethird", seed=seed
    ).fit(assembled.select("features", "label"))
    found = dict.fromkeys(rule for tree in forest.trees for rule in paths(tree._java_obj.rootNode(), {}))
    if not found:
        return RuleEnsemble(math.log((counts[1.0] + 1) / (counts[0.0] + 1)), ())
    matrix = F.array(*[rule.column().cast("double") for rule in found])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, tol=1e-5, standardization=False)
    weighted = lasso.fit(rows.select("label", array_to_vector(matrix).alias("features")))
    weights = zip(found, weighted.coefficients.toArray().tolist())
    return RuleEnsemble(weighted.intercept, tuple((rule, w) for rule, w in weights if w))


def score(df: DataFrame, model: RuleEnsemble, threshold: float = 0.7) -> DataFrame:
    """``df``, which has ``statistics``, with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    return df.withColumn("score", model.column()).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """One id in four; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit_documents(docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
    """Rules from the labels, by doc_id, of rows of ``docs`` (doc_id, statistics) that are not held out."""
    own = labels.select("doc_id", F.col("quality").alias("label"))
    return fit(stage(docs.where(~held_out()).join(own, "doc_id").select("statistics", "label"), "quality-labelled"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are read once, for the statistics of all documents."""
    docs = with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = stage(docs.select("doc_id", "statistics"), "quality-statistics")
    model = fit_documents(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
