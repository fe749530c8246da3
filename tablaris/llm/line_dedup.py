"""Line deduplication over levelled sorted runs, DataFrame functions only.

The corpus is taken in batches. A run is a table of line keys (128-bit hashes)
with the number of documents that hold the key and the largest of their ids,
sorted by key. Each new batch is merge-anti-joined with the runs: keys that no
run holds become a run of the first level, keys already held become a run of
further counts. When a level has ``fanout`` runs they are compacted into one
run of the next level, so a key is rewritten once a level and the number of
runs stays logarithmic in the number of batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import stage, table

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


class LineRuns:
    """Levelled runs of (k1, k2, docs, last)."""

    def __init__(self, fanout: int = 4):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.counts: list[list[DataFrame]] = []

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in a batch of (k1, k2, docs, last), one row per key; return its new keys."""
        batch = stage(batch, "line-batch")
        fresh, held = batch, None
        for run in self._runs(self.levels):
            fresh = fresh.join(run.select(KEY).hint("merge"), KEY, "left_anti")
        if self.levels:
            fresh = self._sorted(fresh)
            held = self._sorted(batch.join(fresh.select(KEY).hint("merge"), KEY, "left_anti"))
            self._push(self.counts, held)
        else:
            fresh = self._sorted(fresh)
        self._push(self.levels, fresh)
        return fresh

    def merged(self) -> DataFrame | None:
        """All keys with their counts over everything added."""
        runs = self._runs(self.levels) + self._runs(self.counts)
        return self._merge(runs) if runs else None

    @staticmethod
    def _runs(levels: list[list[DataFrame]]) -> list[DataFrame]:
        return [run for level in levels for run in level]

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.union, runs)
        return rows.groupBy(KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    @staticmethod
    def _sorted(run: DataFrame) -> DataFrame:
        return stage(run.sortWithinPartitions(KEY), "line-run")

    def _push(self, levels: list[list[DataFrame]], run: DataFrame) -> None:
        depth = 0
        while True:
            if depth == len(levels):
                levels.append([])
            levels[depth].append(run)
            if len(levels[depth]) < self.fanout:
                return
            run = self._sorted(self._merge(levels[depth]))
            levels[depth] = []
            depth += 1


def line_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 6,
    fanout: int = 4,
) -> DataFrame:
    """Columns of ``df`` with ``text_col`` rewritten, plus ``n_lines`` (before) and ``n_dropped``.

    Keys of at least ``min_chars`` code points that ``min_docs`` documents hold
    lose all their lines except in the document with the largest id. Null and
    empty texts are one empty line and come back as empty text. Rows with the
    same id are one document when counting, and each keeps its lines where that
    id is the largest; a null id counts as one document and never is the largest
    unless no other holds the key. Extra columns pass through, except that ones named
    like the two counts are replaced. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = F.transform(
        F.transform(F.split(text, "\n", -1), line_key),
        lambda key, i: F.when(
            F.char_length(key) >= min_chars,
            F.struct(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"), i.alias("at")),
        ),
    )
    # Rows that repeat an id can differ in text, so a row is known by both.
    found = stage(
        df.select(
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("text_hash"),
            F.explode(F.filter(keyed, lambda x: x.isNotNull())).alias("x"),
        ).select("id", "text_hash", "x.*", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch")),
        "lines",
        "batch",
    )
    runs = LineRuns(fanout)
    for b in range(batches):
        holders = found.where(F.col("batch") == b).groupBy(*KEY, "id").agg(F.lit(1).alias("one"))
        runs.add(holders.groupBy(KEY).agg(F.count("*").alias("docs"), F.max("id").alias("last")))
    frequent = runs.merged().where(F.col("docs") >= min_docs).select(*KEY, "last")
    dropped = found.join(frequent, KEY).where(~F.col("id").eqNullSafe(F.col("last")))
    dropped = dropped.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("at"))
    # A Boolean for each line up to the last dropped one, built in linear time.
    gap = lambda p, i: p - F.coalesce(F.get(F.col("at"), i - 1), F.lit(-1)) - 1
    mask = F.flatten(
        F.transform("at", lambda p, i: F.concat(F.array_repeat(F.lit(False), gap(p, i)), F.array(F.lit(True))))
    )
    dropped = dropped.select(
        F.struct("id", "text_hash").alias("of"), mask.alias("mask"), F.size("at").cast("long").alias("n_dropped")
    )
    rows = df.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash")).alias("is"))
    rows = rows.join(dropped, F.col("is") == F.col("of"), "left")
    whole = F.coalesce(F.col("row")[text_col], F.lit(""))
    kept = F.filter(F.split(whole, "\n", -1), lambda line, i: ~F.coalesce(F.get(F.col("mask"), i), F.lit(False)))
    added = ["n_lines", "n_dropped"]
    return rows.select(
        *[
            F.when(F.col("mask").isNull(), whole).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else F.col("row")[c].alias(c)
            for c in df.columns
            if c not in added
        ],
        (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
    SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
    SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), d AS (
    SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS dropped FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
