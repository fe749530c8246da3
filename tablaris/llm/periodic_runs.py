"""Periodic runs of words: stretches that repeat themselves, found in whole texts.

A run of period q that is at least four periods long covers, on the grid of the
multiples of q, three neighbouring places whose words equal those q further on.
For every q the grid is walked, which is a harmonic sum of steps; each place that
passes is extended to both sides by two longest common extensions (``lce``), of
the words and of the words read backwards. Equal stretches keep their smallest
period. Texts are independent rows: nothing is shuffled or broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.llm.bpe import blocks
from tablaris.llm.common import CRC_TABLE, crc_sql, table
from tablaris.llm.lce import Extensions

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHORTEST = 6  # words of a run
PERIODS = 4  # in a run, at least; the grid test needs no fewer
CANDIDATES = 1 << 20  # extended at a time
EARLY = 1 << 12  # after periods 1, 2, 4 and so on, so that what is known rules out multiples
RUNS = T.ArrayType(T.StructType([T.StructField(f, T.LongType(), False) for f in ("start", "length", "period")]), False)


def stretches(words: np.ndarray, starts: np.ndarray, places: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the runs through ``places``, each run once.

    ``starts`` are the first places of the sequences in ``words``, which end with
    a number found nowhere else; only sequences with a place in them are read.
    """
    owner = np.searchsorted(starts, places, "right") - 1
    used, own = np.unique(owner, return_inverse=True)
    ends = np.append(starts[1:], len(words))
    lengths = ends[used] - starts[used]
    moved = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    shift = starts[used] - moved
    inside = np.arange(lengths.sum()) + np.repeat(shift, lengths)
    own_words, at = words[inside], places - shift[own]
    last = len(own_words) - 1
    ahead = Extensions(own_words).query(at, at + periods)
    behind = Extensions(own_words[::-1]).query(last - at + 1, last - at + 1 - periods)
    begin, end = at - behind, at + periods + ahead
    long = end - begin >= np.maximum(SHORTEST, PERIODS * periods)
    found = np.stack([begin + shift[own], end + shift[own], periods], axis=1)[long]
    return np.unique(found, axis=0)


def runs(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) by place of all runs; sequences as in ``stretches``, the longest first."""
    lengths = np.diff(np.append(starts, len(words))) - 1  # without the closing number
    known, held, wait = np.zeros((0, 3), dtype=np.int64), [], 0

    def extend() -> np.ndarray:
        places, periods = np.concatenate([p for p, _ in held]), np.concatenate([np.full(len(p), q) for p, q in held])
        held.clear()
        every = np.concatenate([known, stretches(words, starts, places, periods)])
        every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
        first = np.ones(len(every), dtype=bool)  # of a stretch's periods the smallest
        first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
        return every[first]

    for q in range(1, (int(lengths[0]) if len(lengths) else 0) // PERIODS + 1):
        count = int(np.searchsorted(-lengths, -max(SHORTEST, PERIODS * q), "right"))
        if not count:
            break
        part = words[: starts[count] if count < len(starts) else len(words)]
        grid = part[::q]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        for step in (q // 2, q + q // 2, q // 4, q - 1, 2 * q - 1) if len(at) else ():  # words that must agree too
            at = at[part[at + step] == part[at + step + q]]
        if len(at):  # a run ends with its sequence
            at = at[np.searchsorted(starts, at, "right") == np.searchsorted(starts, at + 3 * q, "right")]
        if len(at) and len(known):  # inside a run whose period divides q there is only that run
            run = known[np.maximum(np.searchsorted(known[:, 0], at, "right") - 1, 0)]
            at = at[(at < run[:, 0]) | (at + q >= run[:, 1]) | (q % run[:, 2] != 0)]
        if len(at):
            held.append((at, q))
            wait += len(at)
            if wait > (EARLY if q & (q - 1) == 0 else CANDIDATES):
                known, wait = extend(), 0
    return extend() if held else known


def in_block(texts: list[list[str]]) -> list[np.ndarray]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    order = [i for i in order if len(texts[i]) >= SHORTEST]
    out = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    if not order:
        return out
    lengths = np.array([len(texts[i]) for i in order])
    ids = pa.array([w for i in order for w in texts[i]], pa.large_string()).dictionary_encode()
    ends = np.cumsum(lengths)
    words = np.insert(ids.indices.to_numpy().astype(np.int64), ends, len(ids.dictionary) + np.arange(len(order)))
    starts = np.concatenate([[0], (ends + np.arange(1, len(order) + 1))[:-1]])
    found = runs(words, starts)
    owner = np.searchsorted(starts, found[:, 0], "right") - 1
    found = np.stack([found[:, 0] - starts[owner], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    cuts = np.searchsorted(owner, np.arange(len(order) + 1))
    for k in np.unique(owner).tolist():
        own = found[cuts[k] : cuts[k + 1]]
        out[order[k]] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return out


def collapsed(words: list[str], found: np.ndarray) -> str:
    """The words that no run repeats, joined by one space."""
    if not len(found):
        return " ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def periodic_runs(
    df: DataFrame, text_col: str = "text", rewrite: Callable[[int, int], np.ndarray | None] | None = None, seed: Column | None = None
) -> DataFrame:
    """``df`` with n_words, runs and collapsed; columns of these names are replaced.

    Words are what stands between blanks and the characters U+0009 to U+000D. A
    run is a stretch of at least six words, and four times its smallest period,
    that cannot be longer at that period; ``runs`` lists (start, length, period)
    by start, then period. ``collapsed`` has the words that no run holds after its
    first period, joined by one space. Null and empty texts have no words. With
    ``rewrite``, a function of the number of words and of ``seed`` that gives
    places, the words at those places are read instead; None leaves them. Rows may
    repeat; an empty table stays empty.
    """
    added = [("n_words", T.LongType()), ("runs", RUNS), ("collapsed", T.StringType())]
    kept = [f for f in df.schema if f.name not in dict(added)]
    schema = T.StructType([*kept, *[T.StructField(*a) for a in added]])
    names = [f"c{i}" for i in range(len(kept))]  # apart from what is used inside
    source = df.select(
        *[F.col(f"`{f.name}`").alias(n) for f, n in zip(kept, names)],
        F.col(f"`{text_col}`").alias("text"), (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column("seed")
            for at, texts in blocks(batch.column("text")):
                split = [WORD.findall(t) for t in texts]
                if rewrite is not None:
                    for i, s in enumerate(seeds.slice(at, len(texts)).to_pylist()):
                        places = None if s is None else rewrite(len(split[i]), s)
                        if places is not None:
                            split[i] = [split[i][p] for p in places.tolist()]
                found = in_block(split)
                rows = batch.slice(at, len(texts))
                flat = np.concatenate(found)
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
                columns = [
                    *[rows.column(n) for n in names],
                    pa.array([len(w) for w in split], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), fields),
                    pa.array([collapsed(w, f) for w, f in zip(split, found)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return source.mapInArrow(work, schema)


def echo(n: int, h: int) -> np.ndarray | None:
    """Places of the words of a text that repeats itself from a place on, for one seed in ten."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % period
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs, rewrite=echo, seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("longest", longest)
    length = -F.col("longest.l")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(-1000 * longest.l) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        F.col("n_words"),
    )


#: Every pair of equal words of a document, taken together by their distance.
ORACLE_SQL = rf"""
WITH {CRC_TABLE},
texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc_sql("doc_id::VARCHAR")} AS h
  FROM documents, crc),
echoes AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM texts),
words AS (
  SELECT doc_id, n, i, CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM echoes)),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
repeated AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN repeated USING (doc_id, i) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_runs, min(struct_pack(l := -length, s := start, p := period)) AS longest,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.s AS start, -longest.l AS length, longest.p AS period,
  (-1000 * longest.l) // longest.p AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256, n::BIGINT AS n_words
FROM echoes LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
