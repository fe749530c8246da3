"""Words grouped with their spelling variants, by composing finite-state machines.

Two words are near if one edit of one code point makes one of the other: the
vocabulary's minimised acceptor, composed with a transducer of one edit and with
the acceptor again, accepts just these pairs. Up to the edit both acceptors are in
one state, and after it in two, so a pair is found by walking the acceptor and, from
two branches of a state, the strings that both accept.

The composition is cut into parts that share their initial state. A part holds
the words that agree in all but a stretch in which the edit lies: the half before
or the half behind the middle, at first. Parts with many words, or long
stretches, are halved again, so that no task gets a large part however many
words begin or end alike, and every pair has its edit in one part only. Words are
counted, dealt and joined by Spark; nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import CRC_TABLE, crc_sql, shuffle_partitions, stage, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PART = 20_000  # words of a part
STRETCH = 64  # code points in which the edit of a part may lie
BATCH = 50_000  # words in one acceptor, but for a part with more


class Acceptor:
    """Minimised acceptor of sets of words, each with its own initial state.

    States with the same future are one, over all sets. A state is a number, with
    its edges, and the lengths of what it accepts as bits.
    """

    def __init__(self) -> None:
        self.edges: list[dict[str, int]] = []
        self.lengths: list[int] = []
        self.known: dict[tuple, int] = {}
        self.shared: dict[tuple[int, int, int], list[str]] = {}

    def state(self, final: bool, edges: list[tuple[str, int]]) -> int:
        key = (final, *edges)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.edges)
            self.edges.append(dict(edges))
            bits = int(final)
            for _, target in edges:
                bits |= self.lengths[target] << 1
            self.lengths.append(bits)
        return found

    def add(self, words: Iterable[str]) -> int:
        """Initial state of a set; words in order, without repeats."""
        path: list[list] = [[False, []]]  # of the last word, states not yet numbered
        letters: list[str] = []
        for word in words:
            same = 0
            while same < len(letters) and same < len(word) and letters[same] == word[same]:
                same += 1
            self._close(path, letters, same)
            for letter in word[same:]:
                letters.append(letter)
                path.append([False, []])
            path[-1][0] = True
        self._close(path, letters, 0)
        return self.state(path[0][0], path[0][1])

    def _close(self, path: list[list], letters: list[str], depth: int) -> None:
        while len(letters) > depth:
            final, edges = path.pop()
            path[-1][1].append((letters.pop(), self.state(final, edges)))

    def both(self, one: int, two: int, length: int) -> list[str]:
        """Strings of this length that both states accept."""
        if not (self.lengths[one] & self.lengths[two]) >> length & 1:
            return []
        if length == 0:
            return [""]
        key = (one, two, length) if one <= two else (two, one, length)
        found = self.shared.get(key)
        if found is None:
            ahead = self.edges[two]
            found = [c + rest for c, to in self.edges[one].items() if c in ahead for rest in self.both(to, ahead[c], length - 1)]
            self.shared[key] = found
        return found

    def near(self, start: int, length: int, to_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words with one edit between them.

        A letter replaced in words of ``length``, or put into one of them; of the
        places where it may be put in the last one counts, and the end of the word
        only with ``to_end``. The shorter word comes first.
        """
        walk = [(start, "")]
        while walk:
            state, done = walk.pop()
            left = length - len(done)
            edges = list(self.edges[state].items())
            for i, (c, to) in enumerate(edges):
                if left:
                    walk.append((to, done + c))
                    for d, other in edges[:i]:
                        for rest in self.both(to, other, left - 1):
                            yield done + c + rest, done + d + rest
                if left or to_end:
                    for rest in self.both(state, to, left):
                        if rest[:1] != c:
                            yield done + rest, done + c + rest


PAIR = "word string, n long, near string, near_n long"
PAIRS = [f.split(" ")[0] for f in PAIR.split(", ")]


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs, both ways round, of rows (part, size, low, high, word, n) that come part by part."""

    def pairs(parts: list[list[tuple]]) -> pa.RecordBatch:
        machine, out = Acceptor(), []
        starts = []
        for rows in parts:
            size, low, high = rows[0][1:4]
            counts = {word[low : len(word) - size + high]: n for _, _, _, _, word, n in rows}
            starts.append((machine.add(sorted(counts)), counts))
        for rows, (start, counts) in zip(parts, starts):
            size, low, high, sample = rows[0][1:5]
            before, behind = sample[:low], sample[len(sample) - size + high :]
            for a, b in machine.near(start, high - low, high == size):
                one, two = (before + a + behind, counts[a]), (before + b + behind, counts[b])
                out += [(*one, *two), (*two, *one)]
        return pa.RecordBatch.from_pydict({f: [o[i] for o in out] for i, f in enumerate(PAIRS)}, pa.schema([(f, pa.string() if i % 2 == 0 else pa.int64()) for i, f in enumerate(PAIRS)]))

    held: list[list[tuple]] = []
    count = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "size", "low", "high", "word", "n"))):
            if held and held[-1][0][0] == row[0]:
                held[-1].append(row)
            else:
                if count >= BATCH:
                    yield pairs(held)
                    held, count = [], 0
                held.append([row])
            count += 1
    if held:
        yield pairs(held)


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` with the part that their word, with an edit between ``low`` and ``high``, belongs to."""
    ends = F.concat_ws("\0", "size", "low", "high", F.expr("left(word, low)"), F.expr("right(word, size - high)"))
    return rows.withColumn("part", ends)


def halved(rows: DataFrame) -> DataFrame:
    """Each row twice, for both halves of the stretch."""
    middle = F.expr("low + (high - low) div 2")
    halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
    return rows.select("word", "n", "size", F.explode(halves).alias("half")).select("word", "n", "size", "half.low", "half.high")


def near_words(words: DataFrame, part: int = PART, stretch: int = STRETCH) -> DataFrame:
    """Pairs (word, n, near, near_n), both ways round, of ``words`` (word, n), which are distinct."""
    length = F.char_length("word")
    # A word meets those of its length, those one shorter, and, in their rows, those one longer.
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")).where("size >= 0")
    rows = halved(rows.withColumns({"low": F.lit(0), "high": F.col("size")}).where("size > 1")).unionByName(
        rows.where("size <= 1").withColumns({"low": F.lit(0), "high": F.col("size")})
    )
    ready = None
    while True:
        rows = stage(dealt(rows), "spelling-parts")
        sizes = rows.groupBy("part").agg(F.count("*").alias("words"), F.max(F.col("high") - F.col("low")).alias("wide"))
        sizes = stage(sizes.where("words > 1"), "spelling-sizes")
        again = F.expr(f"wide > 1 AND (words > {part} OR wide > {stretch})")
        fine = rows.join(sizes.where(~again), "part", "left_semi")
        ready = fine if ready is None else ready.unionByName(fine)
        hot = sizes.where(again)
        if hot.isEmpty():
            break
        rows = halved(rows.join(hot, "part", "left_semi"))
    sorted_parts = ready.repartition(shuffle_partitions(words.sparkSession), "part").sortWithinPartitions("part")
    return sorted_parts.mapInArrow(compose, PAIR)


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for distinct ``words`` (word, n).

    ``form`` is the near word with the largest n, the smallest in code-point order
    among equals, if its n is at least ``ratio`` times the word's; else null, and
    so is form_n. ``root`` is where forms lead to. Other columns are dropped; an
    empty table stays empty; rows with a null word or n are left out.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL AND n IS NOT NULL"), "spelling-words")
    near = near_words(words)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    better = F.expr(f"-best.rank >= {int(ratio)} * n")
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.near")).alias("form"), F.when(better, -F.col("best.rank")).alias("form_n"),
    )
    known = stage(known, "spelling-forms")
    links = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the links followed; n grows by the ratio at each, so there are few
        far = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(links.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "spelling-roots")
        links = step.select("word", "root")
        if step.where("next IS NOT NULL").isEmpty():
            break
    return known.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(
    docs: DataFrame, text_col: str = "text", shortest: int = 6, least: int = 5, spoil: int | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """Words (word, n) of ``shortest`` code points found ``least`` times in all texts.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. With
    ``spoil``, a word of a document loses a letter where the checksum of
    ``<id>:<word>`` is divisible by it, at the place the checksum says; a null id
    spoils nothing. Null texts have no words.
    """
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit("([a-zÀ-ÿ]+)"), F.lit(1))
    word = F.col("word")
    found = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("word"))
    found = found.where(F.char_length(word) >= shortest)
    if spoil is not None:
        found = found.select("word", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")).alias("h"))
        cut = F.expr("concat(left(word, CAST(h % char_length(word) AS INT)), substr(word, CAST(h % char_length(word) AS INT) + 2))")
        found = found.select(F.when(F.col("h") % spoil == 0, cut).otherwise(word).alias("word")).where(F.char_length(word) >= shortest)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(vocabulary(docs, spoil=199))


#: Near words by the strings that are left when one code point is taken out.
ORACLE_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, times, {crc_sql("doc_id || ':' || run")} AS h FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
shorter AS (
  SELECT word, n, p, left(word, p) || substr(word, p + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, s.n, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, w.n, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(l := -near_n, w := near)) AS b FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.l >= 5 * n THEN b.w END AS form, CASE WHEN -b.l >= 5 * n THEN -b.l END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS place, 0 AS steps FROM forms
  UNION ALL SELECT walk.word, forms.form, steps + 1 FROM walk JOIN forms ON forms.word = walk.place WHERE forms.form IS NOT NULL),
roots AS (SELECT word, max_by(place, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
