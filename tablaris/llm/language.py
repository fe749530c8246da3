"""Language identification by prediction by partial matching.

For each language a byte context tree of orders 0 to 4 is learned: how often
each byte followed each context. A text's code length under a language is the
sum over its bytes of the exact cost under the frozen counts: a byte seen in the
longest context costs its share there (escape method C), otherwise the escape
costs its share and the next shorter context is asked, down to a uniform byte.
The language with the shortest code wins.

Trees are learned from a bounded sample of labelled rows, counted by Spark; all
texts are then scored whole, in one pass and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablaris.llm.bpe import blocks
from tablaris.llm.common import once, table
from tablaris.llm.lookup import HashIndex

LONGEST = 5  # bytes of a context and its symbol
PAD = b"\n" * (LONGEST - 1)  # what precedes a text
STEP = 1 << 19  # bytes scored at a time
SALTS = 32  # groups that the sample of a language is drawn in first
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes that end at each place from LONGEST - 1 on, as one number."""
    places = len(data) - LONGEST + 1
    out = np.zeros(places, dtype=np.uint64)
    for back in range(length - 1, -1, -1):
        out = out << np.uint64(8) | data[LONGEST - 1 - back : LONGEST - 1 - back + places]
    return out


@dataclass
class ContextTrees:
    """Frozen counts of all languages, and the costs that follow from them."""

    languages: list[str]
    counts: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: keys, counts (key, language)

    def __post_init__(self) -> None:
        self.symbols: dict[int, tuple[HashIndex, np.ndarray]] = {}
        self.escapes: dict[int, tuple[HashIndex, np.ndarray]] = {}
        for length in range(1, LONGEST + 1):
            keys, counts = self.counts[length]
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(self.languages)))
            np.add.at(total, at, counts)
            np.add.at(kinds, at, counts > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log((total + kinds) / kinds), 0.0)
                seen = np.log((total + kinds)[at] / counts)
            unseen = escape[at] + self.cost(keys & np.uint64((1 << 8 * (length - 1)) - 1), length - 1)
            self.symbols[length] = HashIndex(keys), np.where(counts > 0, seen, unseen).astype(np.float32)
            self.escapes[length] = HashIndex(contexts), np.vstack([escape, np.zeros(len(self.languages))]).astype(np.float32)

    def only_costs(self) -> ContextTrees:
        """The same without the counts, which scoring does not need."""
        self.counts = {}
        return self

    def cost(self, keys: np.ndarray, length: int = LONGEST) -> np.ndarray:
        """Natural code length of the last byte of each gram, by language."""
        if length == 0:
            return np.full((len(keys), len(self.languages)), np.log(256), dtype=np.float32)
        index, costs = self.symbols[length]
        at = index.find(keys)
        out = costs[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            contexts, escapes = self.escapes[length]
            rest = keys[miss]
            out[miss] = escapes[contexts.find(rest >> np.uint64(8))] + self.cost(rest & np.uint64((1 << 8 * (length - 1)) - 1), length - 1)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each whole text by language."""
        out = np.zeros((len(texts), len(self.languages)))
        data = np.frombuffer(PAD + PAD.join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) + len(PAD) for t in texts])  # a text ends where the next one's padding begins
        starts = ends - np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        where = np.arange(len(owner)) + np.repeat(starts - np.concatenate([[0], np.cumsum(ends - starts)[:-1]]), ends - starts)
        keys = grams(data, LONGEST)[where - len(PAD)]
        for a in range(0, len(keys), STEP):
            own = owner[a : a + STEP]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[first]] += np.add.reduceat(self.cost(keys[a : a + STEP]), first, axis=0, dtype=np.float64)
        return out


COUNT = "lang string, length int, gram long, count long"


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", order: Column | None = None, docs: int = 300) -> ContextTrees:
    """Context trees of every language in ``lang_col``.

    Learns from at most ``docs`` rows a language, the first in ``order`` (a hash of
    the text by default; of rows at one place the least text), whole texts, all their
    grams; the number of these rows bounds the model. Rows with a null text or
    language are not used; without any other row no language is learned.
    """
    rows = df.select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), (F.xxhash64(text_col) if order is None else order).alias("place")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    # Places are ranked without the texts, in salted groups first, so that a task gets as many
    # as there are salts times ``docs`` at most; ``docs`` of them a language are broadcast.
    ranked = rows.select("lang", "place").distinct().withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        ranked = ranked.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("place"))).where(F.col("n") <= docs).drop("n")
    first = F.broadcast(ranked.drop("salt"))
    sample = rows.join(first, ["lang", "place"]).groupBy("lang", "place").agg(F.min("text").alias("text")).select("lang", "text")
    names = [f.split(" ")[0] for f in COUNT.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at, texts in blocks(batch.column("text")):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(langs[at:], texts):
                    by_lang.setdefault(lang, []).append(text.encode())
                for lang, own in by_lang.items():
                    found = [np.frombuffer(PAD + t, dtype=np.uint8) for t in own if t]
                    for length in range(1, LONGEST + 1):
                        all_grams = np.concatenate([grams(d, length) for d in found] or [np.zeros(0, np.uint64)])
                        keys, n = np.unique(all_grams, return_counts=True)
                        columns = [pa.array([lang] * len(keys)), pa.array(np.full(len(keys), length, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n)]
                        yield pa.RecordBatch.from_arrays(columns, names)

    counted = sample.mapInArrow(count, COUNT).groupBy("lang", "length", "gram").agg(F.sum("count").alias("count"))
    rows = counted.toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    lang = np.searchsorted(np.array(languages), np.array(rows.column("lang").to_pylist(), dtype=str)) if languages else np.zeros(0, int)
    length, gram, n = (rows.column(c).to_numpy() for c in ("length", "gram", "count"))
    counts = {}
    for m in range(1, LONGEST + 1):
        keys, at = np.unique(gram[length == m].astype(np.uint64), return_inverse=True)
        counts[m] = keys, np.zeros((len(keys), len(languages)), dtype=np.int32)
        counts[m][1][at, lang[length == m]] = n[length == m]
    return ContextTrees(languages, counts)


def identify(df: DataFrame, trees: ContextTrees, text_col: str = "text") -> DataFrame:
    """``df`` with lang_pred, score and bits_per_byte; columns of these names are replaced.

    ``score`` is the winner's share when all languages are equally likely before
    the text is seen; of equally short codes the first language by name wins.
    Null texts and texts without a letter, and all texts where no language was
    learned, are ``und`` with score 0 and null bits_per_byte. Rows may repeat; an
    empty table stays empty.
    """
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("bits_per_byte", T.DoubleType())]
    kept = [f for f in df.schema if f.name not in dict(added)]
    schema = T.StructType([*kept, *[T.StructField(*a) for a in added]])
    shared = df.sparkSession.sparkContext.broadcast((trees.languages, trees.counts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = once(shared, lambda v: ContextTrees(*v).only_costs())
        for batch in batches:
            for at, texts in blocks(batch.column(text_col)):
                some = [i for i, t in enumerate(texts) if model.languages and LETTER.search(t)]
                names, score, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
                if some:
                    data = [texts[i].encode() for i in some]
                    cost = model.score(data)
                    best = cost.argmin(axis=1)
                    least = cost.min(axis=1)
                    share = 1 / np.exp(least[:, None] - cost).sum(axis=1)
                    for i, d, b, c, s in zip(some, data, best.tolist(), least.tolist(), share.tolist()):
                        names[i], score[i], bits[i] = model.languages[b], s, c / np.log(2) / len(d)
                rows = batch.slice(at, len(texts))
                columns = [rows.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())], [f.name for f in schema]
                )

    return df.mapInArrow(work, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """One id in four; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit_documents(docs: DataFrame) -> ContextTrees:
    """Trees from the labelled documents that are not held out; a null id is held out."""
    return fit(docs.where(~held_out()), order=F.xxhash64("doc_id"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    said = identify(docs.select("doc_id", "text", held_out().alias("held_out")), fit_documents(docs))
    return said.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
