"""Jaccard join of documents on word shingles by a MinHash LSH forest.

Documents with the same set of shingles are one class. Each class has a
signature and goes into ``trees`` prefix tries, one to a slice of it. Matched
prefixes are shortened from the full depth until pairs at the threshold share one
in some trie with the wanted probability; classes that then share a prefix and
whose signatures do not rule the pair out are candidates. Candidates are verified
exactly, on the whole sets, once for each connected group of candidates. Groups
are cut into blocks that meet pairwise, prefixes that many share into blocks as
well; a block hands on counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.bpe import blocks
from tablaris.llm.common import components, stage, table
from tablaris.llm.embedding_dedup import spanning_forest
from tablaris.llm.shingles import mixed, shingle_sets

TREES, DEPTH, RECALL = 20, 6, 0.9999
DOUBT = 0.2  # how far a signature's estimate may lie below the similarity
MEMBERS = 2048  # classes of one prefix in a block
WEIGHT = 1 << 18  # shingles in a block of a group
TEXT = 1 << 20  # characters in work at a time
RARE = 24  # a shingle held by fewer rows of two blocks is counted pair by pair


def shortened(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold is found with that probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def seeds(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for a in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[a : a + 2048, None] * factors).min(axis=0))
    return least


def summed(values: np.ndarray) -> np.ndarray:
    """One hash of each row, the order of its values included."""
    out = np.zeros(len(values), np.uint64)
    for k in range(values.shape[1]):
        out = mixed(out + values[:, k])
    return out


def candidate_labels(signs: np.ndarray, least: float) -> np.ndarray:
    """For rows of signature parts, the first row of the component under estimate >= least.

    A row that is linked with one already in its component adds nothing by being
    compared again, so whole components fall to few comparisons.
    """
    count = len(signs)
    label = np.arange(count)
    done = np.zeros(count, dtype=bool)
    for i in range(count):
        apart = label != label[i]
        if done[i] or not apart.any():
            continue
        hit = np.flatnonzero(apart)
        hit = hit[(signs[hit] == signs[i]).mean(axis=1) >= least]
        if len(hit):
            merged = np.isin(label, np.append(label[hit], label[i]))
            label[merged] = label[merged].min()
        done[i] = True
    return label


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs, exactly."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    few = (held[column] > 1) & (held[column] < RARE)
    first = np.concatenate([[0], np.cumsum(held)[:-1]])
    r, n, at = row[few], held[column[few]], first[column[few]]
    for k in range(RARE - 1):
        with_k = n > k
        np.add.at(out, (r[with_k], row[at[with_k] + k]), 1)
    many = held[column] >= RARE
    r, c = row[many], np.unique(column[many], return_inverse=True)[1]
    for a in range(0, int(c.max()) + 1 if len(c) else 0, 4096):
        own = (c >= a) & (c < a + 4096)
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[r[own], c[own] - a] = 1
        out += part @ part.T
    np.fill_diagonal(out, sizes)
    return out


def paired(df: DataFrame, key: list[str], count: Column, item: Column) -> DataFrame:
    """Rows (key, across, members): each of a key's ``count`` blocks alone, and each pair of them.

    Members are ``item`` structs with ``block`` in them; ``across`` marks pairs.
    """
    packed = df.select(*key, count.cast("int").alias("blocks"), item.alias("item"))
    packed = packed.groupBy(*key, "blocks", F.col("item.block").alias("block")).agg(F.collect_list("item").alias("items"))
    partner = F.explode(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: other != F.col("block"))).alias("partner")
    lone = packed.select(*key, F.lit(False).alias("across"), F.col("items").alias("members"))
    met = packed.where("blocks > 1").select(*key, "block", "items", partner)
    met = met.groupBy(*key, F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high")).agg(
        F.flatten(F.collect_list("items")).alias("members")
    )
    return lone.union(met.select(*key, F.lit(True).alias("across"), "members"))


def ngram_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    members: int = MEMBERS,
    weight: int = WEIGHT,
) -> DataFrame:
    """One row per input row: id, class_id, n_links, kept.

    Two documents are linked when the Jaccard similarity of their sets of
    five-word shingles is at least ``threshold``; ``n_links`` counts the other rows
    a row is linked with, equal ones included. ``class_id`` is the smallest id of
    the connected component and ``kept`` says that it is the row's own id. Texts
    without a word (null, empty) are linked with nothing. Rows that repeat an id
    are rows of their own with one class when their texts are linked; a null id
    counts, but never is a class_id where another id can be. Extra columns are
    ignored. An empty table gives an empty result.
    """
    shallow = shortened(threshold, trees, depth, recall)
    factors = seeds(trees * depth)
    source = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text"), TEXT):
                sets = shingle_sets(texts)
                signs = np.array([signature(s, factors) for s in sets])
                tries = signs.reshape(len(sets) * trees, depth)
                keys = summed(tries[:, :shallow]).astype(np.int64)
                prints = [int(mixed(np.add.reduce(s, keepdims=True))[0]) if len(s) else None for s in sets]
                rows = [
                    batch.column("id").slice(at, len(texts)),
                    pa.array(prints, pa.uint64()).cast(pa.int64(), safe=False),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.astype("<u2").tobytes() for s in signs], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * trees), pa.array(keys)),
                ]
                yield pa.RecordBatch.from_arrays(rows, ["id", "node", "n", "signs", "keys"])

    signed = stage(source.mapInArrow(sign, "id long, node long, n long, signs binary, keys array<long>"), "shingled")
    classes = signed.where("n > 0").groupBy("node").agg(
        F.min("id").alias("first"), F.count("*").alias("weight"), F.min("n").alias("n"), F.min("signs").alias("signs"), F.min("keys").alias("keys")
    )
    classes = stage(classes, "shingle-classes")
    # Prefixes that more than one class has.
    prefixes = classes.select("node", F.posexplode("keys").alias("tree", "key"))
    shared = prefixes.groupBy("tree", "key").count().where("count > 1")
    inside = prefixes.join(shared, ["tree", "key"]).join(classes.select("node", "signs"), "node")
    count = F.ceil(F.col("count") / members)
    item = F.struct("node", "signs", F.pmod(F.xxhash64("node"), count).cast("int").alias("block"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("members"):
                found = row.values
                nodes = found.field("node").to_numpy()
                signs = np.frombuffer(b"".join(found.field("signs").to_pylist()), "<u2").reshape(len(nodes), -1)
                label = candidate_labels(signs, threshold - DOUBT)
                on = label != np.arange(len(nodes))
                yield pa.RecordBatch.from_arrays([pa.array(nodes[on]), pa.array(nodes[label[on]])], ["a", "b"])

    groups = components(paired(inside, ["tree", "key"], count, item).mapInArrow(link, "a long, b long"), "candidates")
    groups = stage(groups.join(classes.select(F.col("node"), "first", "weight", "n"), "node"), "candidates")
    mass = groups.groupBy("root").agg(F.greatest(F.ceil(F.sum("n") / weight), F.ceil(F.count("*") / members)).alias("blocks"))
    # The number of candidates grows with the corpus: one plan at every size, never a broadcast.
    wanted = groups.join(mass, "root").hint("merge")
    texts = source.join(wanted, F.col("id").eqNullSafe(F.col("first")))

    def reshingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in blocks(batch.column("text"), TEXT):
                sets = shingle_sets(own)
                prints = [int(mixed(np.add.reduce(s, keepdims=True)).astype(np.int64)[0]) if len(s) else 0 for s in sets]
                rows = batch.slice(at, len(own))
                same = pa.compute.equal(rows.column("node"), pa.array(prints))  # rows that repeat an id may differ
                columns = [rows.column(c) for c in ("root", "node", "weight", "blocks")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sets], pa.binary())], ["root", "node", "weight", "blocks", "shingles"]).filter(same)

    sets = texts.select("root", "node", "weight", "blocks", "text").mapInArrow(reshingle, "root long, node long, weight long, blocks long, shingles binary")
    item = F.struct("node", "weight", "shingles", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, across in zip(batch.column("members"), batch.column("across").to_pylist()):
                found = row.values
                nodes, first = np.unique(found.field("node").to_numpy(), return_index=True)
                weights, block = (found.field(c).to_numpy()[first] for c in ("weight", "block"))
                hashes = [np.frombuffer(x, np.uint64) for x in found.field("shingles").take(pa.array(first)).to_pylist()]
                both = intersections(hashes).astype(np.float64)
                sizes = both.diagonal()
                linked = both / (sizes[:, None] + sizes - both) >= threshold
                np.fill_diagonal(linked, False)
                if across:  # what lies within a block is met where the block is alone
                    linked &= block[:, None] != block
                a, b = np.nonzero(linked)
                node, root = spanning_forest(nodes[a], nodes[b])
                zeros = np.zeros(len(node), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([nodes, node])), pa.array(np.concatenate([linked @ weights, zeros])), pa.array(np.concatenate([nodes, root]))],
                    ["node", "links", "root"],
                )

    met = paired(sets, ["root"], F.col("blocks"), item).mapInArrow(verify, "node long, links long, root long")
    met = stage(met, "verified")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "near-groups")
    linked = stage(linked.join(classes.select("node", "first"), "node"), "near-groups")
    smallest = linked.groupBy("root").agg(F.min("first").alias("class_id"))
    known = classes.select("node", "first", "weight").join(links, "node", "left")
    known = known.join(linked.join(smallest, "root").select("node", "class_id"), "node", "left")
    known = known.select(
        F.col("node").alias("known"), F.coalesce("class_id", "first").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    rows = signed.select("id", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(stage(known, "near-classes"), F.col("node") == F.col("known"), "left")
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("id").eqNullSafe(F.coalesce("class_id", "id")).alias("kept"),
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))
