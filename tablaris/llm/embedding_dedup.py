"""Near-duplicate embeddings by small-world graphs, one for each shard.

Equal vectors become one node first. Nodes are dealt to shards by a hash and
every shard builds a graph of its own. Each shard is then audited as a whole: a
fixed share of all nodes, and more until enough true links to others were seen,
is compared with the whole shard, and the beam is doubled until the graph finds
the wanted share of those links. A shard whose audit came to ask every node is
done with that; of the others, blocks of queries, which are all the nodes, stream
past the graph. A query whose whole beam consists of links may have more; it is
answered by a full scan, so no number of links is a cap, and such queries do not
count in the audit. Cosines of what was found are verified in double precision.
Each block hands on counts and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import components, stage, table
from tablaris.llm.hnsw import LINKS, Graph, Hnsw

SHARD = 65_536  # nodes to a shard, on average
BLOCK = 512  # queries to a block
SHARE = 16  # an audit begins with one query in so many
SEEN = 1000  # true links to others that an audit sees, unless it has asked every query
SCANNED = 64  # queries compared with a whole shard at a time
BEAMED = 1 << 19  # beam entries held at a time
SLACK = 1e-4  # of similarities in single precision
ROW = "shard long, part int, dim int, kind int, block long, ids binary, weights binary, vectors binary, levels int, top int, links binary, beam int"
FOUND = "node long, links long, root long"
NAMES = [c.split(" ")[0] for c in ROW.split(", ")]


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def scan(exact: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All (query, row) index pairs with cosine >= threshold, by query."""
    pairs = [np.empty((2, 0), np.int64)]
    for at in range(0, len(queries), SCANNED):
        q, rows = np.nonzero(queries[at : at + SCANNED] @ exact.T >= threshold - SLACK)
        pairs.append(np.stack([q + at, rows]))
    return verified(exact, queries, *np.concatenate(pairs, axis=1), threshold)


def verified(exact: np.ndarray, queries: np.ndarray, q: np.ndarray, rows: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    sure = [np.einsum("nd,nd->n", queries[q[at : at + BEAMED]], exact[rows[at : at + BEAMED]]) >= threshold for at in range(0, len(q), BEAMED)]
    sure = np.concatenate([np.empty(0, bool), *sure])
    return q[sure], rows[sure]


def find_links(graph: Hnsw, exact: np.ndarray, queries: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row) index pairs with cosine >= threshold, and whether each query was scanned; ``exact`` are the shard's vectors in double precision.

    A beam of 0 scans for all.
    """
    full, pairs = np.ones(len(queries), bool), [np.empty((2, 0), np.int64)]
    step = max(1, BEAMED // max(beam, 1))
    for at in range(0, len(queries) if beam else 0, step):
        ids, sims = graph.search(queries[at : at + step].astype(np.float32), beam)
        hit = sims >= threshold - SLACK
        full[at : at + step] = hit.all(axis=1)
        q, col = np.nonzero(hit & ~hit.all(axis=1, keepdims=True))
        pairs.append(np.stack([q + at, ids[q, col]]))
    q, rows = verified(exact, queries, *np.concatenate(pairs, axis=1), threshold)
    scanned = np.flatnonzero(full)
    more, more_rows = scan(exact, queries[scanned], threshold)
    return np.concatenate([q, scanned[more]]), np.concatenate([rows, more_rows]), full


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the edges a-b, by pointer jumping."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def near_embeddings(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.95,
    shard_size: int = SHARD,
    least_shards: int = 8,
    parts: int = 3,
    beam: int = 32,
    recall: float = 0.99,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    ``n_links`` counts the other rows whose cosine with this one is at least
    ``threshold``, equal vectors included, as far as they were found; nothing below
    the threshold counts. ``component_id`` is the smallest id reachable by links.
    Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing, as do vectors of different length; rows with a null id too, and
    their component is null. Rows with one id and different vectors are one node.
    Extra columns are ignored. An empty table gives an empty result. ``recall`` is
    the share of its audit's links to others that each shard's beam, from ``beam``
    on, must find; a beam of a quarter of the shard gives way to full scans.
    """
    spark = df.sparkSession
    vector = F.col(vec_col).cast("array<double>")
    usable = F.coalesce(
        F.col(id_col).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )
    rows = df.select(F.col(id_col).alias("id"), F.when(usable, F.transform(vector, lambda x: x + 0.0)).alias("v"))
    classes = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    classes = stage(classes.select("*", F.xxhash64("v").alias("h")), "vector-classes")
    count = classes.count()
    shards = max(least_shards, -(-count // shard_size))
    nodes = classes.select(
        "node", "weight", "v", F.size("v").alias("dim"), F.pmod(F.col("h"), F.lit(shards)).alias("shard"),
    )

    def packed(group: pa.Table) -> tuple[bytes, bytes, np.ndarray]:
        group = group.sort_by("node")
        flat = group.column("v").combine_chunks().flatten().to_numpy()
        return group.column("node").to_numpy().tobytes(), group.column("weight").to_numpy().tobytes(), unit_vectors(flat.reshape(len(group), -1))

    def build(key: tuple, group: pa.Table) -> pa.Table:
        ids, weights, vectors = packed(group)
        graph = Hnsw.build(vectors.astype(np.float32))
        links = np.stack([level.links for level in graph.levels]).tobytes()
        row = [key[0].as_py(), 0, key[1].as_py(), 0, -1, ids, weights, vectors.tobytes(), len(graph.levels), graph.top, links, 0]
        return pa.table([pa.array([x]) for x in row], NAMES).cast(arrow_row)

    def block(key: tuple, group: pa.Table) -> pa.Table:
        ids, weights, vectors = packed(group)
        row = [0, 0, key[1].as_py(), 1, key[0].as_py(), ids, weights, vectors.tobytes(), 0, 0, b"", 0]
        return pa.table([pa.array([x]) for x in row], NAMES).cast(arrow_row)

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow_row = pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in ROW.split(", "))])
    graphs = stage(nodes.groupBy("shard", "dim").applyInArrow(build, ROW), "vector-graphs")
    # Blocks are equal shares of the nodes at random, so the first ones are an audit's.
    numbers = SHARE * -(-count // (SHARE * BLOCK))
    dealt = nodes.withColumn("block", F.floor(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 40)) * numbers / (1 << 40)))
    blocks = stage(dealt.groupBy("block", "dim").applyInArrow(block, ROW), "vector-blocks")

    def sent(queries: DataFrame, to: DataFrame, work, out: str) -> DataFrame:
        """``work`` on the graphs of the shards in ``to`` (shard, dim, beam) and their queries.

        A shard's graph comes first, then the queries; several parts of the queries go on at once.
        """
        to = F.broadcast(to.select("shard", "dim", "beam"))
        copies = graphs.drop("part", "beam").join(to, ["shard", "dim"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
        stream = copies.select(NAMES).union(queries.drop("beam").join(to, ["shard", "dim"]).withColumn("part", part).select(NAMES))
        stream = stream.repartition("shard", "dim", "part").sortWithinPartitions("shard", "dim", "part", "kind", "block")

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                for i in range(len(batch)):
                    x = {n: batch.column(n)[i].as_py() for n in NAMES}
                    x["ids"], x["weights"] = np.frombuffer(x["ids"], np.int64), np.frombuffer(x["weights"], np.int64)
                    x["vectors"] = np.frombuffer(x["vectors"]).reshape(-1, x["dim"])
                    if x["kind"] == 0:
                        levels = []
                        for links in np.frombuffer(x["links"], np.int32).reshape(x["levels"], len(x["ids"]), 2 * LINKS):
                            levels.append(Graph(x["vectors"].astype(np.float32) if not levels else levels[0].vectors))
                            levels[-1].links = links
                        held, graph = x, Hnsw(levels[0].vectors, levels, x["top"])
                    elif [held[n] for n in key] == [x[n] for n in key]:
                        yield from work(graph, held, x)

        key = ["shard", "dim", "part"]
        return stream.mapInArrow(each, out)

    def to_all(queries: DataFrame, to: DataFrame) -> DataFrame:
        return queries.drop("shard").join(F.broadcast(to.select("shard", "dim")), "dim")  # a shard may hold no vector of this length

    def true_links(graph: Hnsw, own: dict, x: dict) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(x["ids"]), SCANNED):
            ids, vectors = x["ids"][at : at + SCANNED], x["vectors"][at : at + SCANNED]
            q, r = scan(own["vectors"], vectors, threshold)
            other = ids[q] != own["ids"][r]
            linked, q = np.unique(q[other], return_inverse=True)
            if len(linked):
                pairs = np.stack([q, r[other]]).astype(np.int32).tobytes()
                row = [x["shard"], 0, x["dim"], 2, x["block"], ids[linked].tobytes(), x["weights"][at : at + SCANNED][linked].tobytes(), vectors[linked].tobytes(), 0, len(q), pairs, 0]
                yield pa.table([pa.array([v]) for v in row], NAMES).cast(arrow_row).to_batches()[0]

    def measured(graph: Hnsw, own: dict, x: dict) -> Iterator[pa.RecordBatch]:
        true_q, true_r = np.frombuffer(x["links"], np.int32).reshape(2, -1).astype(np.int64)
        q, r, full = find_links(graph, own["vectors"], x["vectors"], threshold, own["beam"])
        rest = ~full[true_q]
        size = len(own["ids"])
        got = np.isin(true_q[rest] * size + true_r[rest], q * size + r)
        yield pa.RecordBatch.from_pydict({"shard": [x["shard"]], "dim": pa.array([x["dim"]], pa.int32()), "true": [len(got)], "got": [int(got.sum())]})

    def look(graph: Hnsw, own: dict, x: dict) -> Iterator[pa.RecordBatch]:
        if x["kind"] == 2:
            q, r = np.frombuffer(x["links"], np.int32).reshape(2, -1)
        else:
            q, r, _ = find_links(graph, own["vectors"], x["vectors"], threshold, own["beam"])
        ids = x["ids"]
        other = ids[q] != own["ids"][r]
        q, r = q[other], r[other]
        links = np.bincount(q, own["weights"][r], len(ids)).astype(np.int64)
        node, root = spanning_forest(ids[q], own["ids"][r])
        linked = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[linked], node])), pa.array(np.concatenate([links[linked], np.zeros(len(node), np.int64)])), pa.array(np.concatenate([ids[linked], root]))],
            ["node", "links", "root"],
        )

    # Audits: true links of one block in SHARE, then of twice as many blocks where too few were seen.
    every = stage(graphs.select("shard", "dim", F.expr("length(ids) div 8").alias("size"), F.lit(0).alias("beam")), "vector-shards")
    asked, truths, low, high = every, blocks.limit(0), 0, numbers // SHARE
    while True:
        part = to_all(blocks.where((F.col("block") >= low) & (F.col("block") < high)), asked)
        truths = truths.union(stage(sent(part, asked, true_links, ROW), "vector-truths"))
        seen = truths.groupBy("shard", "dim").agg(F.sum("top").alias("seen"))
        few = stage(asked.join(seen, ["shard", "dim"], "left").where(F.coalesce("seen", F.lit(0)) < SEEN).select(every.columns), "vector-shards")
        if high >= numbers or few.isEmpty():
            break
        asked, low, high = few, high, 2 * high
    complete = asked if high >= numbers else every.limit(0)
    left, settled = every.join(complete, ["shard", "dim"], "left_anti").select(every.columns), every.limit(0)
    while not left.isEmpty():
        settled = settled.union(left.where(F.col("size") <= 4 * beam).withColumn("beam", F.lit(0)))  # a scan costs less
        left = left.where(F.col("size") > 4 * beam).withColumn("beam", F.lit(beam))
        rates = sent(truths, left, measured, "shard long, dim int, true long, got long").groupBy("shard", "dim").agg(F.sum("true").alias("true"), F.sum("got").alias("got"))
        rated = stage(left.join(rates, ["shard", "dim"], "left"), "vector-rates")
        enough = F.coalesce(F.col("got") >= recall * F.col("true"), F.lit(True))  # null: each query with links is scanned
        settled = settled.union(rated.where(enough).select(every.columns))
        left, beam = rated.where(~enough).select(every.columns), 2 * beam
    settled = stage(settled, "vector-beams")
    found = sent(to_all(blocks, settled), settled, look, FOUND).union(sent(truths, complete, look, FOUND))
    found = stage(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select(F.col("v").alias("cv"), F.col("h"), "node", "weight").join(links, "node", "left").join(linked, "node", "left")
    known = stage(known.select("cv", "h", "node", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")), "vector-known")
    rows = rows.withColumn("rh", F.xxhash64("v"))
    return rows.join(known, (F.col("rh") == F.col("h")) & (F.col("v") == F.col("cv")), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("root", "id"), F.lit(False)).alias("kept"),
    )


def op9_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
