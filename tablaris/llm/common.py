"""Helpers that several of these operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.sources.staging import staging_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return a scan of it.

    This is how lineage is cut: an executor lost later costs a reread only.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: DuckDB: table ``crc`` (one row: t, the 256 steps of CRC-32) and the checksum of a text expression beside it.
CRC_TABLE = """crc AS (SELECT list(v ORDER BY b) AS t FROM (
  SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) bytes(b)))"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes, where ``crc`` is joined."""
    byte = f"('0x' || hex(encode({text}))[2 * i + 1 : 2 * i + 2])::BIGINT"
    steps = f"list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({text}))), lambda i: {byte}))"
    return f"xor(4294967295, list_reduce({steps}, lambda c, x: xor(c >> 8, crc.t[xor(c & 255, x) + 1])))"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_built: dict[object, tuple[object, object]] = {}


def once(shared, build):
    """``build(shared.value)``, made once in each Python worker; ``shared`` is a broadcast.

    Of each place that builds something a worker keeps the last one only, so what
    several jobs in turn build does not add up.
    """
    held, built = _built.get(build.__code__, (None, None))
    if held is not shared:
        _built.pop(build.__code__, None)
        built = build(shared.value)
        _built[build.__code__] = shared, built
    return built


def components(edges: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as rows (node, root).

    ``root`` is the smallest node reachable. Alternates large-star and
    small-star steps (Kiveris et al. 2014) until a step changes nothing; each is
    a partial minimum and one join whose hot side adaptive execution can split,
    and each round is written to the checkpoint folder. Self-loops and repeated
    edges are allowed; a node that is only in a self-loop is its own root. The
    number of rounds grows with the logarithm of the longest path; if ``rounds``
    do not suffice, this raises.
    """
    current = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    alone = edges.where("a = b").select(F.col("a").alias("node"))
    before = None
    for _ in range(rounds):
        # Large star: neighbours above u hang on the smallest of u's surroundings.
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), label)
        # Small star: u and its neighbours below hang on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        current = stage(small.where("u <> v").distinct(), label)
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tree = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = tree.select(F.col("root").alias("node")).union(alone).distinct()
    roots = roots.join(tree.select("node"), "node", "left_anti")
    return tree.union(roots.select("node", F.col("node").alias("root")))
