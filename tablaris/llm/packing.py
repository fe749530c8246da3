"""Packing of tokenized documents: first-fit decreasing in randomised groups.

Documents become pieces of at most ``capacity`` tokens where they are read; only
the pieces' sizes are shuffled. Pieces are dealt to groups at random, by a hash,
and each group is packed by itself: pieces by falling size, each into the first
bin that has room, found in logarithmic time in a tournament tree whose inner
nodes hold the largest room below them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.llm.bpe import Bpe, ragged, slices
from tablaris.llm.common import once, table

CAPACITY = 1024
GROUP = 20_000  # documents to a group, on average


PIECE = "start long, length long, tokens long, ids binary, place long"


def pieces(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, size: int = CAPACITY
) -> DataFrame:
    """Pieces of each text: id, start, length, tokens (of the text), ids, place.

    ``ids`` are little-endian 32-bit numbers; the text's last one is ``end_id``,
    the others are what the tokenizers library gives at its default settings
    without adding special tokens (an added token in a text has its listed id); so a
    null or empty text is one piece of one id. ``place`` tells rows apart that are
    the same in all else. Rows may repeat; an empty table gives none.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    end = np.uint32(end_id).tobytes()
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([source.schema["id"], *T.StructType.fromDDL(PIECE)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = once(shared, lambda text: Bpe.of_tokenizer(text, public_tokenizers.PATTERN, encode_special_tokens=False)), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                ids, ends = encoder.gather(texts)
                whole = np.diff(ends) + 1  # with the closing id
                ids = np.insert(ids, ends[1:], np.frombuffer(end, "<i4"))
                parts = -(-whole // size)
                row = np.repeat(np.arange(len(texts)), parts)
                start = ragged(np.zeros(len(parts), np.int64), parts) * size
                length = np.minimum(whole[row] - start, size)
                offsets = 4 * np.concatenate([[0], np.cumsum(length)])
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                columns = [start, length, whole[row], binary.cast(pa.binary()), np.arange(place, place + len(row))]
                place += len(row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at + row)), *map(pa.array, columns)], [f.name for f in schema])

    return source.mapInArrow(work, schema)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; sizes are at most ``capacity``."""
    order = np.argsort(-sizes, kind="stable")
    leaves = 1 << max(1, (len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)  # node i has children 2i and 2i + 1
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        left = room[node] - size
        room[node] = left
        while node > 1:
            node >>= 1
            left = max(room[2 * node], room[2 * node + 1])
            if room[node] == left:
                break
            room[node] = left
    return bins, offsets


def pack(df: DataFrame, groups: int, size_col: str = "length", key: list[str] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``df`` with sequence_id and offset; columns of these names are replaced.

    Rows are dealt to ``groups`` by a hash of ``key`` (all columns by default) and
    placed first-fit decreasing, ties by the key. Sizes must lie between 1 and
    ``capacity``; rows of null or other sizes fail the job. Sequences number from
    ``group << 32``; offsets in one run from 0 without a gap.
    """
    rows = df.drop("sequence_id", "offset", "_group")
    key = key or rows.columns
    schema = T.StructType([*rows.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def work(group: pa.Table) -> pa.Table:
        number = group.column("_group")[0].as_py()
        own = group.drop_columns(["_group"]).sort_by([(k, "ascending") for k in key])
        sizes = own.column(size_col).to_numpy()
        if sizes.dtype.kind != "i" or sizes.min() < 1 or sizes.max() > capacity:
            raise ValueError(f"sizes must lie between 1 and {capacity}")
        bins, offsets = first_fit_decreasing(sizes, capacity)
        return own.append_column("sequence_id", pa.array(bins + (number << 32))).append_column("offset", pa.array(offsets))

    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(*key), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(work, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pieces of all documents with their checksum and place; see the two steps."""
    cut = pieces(docs.select("doc_id", "text"), tokenizer_path, size=capacity)
    sized = cut.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), "place"
    )
    placed = pack(sized, 1 + docs.count() // group, key=["place"], capacity=capacity)
    return placed.drop("place")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
