"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes when a string of ``length`` bytes over it also starts earlier.
Sorting every suffix would move the corpus many times over, so only anchored
suffixes are sorted: each string of ``length`` bytes names as anchor the place in
it where a block of BLOCK bytes hashes lowest, and equal strings name the same
place. Anchors whose block occurs once cannot lie in a repeated string and leave
before the sort; nothing else does, so the result is exact.

Suffixes of the remaining anchors are sorted where the texts are read, and the
sorted runs, front-coded, are exchanged by their first block. A loser tree merges
the runs of a part; it carries with each run the prefix it shares with the last
suffix put out, so bytes known to be equal are not compared again. The order and
its common prefixes, with the same for what precedes the anchors, decide for all
strings at once which of them started earlier.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablaris.llm.bpe import blocks
from tablaris.llm.common import shuffle_partitions, stage, table
from tablaris.llm.shingles import mixed

LENGTH = 100  # bytes of a repeated string
BLOCK = 32  # bytes that an anchor is chosen by; a power of two
RUN = 50_000  # suffixes sorted at a time
HOT = 100_000  # anchors of one block beyond which its strings are matched by digest
TEXT = 1 << 20  # characters in work at a time
PIECE = 1 << 16  # bytes whose anchors are found at a time; the arrays for them stay in the processor's cache
MULTIPLIER = 0x9E3779B97F4A7C55


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, block hash) of the anchors of every string of ``length`` bytes.

    Where a string's lowest hash occurs several times, all of its places are anchors.
    """
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < BLOCK:
        hashes = hashes[:-width] * np.uint64(pow(MULTIPLIER, width, 1 << 64)) + hashes[width:]
        width *= 2
    hashes = mixed(hashes)
    lowest = sliding(hashes, length - BLOCK + 1, np.minimum)
    inside = np.zeros(len(lowest) + 1, np.int32)  # strings that lie within one text
    long = sizes >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, (starts + sizes - length + 1)[long], -1)
    lowest[np.cumsum(inside)[:-1] == 0] = 0
    around = np.zeros(length - BLOCK, np.uint64)
    highest = sliding(np.concatenate([around, lowest, around]), length - BLOCK + 1, np.maximum)
    at = np.flatnonzero(highest == hashes)
    text = np.searchsorted(starts, at, side="right") - 1
    return text, at - starts[text], hashes[at]


def anchors_by_piece(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`anchors`, whole texts of about PIECE bytes together at a time."""
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // PIECE)) + 1).tolist(), len(texts)]
    found = [(a, anchors(texts[a:b], length)) for a, b in zip(cuts, cuts[1:])]
    which, place, block = (np.concatenate(x) for x in zip(*[(text + a, at, h) for a, (text, at, h) in found]))
    return which, place, block


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row of a matrix shares with the row before; 0 for the first."""
    if not len(rows):
        return np.zeros(0, np.int64)
    differ = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])])


def in_order(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Order of all suffixes and the prefix each shares with the one before.

    A run is sorted suffixes of equal length and the prefixes they share. Suffixes
    number through the runs. A loser tree: every inner node keeps the run that lost
    there and the prefix it shares with the winner that passed.
    """
    first = np.concatenate([[0], np.cumsum([len(r[0]) for r in runs])]).tolist()
    count = len(runs)
    at = [0] * count
    shared = [0] * count  # with the last suffix put out
    losers = [-1] * count
    order: list[int] = []
    lcps: list[int] = []
    ended = [not r[0] for r in runs]

    def better(a: int, b: int) -> bool:
        """Whether run a's head goes before b's; updates the loser's shared prefix."""
        if ended[a] or ended[b]:
            return not ended[a]
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        known = shared[a]
        x, y = runs[a][0][at[a]], runs[b][0][at[b]]
        p, q = int.from_bytes(x[known:]), int.from_bytes(y[known:])
        same = len(x) - ((p ^ q).bit_length() + 7) // 8
        if p < q or p == q and a < b:
            shared[b] = same
            return True
        shared[a] = same
        return False

    def play(node: int) -> int:
        """Winner below ``node`` (leaves are count .. 2 * count - 1), losers put in place."""
        if node >= count:
            return node - count
        a, b = play(2 * node), play(2 * node + 1)
        won = better(a, b)
        losers[node] = b if won else a
        return a if won else b

    winner = play(1) if count > 1 else 0
    while not ended[winner]:
        i = at[winner]
        order.append(first[winner] + i)
        lcps.append(shared[winner])
        at[winner] = i + 1
        if i + 1 == len(runs[winner][0]):
            ended[winner] = True
        else:
            shared[winner] = runs[winner][1][i + 1]
        node = (winner + count) // 2
        while node >= 1 and count > 1:
            if not better(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2
    return order, lcps


def encode_run(right: np.ndarray, left: np.ndarray, spare: np.ndarray, owner: np.ndarray) -> bytes:
    """A sorted run: shared prefixes and the bytes after them."""
    lcp = common_prefix(right)
    tails = right[np.arange(right.shape[1]) >= lcp[:, None]]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((lcp.astype(np.uint8), tails, left, spare, owner)))


def decode_run(run: bytes, length: int) -> tuple:
    lcp, tails, left, spare, owner = pickle.loads(zstandard.ZstdDecompressor().decompress(run))
    data, ends, before, suffixes = tails.tobytes(), np.cumsum(length - lcp.astype(np.int64)).tolist(), b"", []
    start = 0
    for shared, end in zip(lcp.tolist(), ends):
        before = before[:shared] + data[start:end]
        suffixes.append(before)
        start = end
    return suffixes, lcp.tolist(), left, spare, owner


def repeats(order: np.ndarray, lcps: np.ndarray, left: np.ndarray, spare: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """Matrix (suffix, o): whether the string that starts o before the anchor also starts earlier.

    ``spare`` are the bytes there are before and after the anchor; ``owner`` is
    (id, text hash, anchor's place), which orders strings with the same o.
    """
    count, reach = left.shape
    rank = np.lexsort(owner.T[::-1])
    who = np.cumsum(np.concatenate([[0], (owner[rank][1:] != owner[rank][:-1]).any(axis=1)]))  # equal for rows that are one document
    back = in_order(left)
    back_lcp = common_prefix(left[back])
    # From here on suffixes go by rank, so that the first of a group started earliest.
    forth_at, back_at = np.empty(count, np.int64), np.empty(count, np.int64)
    forth_at[order], back_at[back] = np.arange(count), np.arange(count)
    forth_at, back_at, before, after = forth_at[rank], back_at[rank], spare[rank, 0], spare[rank, 1]
    out = np.zeros((reach + 1, count), dtype=bool)
    for o in range(reach + 1):
        own = np.flatnonzero((before >= o) & (after >= length - o))
        forth = np.cumsum(lcps < length - o, dtype=np.int32)[forth_at[own]]
        backward = np.cumsum(back_lcp < o, dtype=np.int32)[back_at[own]]
        paired = (np.bincount(forth, minlength=1)[forth] > 1) & (np.bincount(backward, minlength=1)[backward] > 1)
        own, key = own[paired], forth[paired].astype(np.int64) * (count + 1) + backward[paired]
        sorted_key, by_key = sorted_groups(key, count)
        first = np.maximum.accumulate(np.where(np.diff(sorted_key, prepend=-1) != 0, np.arange(len(own)), 0))
        sorted_own = own[by_key]
        out[o, rank[sorted_own]] = who[sorted_own] != who[sorted_own[first]]
    return np.ascontiguousarray(out.T)


def sorted_groups(key: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below (count + 1) squared in order, and where each was; equal ones stay in their order.

    Key and place are sorted as one number where they fit in it, which takes far less time.
    """
    if count >= 1 << 20:
        by_key = np.argsort(key, kind="stable")
        return key[by_key], by_key
    both = np.sort(key << 20 | np.arange(len(key)))
    return both >> 20, both & ((1 << 20) - 1)


def spans_of(repeated: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes under runs of repeated strings."""
    edge = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    return row, place[row] - last, place[row] - first + length


def window_hashes(rows: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of each run of ``length`` bytes in each row."""
    sums = np.zeros((rows.shape[1] + 1, len(rows)), np.uint64)
    for k in range(rows.shape[1]):
        sums[k + 1] = sums[k] * np.uint64(base) + rows[:, k] + np.uint64(1)
    return mixed(sums[length:] - sums[:-length] * np.uint64(pow(base, length, 1 << 64))).T


def common_strings(context: np.ndarray, spare: np.ndarray, owner: np.ndarray, length: int) -> tuple[tuple, tuple]:
    """For anchors of common blocks, strings by 128-bit digest, combined here first.

    Returns (id, hash, start, end) of the bytes under strings that start earlier
    among these, and (id, hash, start, end, d1, d2) of each digest's first string.
    """
    reach = context.shape[1] - length
    found = []
    for a in range(0, len(context), 4096):
        own = slice(a, a + 4096)
        back = reach - np.arange(reach + 1)
        row, column = np.nonzero((spare[own, :1] >= back) & (spare[own, 1:] >= length - back))
        digests = [window_hashes(context[own], length, base)[row, column].astype(np.int64) for base in (MULTIPLIER, 0xD6E8FEB86659FD93)]
        found.append(np.stack([owner[own][row, 0], owner[own][row, 1], owner[own][row, 2] - back[column], *digests], axis=1))
    strings = np.concatenate(found)
    strings = strings[np.lexsort(strings.T[2::-1])]
    strings = strings[np.concatenate([[True], (strings[1:, :3] != strings[:-1, :3]).any(axis=1)])]  # one for each place
    by_digest = np.lexsort([strings[:, k] for k in (2, 1, 0, 4, 3)])
    sorted_digests = strings[by_digest, 3:]
    first = np.zeros(len(strings), dtype=bool)
    first[by_digest] = np.concatenate([[True], (sorted_digests[1:] != sorted_digests[:-1]).any(axis=1)])
    later, opened = strings[~first], strings[first]
    cut = np.concatenate([[True], (later[1:, :2] != later[:-1, :2]).any(axis=1) | (later[1:, 2] - later[:-1, 2] > length)]) if len(later) else np.zeros(0, bool)
    begin = np.flatnonzero(cut)
    last = np.append(begin[1:], len(later))[: len(begin)] - 1
    removed = (later[begin, 0], later[begin, 1], later[begin, 2], later[last, 2] + length)
    return removed, (opened[:, 0], opened[:, 1], opened[:, 2], opened[:, 2] + length, opened[:, 3], opened[:, 4])


def listed(lists: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's list of structs begins among all of them (null: empty), with the end, and their fields."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), [f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten()]


def merged_spans(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each row, as of :func:`listed`, in order and joined where they overlap or touch."""
    count = len(ends) - 1
    row = np.repeat(np.arange(count), np.diff(ends))
    far = row << 40  # rows lie apart, as no text has so many bytes
    by_start = np.argsort(starts + far, kind="stable")
    row, first, reached = row[by_start], (starts + far)[by_start], np.maximum.accumulate((stops + far)[by_start])
    begin = np.flatnonzero(np.concatenate([[True], first[1:] > reached[:-1]])) if len(row) else np.zeros(0, np.int64)
    last = np.append(begin[1:], len(row))[: len(begin)] - 1
    far = row[begin] << 40
    return np.concatenate([[0], np.cumsum(np.bincount(row[begin], minlength=count))]).astype(np.int64), first[begin] - far, reached[last] - far


SPAN = "id long, hash long, start long, end long, d1 long, d2 long"
SPANS = [c.split(" ")[0] for c in SPAN.split(", ")]
LAST = (1 << 63) - 1


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """One row per input row: id, kept (binary), spans (removed, merged, in bytes), n_bytes.

    ``length`` is at most 255. Null text is empty. Strings are judged on the input;
    the one with the smallest (id, place) stays, null ids last. Rows that repeat an
    id are told apart by their texts; rows equal in id and text are one document
    and get the same result. Extra columns are ignored. An empty table gives an
    empty result.
    """
    reach = length - BLOCK
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"), F.col(id_col).alias("given"))
    parts = 4 * shuffle_partitions(df.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column("text"), TEXT):
                which, place, block = anchors_by_piece([t.encode() for t in texts], length)
                owner = np.stack([batch.column(c).slice(at, len(texts)).to_numpy()[which] for c in ("id", "hash")] + [place], axis=1)
                # Of a block's anchors here one row is made, so a common one is not many rows.
                _, first, same, n = np.unique(block, return_index=True, return_inverse=True, return_counts=True)
                by_block = np.argsort(same, kind="stable")
                begin = np.concatenate([[0], np.cumsum(n)])
                keep = np.sort(first)
                more = [owner[by_block[begin[g] + 1 : begin[g + 1]]].tobytes() if n[g] > 1 else None for g in same[keep]]
                columns = [block[keep].astype(np.int64), *owner[keep].T, n[same[keep]]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(more, pa.binary())], ["block", "id", "hash", "place", "n", "more"])

    found = source.select("id", "hash", "text").mapInArrow(find, "block long, id long, hash long, place long, n long, more binary")
    held = found.withColumn("held", F.sum("n").over(Window.partitionBy("block"))).where("held > 1")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [np.frombuffer(m or b"", np.int64).reshape(-1, 3) for m in batch.column("more").to_pylist()]
            owner = np.concatenate([np.stack([batch.column(c).to_numpy() for c in ("id", "hash", "place")], axis=1), *more])
            extra = [len(m) for m in more]
            others = [np.concatenate([x, np.repeat(x, extra)]) for x in (batch.column("block").to_numpy(), batch.column("held").to_numpy() > hot)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, [*owner.T.copy(), *others])], ["id", "hash", "place", "block", "hot"])

    repeated = held.select("block", "id", "hash", "place", "more", "held").mapInArrow(spread, "id long, hash long, place long, block long, hot boolean")
    wanted = repeated.groupBy("id", "hash").agg(F.collect_list(F.struct("place", "block", "hot")).alias("at"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = pa.array([pack.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "hash", "given")], packed], ["id", "hash", "given", "packed"])

    small = source.mapInArrow(shrink, f"id long, hash long, given {df.schema[id_col].dataType.simpleString()}, packed binary")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, waiting, many = zstandard.ZstdDecompressor(), [], 0

        def runs() -> Iterator[pa.RecordBatch]:
            right, left, spare, owner, part, is_hot = (np.concatenate(x) for x in zip(*waiting))
            common = np.flatnonzero(~is_hot)
            lead = part[common].astype(">u4").view(np.uint8).reshape(-1, 4)
            common = common[in_order(np.concatenate([lead, right[common]], axis=1))]
            cuts = np.flatnonzero(np.diff(part[common])) + 1
            rows = [(int(part[own[0]]), encode_run(right[own], left[own], spare[own], owner[own])) for own in np.split(common, cuts) if len(own)]
            if is_hot.any():
                # Each run is complete in itself, so these go to parts by chance.
                packed = pickle.dumps(common_strings(np.concatenate([left[is_hot, ::-1], right[is_hot]], axis=1), spare[is_hot], owner[is_hot], length))
                rows.append((-1 - int(owner[is_hot][0, 1]) % parts, zstandard.ZstdCompressor(level=1).compress(packed)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["part", "run"])

        for batch in batches:
            ends, (places, at_blocks, hots) = listed(batch.column("at"))
            ids, hashes = (batch.column(c).to_numpy() for c in ("id", "hash"))
            for i, packed in enumerate(batch.column("packed").to_pylist()):
                data, own = np.frombuffer(unpack.decompress(packed), np.uint8), slice(ends[i], ends[i + 1])
                place = places[own]
                padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)])
                context = padded[place[:, None] + np.arange(reach + length)]
                spare = np.stack([np.minimum(place, reach), np.minimum(len(data) - place, length)], axis=1).astype(np.int16)
                owner = np.stack([np.full(len(place), ids[i]), np.full(len(place), hashes[i]), place], axis=1)
                waiting.append((context[:, reach:], context[:, reach - 1 :: -1] if reach else context[:, :0], spare, owner, at_blocks[own] % parts, hots[own]))
                many += len(place)
                if many >= RUN:
                    yield from runs()
                    waiting, many = [], 0
        if many:
            yield from runs()

    pieces = small.drop("given").join(wanted, ["id", "hash"])
    dealt = pieces.select("id", "hash", "packed", "at").mapInArrow(sort, "part long, run binary").repartition("part").sortWithinPartitions("part")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = None, []

        def settle() -> Iterator[pa.RecordBatch]:
            runs = [decode_run(run, length) for run in waiting]
            order, lcps = merge_runs([r[:2] for r in runs])
            left, spare, owner = (np.concatenate([r[k] for r in runs]) for k in (2, 3, 4))
            # Rows equal in id and text come as one.
            row, start, end = spans_of(repeats(np.array(order), np.array(lcps), left, spare, owner, length), owner[:, 2], length)
            columns = [owner[row, 0], owner[row, 1], start, end, None, None]
            yield rows_of(*columns)

        def rows_of(*columns: np.ndarray | None) -> pa.RecordBatch:
            empty = pa.nulls(len(columns[0]), pa.int64())
            return pa.RecordBatch.from_arrays([empty if c is None else pa.array(np.ascontiguousarray(c)) for c in columns], SPANS)

        for batch in batches:
            for part, run in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist()):
                if part < 0:  # strings of common blocks, matched by digest further on
                    removed, open_strings = pickle.loads(zstandard.ZstdDecompressor().decompress(run))
                    yield rows_of(*removed, None, None)
                    yield rows_of(*open_strings)
                    continue
                if part != held and waiting:
                    yield from settle()
                    waiting = []
                held = part
                waiting.append(run)
        if waiting:
            yield from settle()

    spans = stage(dealt.mapInArrow(merge, SPAN), "suffix-spans")
    hot_strings = spans.where("d1 IS NOT NULL")
    earliest = hot_strings.groupBy("d1", "d2").agg(F.min(F.struct("id", "hash", "start")).alias("least"), F.count("*").alias("n")).where("n > 1")
    later = hot_strings.join(earliest, ["d1", "d2"]).where(F.struct("id", "hash", "start") > F.col("least"))
    removed = spans.where("d1 IS NULL").select(SPANS[:4]).union(later.select(SPANS[:4]))
    removed = removed.groupBy("id", "hash").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            edges, (starts, stops) = listed(batch.column("spans"))
            ends, starts, stops = merged_spans(edges, starts, stops)
            kept, sizes = [], []
            for i, packed in enumerate(batch.column("packed").to_pylist()):
                data, own = unpack.decompress(packed), slice(ends[i], ends[i + 1])
                kept.append(b"".join(data[a:b] for a, b in zip([0, *stops[own].tolist()], [*starts[own].tolist(), len(data)])))
                sizes.append(len(data))
            pairs = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], ["start", "end"])
            spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([batch.column("given"), pa.array(kept, pa.binary()), spans, pa.array(sizes, pa.int64())], [id_col, "kept", "spans", "n_bytes"])

    whole = small.join(removed, ["id", "hash"], "left").select("given", "packed", "spans")
    kind = df.schema[id_col].dataType.simpleString()
    return whole.mapInArrow(cut, f"`{id_col}` {kind}, kept binary, spans array<struct<start:long,end:long>>, n_bytes long")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
