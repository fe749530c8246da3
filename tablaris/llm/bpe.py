"""Byte-level BPE in padded numpy matrices.

Distinct pre-tokens are bucketed by length and put into matrices of token ids,
one row each. In every round each row merges its leftmost pair of least rank;
the pair's rank comes from a hash table of (left id, right id), the row is
compacted, and rows without a pair left leave the matrix. Texts are put together
from the merged pre-tokens. Spark deals the rows to tasks; nothing is shuffled,
and the tables broadcast are bounded by the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablaris.llm.common import once, table
from tablaris.llm.lookup import HashIndex

NONE = np.iinfo(np.int32).max
WIDEST = 256  # bytes; longer pre-tokens are merged one by one, by the same rule
FINE, STEP = 32, 6  # up to so many bytes the lengths of a matrix's words differ by less than STEP
CELLS = 1 << 20  # of a matrix
KNOWN = 150_000  # pieces of text, and pre-tokens, whose ids a worker remembers, and as many before them
TOKENS = 1 << 17  # decoded at a time
BLOCK = 1 << 20  # characters of text in work at a time
GATHERED = 1 << 22  # and where texts stay columns
STOPS = frozenset(".,;:!?")  # each a pre-token of its own behind letters
UNSURE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])  # first bytes of characters that may be white space


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Remembered:
    """Values by key, made once; of more than ``size`` keys those asked for last are kept.

    There are two generations: what the older one has moves to the younger when it
    is asked for, and the older one goes when the younger is full.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, keys: list, make: Callable[[list], list]) -> list:
        """Values of distinct ``keys``; ``make`` gives those of the ones not known."""
        out = list(map(self.young.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        asked = [keys[i] for i in missing]
        values = list(map(self.old.get, asked))
        fresh = [i for i, v in enumerate(values) if v is None]
        if fresh:
            for i, value in zip(fresh, make([asked[i] for i in fresh])):
                values[i] = value
        for i, value in zip(missing, values):
            out[i] = value
        self.young.update(zip(asked, values))
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def without(matrix: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The matrix less one cell of each row."""
    keep = np.ones(matrix.shape, dtype=bool)
    keep[np.arange(len(matrix)), column] = False
    return matrix[keep].reshape(len(matrix), -1)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last ends; null is empty."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[places[0] : places[-1]], places - places[0]


def cut(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where pieces of the texts begin that can be encoded one by one.

    A single space between two characters that are not white space always begins a
    pre-token, and a single line feed there is one. Next to a character that might
    be white space by its first byte there is no cut; that only makes pieces longer.
    """
    begins = np.zeros(len(data) + 1, dtype=bool)
    edge = np.zeros(len(data), dtype=bool)
    some = np.flatnonzero(np.diff(places))
    begins[places[some]] = True
    edge[places[some]] = edge[places[some + 1] - 1] = True
    at = np.flatnonzero((data == 0x20) | (data == 0x0A))
    at = at[~edge[at]]
    one, two, three = data[at - 1], data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    lead = np.where(one < 0x80, one, np.where(two >= 0xC0, two, np.where(three >= 0xC0, three, 0xF0)))
    after = data[at + 1]
    at = at[(lead > 0x20) & ~UNSURE[lead] & (after > 0x20) & ~UNSURE[after]]
    begins[at] = True
    begins[at[data[at] == 0x0A] + 1] = True
    return np.flatnonzero(begins[:-1])


class TextIds:
    """Ids of texts from ids of pre-tokens, both as little-endian 32-bit numbers.

    Texts are cut into pieces, distinct pieces of a block are looked up or encoded,
    and their ids gathered in the order of the text.
    """

    def __init__(self, pattern: str, known: int = KNOWN):
        self.pattern = regex.compile(pattern)
        self.pieces = Remembered(known)
        self.words = Remembered(known)

    def word_ids(self, words: list[str]) -> list[bytes]:
        raise NotImplementedError

    def gather(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin and the last one's end; null is empty."""
        data, places = utf8(texts)
        if not len(data):
            return np.zeros(0, dtype="<i4"), np.zeros(len(places), dtype=np.int64)
        begins = cut(data, places)
        offsets = np.append(begins, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        known = self.pieces.get(pieces.dictionary.to_pylist(), self._match)
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = pieces.indices.to_numpy()
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(known), dtype="<i4")[ragged(starts[which], lengths[which])]
        ends = np.concatenate([[0], np.cumsum(lengths[which])])
        return ids, ends[np.searchsorted(begins, places)]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.gather(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _match(self, pieces: list[str]) -> list[bytes]:
        whole = [p[p[0] == " " :].isalpha() for p in pieces]  # letters, and a space at most, are one pre-token
        alone = iter(self.word_ids([p for p, one in zip(pieces, whole) if one]))
        found = [
            [p[:-1], p[-1]] if p[-1] in STOPS and p[p[0] == " " : -1].isalpha() else self.pattern.findall(p) for p, one in zip(pieces, whole) if not one
        ]
        distinct = list(dict.fromkeys(w for words in found for w in words))
        known = dict(zip(distinct, self.words.get(distinct, self.word_ids)))
        split = (b"".join(map(known.__getitem__, words)) for words in found)
        return [next(alone) if one else next(split) for one in whole]


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Bytes that print in Latin-1 stand for themselves; the others follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Bpe(TextIds):
    """Ids under merges given as rank -> id of (left id, right id)."""

    def __init__(self, pattern: str, of_byte: list[int], pairs: dict[int, int], id_of_rank: np.ndarray | None, whole: dict[bytes, int], known: int = KNOWN):
        super().__init__(pattern, known)
        self.pairs = pairs
        self.bytes = np.array(of_byte, dtype=np.int32)
        self.index = HashIndex(np.fromiter(pairs.keys(), np.uint64, len(pairs)))
        self.rank = np.append(np.fromiter(pairs.values(), np.int32, len(pairs)), NONE).astype(np.int32)
        self.id_of_rank = id_of_rank  # None: a rank is an id
        self.ranks = whole  # pre-tokens that are tokens, without merging
        self.added: dict[str, bytes] = {}  # strings that are cut out of a text first, and their ids

    @classmethod
    def of_ranks(cls, ranks: dict[bytes, int], pattern: str, known: int = KNOWN) -> Bpe:
        """Any two neighbours whose bytes are a token merge at that token's rank."""
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        return cls(pattern, [ranks[bytes([b])] for b in range(256)], pairs, None, ranks, known)

    @classmethod
    def of_tokenizer(cls, text: str, pattern: str, encode_special_tokens: bool = True) -> Bpe:
        """From a tokenizer's JSON: byte-level BPE, merges in their listed order.

        Added tokens in a text get their listed id; with ``encode_special_tokens``,
        as in the library (where it is off by default), special ones are text.
        """
        spec = json.loads(text)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        vocab, pairs, ids = model["vocab"], {}, []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault(vocab[left] << 32 | vocab[right], rank)
            ids.append(vocab[left + right])
        own = cls(pattern, [vocab[c] for c in byte_letters()], pairs, np.array(ids), {})
        for token in spec["added_tokens"]:
            if token["special"] and encode_special_tokens:
                continue
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"not a plain added token: {token['content']}")
            own.added[token["content"]] = np.uint32(token["id"]).tobytes()
        longest = sorted(own.added, key=len, reverse=True)
        own.splitter = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")")
        return own

    def gather(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not any(pa.compute.any(pa.compute.match_substring(texts, token)).as_py() for token in self.added):
            return super().gather(texts)
        split = [self.splitter.split(t or "") for t in texts.to_pylist()]  # every other part is an added token
        ids, ends = super().gather(pa.array([p for own in split for p in own[::2]], pa.large_string()))
        between = iter([ids[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
        whole = [b"".join(self.added[p] if i % 2 else next(between) for i, p in enumerate(own)) for own in split]
        return np.frombuffer(b"".join(whole), dtype="<i4"), np.concatenate([[0], np.cumsum([len(w) // 4 for w in whole])]).astype(np.int64)

    def word_ids(self, words: list[str]) -> list[bytes]:
        data, places = utf8(pa.array(words, pa.large_string()))
        return self.merge(data, places)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; padding (-1) has none."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint32).astype(np.uint64)
        found = self.rank[self.index.find(keys.ravel())].reshape(keys.shape)
        return np.where((left < 0) | (right < 0), NONE, found)

    def merge(self, data: np.ndarray, places: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of each word of ``data``."""
        lengths = np.diff(places)
        out: list[bytes] = [b""] * len(lengths)
        if self.ranks:
            flat = data.tobytes()
            whole = [self.ranks.get(flat[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
            out = [b"" if r is None else np.uint32(r).tobytes() for r in whole]
            lengths = np.where([r is None for r in whole], lengths, 0)
        for i in np.flatnonzero(lengths > WIDEST).tolist():
            out[i] = self.merge_long(data[places[i] : places[i + 1]].tobytes())
        short = np.flatnonzero((lengths > 0) & (lengths <= WIDEST))
        short = short[np.argsort(lengths[short], kind="stable")]
        size = lengths[short]
        width = np.where(size <= FINE, -(-size // STEP) * STEP, 1 << np.ceil(np.log2(size)).astype(np.int64))
        for rows in np.split(short, np.flatnonzero(np.diff(width)) + 1):
            wide = max(2, int(lengths[rows].max(initial=0)))
            step = max(1, CELLS // wide)
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                ids, counts = self.merge_matrix(data[ragged(places[own], lengths[own])], lengths[own], wide)
                flat, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                for i, a, b in zip(own.tolist(), [0, *ends], ends):
                    out[i] = flat[a:b]
        return out

    def merge_matrix(self, data: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has; a word is a row of ``width``."""
        ids = np.full((len(lengths), width), -1, dtype=np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.bytes[data]
        done = np.full((len(lengths), width), -1, dtype=np.int32)
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(lengths))
        while True:
            col = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), dtype=np.int64)
            best = ranks[np.arange(len(row)), col] if ranks.shape[1] else np.full(len(row), NONE)
            over = best == NONE
            if over.any():
                done[row[over], : ids.shape[1]] = ids[over]
                on = ~over
                if not on.any():
                    return done[done >= 0], (done >= 0).sum(axis=1)
                ids, ranks, row, col, best = ids[on], ranks[on], row[on], col[on], best[on]
            all_rows = np.arange(len(row))
            ids[all_rows, col] = best if self.id_of_rank is None else self.id_of_rank[best]
            # Every row loses the id after the merged pair, so the matrix narrows by one.
            ids, ranks = without(ids, col + 1), without(ranks, col)
            for shift in (-1, 0):  # the pairs on both sides of the merged id
                near = (col + shift >= 0) & (col + shift < ranks.shape[1])
                r, c = all_rows[near], (col + shift)[near]
                if len(r):
                    ranks[r, c] = self.pair_ranks(ids[r, c], ids[r, c + 1])

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word: its leftmost pair of least rank merges, until there is none.

        Candidates wait in a heap by rank and place; one whose ids have changed since
        is passed over.
        """
        ids = self.bytes[np.frombuffer(word, dtype=np.uint8)].tolist()
        size = len(ids)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        ranks = self.pair_ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue
            ids[i] = rank if self.id_of_rank is None else int(self.id_of_rank[rank])
            ids[j] = -1  # gone
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size and (rank := self.pairs.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()


def slices(texts: pa.Array, characters: int = GATHERED) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows with about so many characters."""
    lengths = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(float))
    cut = (np.cumsum(lengths) // characters).astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(cut)) + 1), len(texts)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)


def blocks(texts: pa.Array, characters: int = BLOCK) -> Iterator[tuple[int, list[str]]]:
    """The same as lists; null is empty."""
    for at, own in slices(texts, characters):
        yield at, [t or "" for t in own.to_pylist()]


def encode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", out: str = "ids", keep_text: bool = True, known: int = KNOWN // 3
) -> DataFrame:
    """``df`` with the token ids of each text as array<int> in ``out``.

    Null and empty texts have no ids. A column named ``out`` is replaced; all
    others pass through, but for ``text_col`` where ``keep_text`` is false. Workers
    remember the ids of ``known`` pieces, and as many before them; that is only a
    matter of time. Row
    order within a partition, repeated rows and empty tables are kept as they are.
    """
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    kept = [f for f in df.schema if f.name != out and (keep_text or f.name != text_col)]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once(shared, lambda v: Bpe.of_ranks(*v, known))
        for batch in batches:
            for at, texts in slices(batch.column(text_col), BLOCK):
                rows = batch.slice(at, len(texts))
                columns = [rows.column(f.name) for f in kept]
                ids, ends = bpe.gather(texts)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*columns, lists], [f.name for f in schema])

    return df.mapInArrow(work, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each id list in ``out``; a null list gives null.

    An id outside the vocabulary fails the job. Other columns pass through.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    kept = [f for f in df.schema if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def table_of(tokens: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes, and by id where they begin and how many there are (-1: no such id)."""
        starts, lengths = np.zeros(max(tokens.values()) + 1, np.int64), np.full(max(tokens.values()) + 1, -1)
        at = np.fromiter(tokens.values(), np.int64, len(tokens))
        lengths[at] = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts[at] = np.cumsum(lengths[at]) - lengths[at]
        return np.frombuffer(b"".join(tokens), np.uint8), starts, lengths

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, lengths = once(shared, table_of)
        for batch in batches:
            own = batch.column(ids_col)
            counts = np.nan_to_num(pa.compute.list_value_length(own).to_numpy(zero_copy_only=False).astype(float))
            part = (np.cumsum(counts) // TOKENS).astype(np.int64)
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(batch)]
            for a, b in zip(edges, edges[1:]):
                rows = batch.slice(a, b - a)
                ids = own.slice(a, b - a).flatten().to_numpy().astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(lengths) or lengths[ids].min() < 0):
                    raise ValueError("an id is not in the vocabulary")
                flat = data[ragged(starts[ids], lengths[ids])]
                ends = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[0], np.cumsum(counts[a:b])]).astype(np.int64)]
                missing = own.slice(a, b - a).is_null()
                decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
                decoded = pa.compute.if_else(missing, pa.scalar(None, pa.binary()), decoded)
                yield pa.RecordBatch.from_arrays([*[rows.column(f.name) for f in kept], decoded], [f.name for f in schema])

    return df.mapInArrow(work, schema)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, ranks, public_tokenizers.PATTERN, keep_text=False)
    return decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
