import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablaris.llm import bpe, packing
from tests.llm.tools import awkward, documents, sha, table_folder

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def by_tiktoken():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def by_tokenizers():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe.of_ranks(RANKS, public_tokenizers.PATTERN), bpe.Bpe.of_tokenizer(open(JSON).read(), public_tokenizers.PATTERN)


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def check(texts, own, by_tiktoken, by_tokenizers):
    ranked, merged = own
    assert [ids(x) for x in ranked.encode(texts)] == [by_tiktoken.encode_ordinary(t) for t in texts]
    assert [ids(x) for x in merged.encode(texts)] == [by_tokenizers.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_texts(own, by_tiktoken, by_tokenizers):
    pick = random.Random(3)
    odd = ["", " ", "\n", "a\n", "\na", "a\n\nb", " a", "a  b", "a \n b", "it's we'll 's", "a\x1cb \x1c c", "a\u0085b \u0085 c d", "é 😀 <|endoftext|> </s>"]
    odd += ["x" * 3000, "ab" * 700 + "aaa" * 500, "".join(pick.choice("abcdefgh") for _ in range(3000)), "".join(chr(pick.randrange(0x20, 0x3000)) for _ in range(3000))]
    check(odd, own, by_tiktoken, by_tokenizers)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from("abe thin'\n\t.,0 "), st.characters(codec="utf-8")), max_size=60), max_size=6))
def test_any_text(own, by_tiktoken, by_tokenizers, texts):
    check(texts, own, by_tiktoken, by_tokenizers)


def merged(bpe_, words):
    flat = np.frombuffer(b"".join(words), np.uint8)
    return [ids(x) for x in bpe_.merge(flat, np.cumsum([0, *map(len, words)]))]


def plain_merge(bpe_, word):
    """The leftmost pair of least rank merges, one after the other."""
    out = bpe_.bytes[list(word)].tolist()
    while True:
        pairs = [(bpe_.pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(out, out[1:])) if a << 32 | b in bpe_.pairs]
        if not pairs:
            return out
        rank, i = min(pairs)
        out[i : i + 2] = [rank if bpe_.id_of_rank is None else int(bpe_.id_of_rank[rank])]


def test_long_words_in_single_and_batched_merges_agree(own, monkeypatch):
    pick = random.Random(5)
    words = [bytes(pick.choice(b"aabbtheing") for _ in range(pick.randrange(0, 200))) for _ in range(60)]
    for ranked in own:
        want = merged(ranked, words)
        monkeypatch.setattr(bpe, "WIDEST", 4)  # then most are merged in a heap
        assert merged(ranked, words) == want
        monkeypatch.undo()
        assert [ids(ranked.merge_long(w)) for w in words[1:] if len(w) > 1] == [plain_merge(ranked, w) for w in words[1:] if len(w) > 1]


@pytest.mark.parametrize("widest", [256, 2])
def test_random_rank_tables(monkeypatch, widest):
    """Merges that make pairs of lower rank than their own, which a trained vocabulary hardly has."""
    monkeypatch.setattr(bpe, "WIDEST", widest)
    for seed in range(40):
        pick = random.Random(seed)
        tokens = {bytes(pick.choice(b"abc") for _ in range(pick.randrange(2, 7))) for _ in range(60)}
        tokens = [bytes([b]) for b in range(256)] + pick.sample(sorted(tokens), len(tokens))
        order = pick.sample(range(len(tokens)), len(tokens))
        table = bpe.Bpe.of_ranks(dict(zip(tokens, order)), public_tokenizers.PATTERN)
        table.ranks = {}  # words are merged even where they are tokens
        words = [bytes(pick.choice(b"abc") for _ in range(pick.randrange(1, 60))) for _ in range(60)]
        assert merged(table, words) == [plain_merge(table, w) for w in words]


def test_memory_has_two_generations():
    made = []
    memory = bpe.Remembered(3)

    def make(keys):
        made.extend(keys)
        return [k.upper() for k in keys]

    assert memory.get(["a", "b"], make) == ["A", "B"] and memory.get(["c", "a", "d"], make) == ["C", "A", "D"]
    assert memory.get(["a"], make) == ["A"] and memory.get(["x", "y", "z"], make) == ["X", "Y", "Z"]  # a moved on, b to d go
    assert memory.get(["a", "b"], make) == ["A", "B"] and made == ["a", "b", "c", "d", "x", "y", "z", "b"]


def test_encode_and_decode_tables(spark, by_tiktoken):
    docs = documents(spark, awkward())
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
    rows = back.collect()
    assert back.columns == [*[c for c in docs.columns if c != "ids"], "ids", "decoded"]
    assert [(r.doc_id, r.text) for r in rows] == awkward()
    for r in rows:
        assert r.ids == by_tiktoken.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() and r.norm == 7
    none = bpe.decode(bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN), RANKS)
    assert none.collect() == [] and none.columns == back.columns


def test_op1(spark, tmp_path, by_tiktoken):
    rows = bpe.op1_byte_bpe(spark, table_folder(spark, tmp_path, documents=documents(spark, awkward()))).collect()
    want = [(i, len(x), sha(" ".join(map(str, x))), sha(t or "")) for i, t in awkward() for x in [by_tiktoken.encode_ordinary(t or "")]]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_first_fit_decreasing_is_what_it_says():
    sizes = np.random.default_rng(1).integers(1, 101, 500)
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room, want = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        b = next((b for b, left in enumerate(room) if left >= sizes[i]), len(room))
        room += [100] * (b == len(room))
        want[i] = (b, 100 - room[b])
        room[b] -= sizes[i]
    assert [want[i] for i in range(500)] == list(zip(bins.tolist(), offsets.tolist()))


def test_op8(spark, tmp_path, by_tokenizers):
    given = awkward()
    folder = table_folder(spark, tmp_path, documents=documents(spark, given))
    rows = packing.op8_packing(spark, folder).collect()
    pieces = []
    for i, t in given:
        x = by_tokenizers.encode(t or "", add_special_tokens=False).ids + [0]
        pieces += [(i, a, len(c), zlib.crc32(np.array(c, "<u4").tobytes()), len(x)) for a in range(0, len(x), 1024) for c in [x[a : a + 1024]]]
    assert sorted(map(str, [tuple(r)[:5] for r in rows])) == sorted(map(str, pieces))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024


def test_pack_passes_columns_and_refuses_wrong_sizes(spark):
    df = documents(spark, awkward()).selectExpr("*", "1 + length(coalesce(text, '')) % 50 AS length")
    packed = packing.pack(df, 3, key=["doc_id", "text"], capacity=64)
    assert packed.count() == len(awkward()) and "score" in packed.columns and packed.columns.count("offset") == 1
    assert packing.pack(df.limit(0), 3).collect() == []
    with pytest.raises(Exception, match="sizes must lie"):
        packing.pack(df.selectExpr("doc_id", "0L AS length"), 1).collect()


def test_little_padding(spark):
    sizes = spark.range(4000).selectExpr("id", "1 + pmod(xxhash64(id), 1024) AS length")
    packed = packing.pack(sizes, 2)
    total, used = packed.selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert total / (1024 * used) > 0.97
    assert packed.selectExpr("min(sequence_id) >= 0").first()[0]


def test_added_tokens_as_the_library_does_by_default(spark):
    library = Tokenizer.from_file(JSON)
    own = bpe.Bpe.of_tokenizer(open(JSON).read(), public_tokenizers.PATTERN, encode_special_tokens=False)
    end = "<|endoftext|>"
    texts = ["", "plain", end, f"a {end} b", f"{end}{end}x{end}", f"a{end}\n\n b  {end}  c", f"<|endoftext {end[:-1]} <{end}>", f" {end} \n"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids(x) for x in own.encode(texts)] == want
    rows = packing.pieces(documents(spark, list(enumerate(texts))), JSON).collect()
    assert {r.id: ids(bytes(r.ids)) for r in rows} == {i: x + [0] for i, x in enumerate(want)}


@settings(max_examples=100, deadline=None)
@given(parts=st.lists(st.one_of(st.just("<|endoftext|>"), st.text(alphabet=st.sampled_from("ab <|>endoftext\n'é"), max_size=12)), max_size=8))
def test_any_text_with_added_tokens(parts):
    text = "".join(parts)
    assert [ids(x) for x in BY_DEFAULT[1].encode([text])] == [BY_DEFAULT[0].encode(text, add_special_tokens=False).ids]


BY_DEFAULT = Tokenizer.from_file(JSON), bpe.Bpe.of_tokenizer(open(JSON).read(), public_tokenizers.PATTERN, encode_special_tokens=False)
