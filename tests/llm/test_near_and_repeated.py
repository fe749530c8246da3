import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablaris.llm import embedding_dedup, hnsw, ngram_join, suffix_dedup
from tablaris.llm.common import components as spark_components
from tablaris.llm.shingles import shingle_sets
from tests.llm.tools import WORDS, awkward, components, documents, sentence, sha, table_folder


def repeated_bytes(rows, length):
    """id -> (bytes, removed, spans, kept digest), string by string."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data, gone = (t or "").encode(), set()
        for p in range(len(data) - length + 1):
            if data[p : p + length] in seen:
                gone.update(range(p, p + length))
            seen.add(data[p : p + length])
        kept = bytes(b for p, b in enumerate(data) if p not in gone)
        out[i] = (len(data), len(gone), sum(p - 1 not in gone for p in gone), sha(kept))
    return out


def repeating_texts():
    passage, pick = sentence(50, 40), random.Random(4)
    rows = [t for _, t in awkward()[:-1]]
    rows += [sentence(i, 15) + passage + sentence(i + 500, 15) for i in range(12)]
    rows += [sentence(i, 5) + passage[i * 3 : i * 3 + 90 + 2 * i] for i in range(20)]
    rows += ["a" * 400, "ab" * 200, passage * 4, "é" * 120, "\x00" * 150 + "end", "\x00" * 130]
    rows += ["".join(pick.choice("ab") for _ in range(700)) for _ in range(3)]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_removed_bytes(spark, hot):
    rows = repeating_texts()
    out = suffix_dedup.suffix_dedup(documents(spark, rows, "kept", "spans"), hot=hot).collect()
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), sha(bytes(r.kept))) for r in out}
    assert len(out) == len(rows) and got == repeated_bytes(rows, 100)


def test_op2(spark, tmp_path):
    rows = repeating_texts()
    out = suffix_dedup.op2_suffix_dedup(spark, table_folder(spark, tmp_path, documents=documents(spark, rows).repartition(5))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == repeated_bytes(rows, 100)


def test_repeated_rows_and_ids(spark):
    text, other = sentence(1, 40), sentence(2, 40)
    rows = [(1, text), (1, text), (1, other + text), (None, text), (0, None)]
    out = suffix_dedup.suffix_dedup(documents(spark, rows)).collect()
    left = sorted((str(r.doc_id), len(r.kept)) for r in out)
    # The two equal rows are one document; one of id 1's two texts holds the first occurrence.
    assert left[0] == ("0", 0) and left[-1] == ("None", 0) and len(left) == 5
    assert sorted(n for i, n in left if i == "1") in ([len(text), len(text), len(other)], [0, 0, len(other + text)])
    assert suffix_dedup.suffix_dedup(documents(spark, rows).limit(0)).collect() == []


def test_merge_of_runs_carries_common_prefixes():
    pick = random.Random(1)
    for runs in (1, 2, 3, 7):
        lists = [sorted(bytes(pick.choice(b"ab\x00") for _ in range(12)) for _ in range(pick.randrange(0, 40))) for _ in range(runs)]
        matrices = [np.frombuffer(b"".join(x), np.uint8).reshape(-1, 12) for x in lists]
        order, lcps = suffix_dedup.merge_runs([(x, suffix_dedup.common_prefix(m).tolist()) for x, m in zip(lists, matrices)])
        flat = [s for x in lists for s in x]
        assert [flat[i] for i in order] == sorted(flat)
        assert lcps == suffix_dedup.common_prefix(np.frombuffer(b"".join(sorted(flat)), np.uint8).reshape(-1, 12)).tolist()


def test_front_coding_round_trip():
    rows = np.array(sorted(np.random.default_rng(1).integers(97, 99, (50, 20)).tolist()), np.uint8)
    left, spare, owner = rows[:, :5], np.zeros((50, 2), np.int16), np.arange(150).reshape(50, 3)
    back = suffix_dedup.decode_run(suffix_dedup.encode_run(rows, left, spare, owner), 20)
    assert back[0] == [r.tobytes() for r in rows] and (back[2] == left).all() and (back[4] == owner).all()


# Jaccard join


def words_of(text):
    return "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "").lower()).split()


def jaccard_groups(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold]
    count = [sum(i in pair for pair in links) for i in range(len(rows))]
    root = components(range(len(rows)), links)
    least = {}
    for i, r in root.items():
        least[r] = min((x for x in (least.get(r), rows[i][0]) if x is not None), default=None)
    return [(rows[i][0], least[root[i]], count[i]) for i in range(len(rows))]


def near_texts():
    pick, rows = random.Random(9), [t for _, t in awkward()]
    for group in range(4):
        base = sentence(900 + group, 120).split()
        for _ in range(15):
            own = list(base)
            for _ in range(pick.randrange(0, 5)):
                own[pick.randrange(len(own))] = pick.choice(WORDS)
            rows.append(" ".join(own))
    return [(awkward()[i][0] if i < 13 else 100 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("sizes", [{}, {"members": 3, "weight": 300}])
def test_join_against_all_pairs(spark, sizes):
    rows = near_texts()
    out = ngram_join.ngram_join(documents(spark, rows, "class_id", "kept"), **sizes).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links) for r in out) == sorted((str(i), c, n) for i, c, n in jaccard_groups(rows))
    assert all(r.kept == (r.doc_id == r.class_id) for r in out)


def test_op7(spark, tmp_path):
    rows = [(i, t) for i, (_, t) in enumerate(near_texts())]
    out = ngram_join.op7_ngram_jaccard_join(spark, table_folder(spark, tmp_path, documents=documents(spark, rows).repartition(4))).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in out) == jaccard_groups(rows)


def test_join_of_nothing(spark):
    docs = documents(spark, awkward())
    assert ngram_join.ngram_join(docs.limit(0)).collect() == []
    assert {tuple(r)[1:] for r in ngram_join.ngram_join(docs.where("doc_id in (2, 3, 4)")).collect()} == {(2, 0, True), (3, 0, True), (4, 0, True)}


def test_shortening_reaches_the_wanted_recall():
    depth = ngram_join.shortened(0.8, 20, 6, 0.9999)
    assert 1 - (1 - 0.8**depth) ** 20 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 20


def test_shingles_do_not_depend_on_company():
    texts = [t or "" for _, t in near_texts()]
    alone = [shingle_sets([t])[0] for t in texts]
    assert all((a == b).all() for a, b in zip(alone, shingle_sets(texts)))
    assert [len(s) for s in alone] == [len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0 for w in map(words_of, texts)]


def test_intersections_exact():
    pick = np.random.default_rng(2)
    sets = [np.unique(pick.integers(0, 90, pick.integers(1, 80))).astype(np.uint64) for _ in range(70)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert ngram_join.intersections(sets).tolist() == want


# Embeddings


def vectors(seed=1, groups=6, size=30, dim=16):
    pick = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = pick.normal(size=dim)
        rows += [base + pick.normal(size=dim) * 0.08 * pick.random() for _ in range(size)]
    rows += list(pick.normal(size=(400, dim)))
    return np.array(rows)


def cosine_rows(rows, threshold=0.95):
    usable = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for i in usable:
        for j in usable:
            if i != j and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links.append((i, j))
    root = components(range(len(rows)), links)
    least = {}
    for i, r in root.items():
        least[r] = min((x for x in (least.get(r), rows[i][0]) if x is not None), default=None)
    count = np.bincount([i for i, _ in links], minlength=len(rows)).tolist()
    return sorted((str(rows[i][0]), count[i], least[root[i]]) for i in range(len(rows)))


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("node", "v", "label", "n_links")})


def test_links_against_all_pairs(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors())]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, [0.0] * 16), (1003, None), (1004, []), (1005, [1.0, None]), (1006, [float("nan")] * 16), (1007, [float("inf")] + [1.0] * 15)]
    rows += [(1008, [1.0, 2.0]), (1009, [2.0, 4.0]), (None, rows[0][1]), (1010, [1e300] * 3), (1011, [1e-300] * 3), (1012, [-0.0, 1.0]), (1013, [0.0, 1.0])]
    out = embedding_dedup.near_embeddings(embeddings(spark, rows), least_shards=3, beam=8).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in out) == cosine_rows(rows)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)


def test_op9(spark, tmp_path):
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors(2))]
    out = embedding_dedup.op9_embedding_near_dup(spark, table_folder(spark, tmp_path, embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>"))).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id) for r in out) == cosine_rows(rows)


def test_no_vectors(spark):
    none = embeddings(spark, [(1, [1.0])]).limit(0)
    assert embedding_dedup.near_embeddings(none).collect() == []


def test_graph_recall():
    rows = embedding_dedup.unit_vectors(np.random.default_rng(3).normal(size=(3000, 32))).astype(np.float32)
    graph = hnsw.Hnsw.build(rows)
    found, _ = graph.search(rows[:300], 128)
    truth = np.argsort(-rows[:300] @ rows.T, axis=1)[:, :10]
    assert np.mean([len(set(f) & set(t)) for f, t in zip(found.tolist(), truth.tolist())]) >= 9


def test_components(spark):
    pick = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(pick.randrange(200, 260), pick.randrange(200, 260)) for _ in range(50)] + [(500, 500)]
    nodes = {x for e in edges for x in e}
    got = spark_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    want = components(nodes, edges)
    assert {r.node: r.root for r in got} == {n: want[n] for n in nodes}
    assert spark_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rare_pairs_are_audited(spark):
    pick = np.random.default_rng(11)
    rows = pick.normal(size=(6000, 24))
    rows[3000:4500] = rows[:1500] + pick.normal(size=(1500, 24)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    unit = embedding_dedup.unit_vectors(rows)
    true = (unit @ unit.T >= 0.95).sum() - len(rows)
    out = embedding_dedup.near_embeddings(df, shard_size=6000, least_shards=1, beam=4)
    found = out.selectExpr("sum(n_links)").first()[0]
    assert true >= 3000 and 0.98 * true <= found <= true


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"ab", k=rng.choice([0, 5, 99, 100, 101, 400, 2_000]))) for _ in range(60)]
    whole = suffix_dedup.anchors(texts, 100)
    for piece in (1, 300, 5_000, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        assert all((a == b).all() for a, b in zip(suffix_dedup.anchors_by_piece(texts, 100), whole))


@pytest.mark.parametrize("count", [3, 1 << 20])
def test_groups_are_sorted_stably(count):
    keys = np.array([5, 3, 5, 0, 3, 5, (count + 1) ** 2 - 1], np.int64)
    ordered, at = suffix_dedup.sorted_groups(keys, count)
    assert at.tolist() == [3, 1, 4, 0, 2, 5, 6] and (ordered == keys[at]).all()


def test_spans_are_merged_row_by_row():
    spans = [[(5, 9), (0, 2), (2, 4), (6, 7)], None, [(0, 3)], [], [(1, 2), (1, 5), (7, 8)]]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    lists = pa.array([None if r is None else [{"start": a, "end": b} for a, b in r] for r in spans], kind)
    ends, (starts, stops) = suffix_dedup.listed(lists)
    ends, starts, stops = suffix_dedup.merged_spans(ends, starts, stops)
    rows = [list(zip(starts[a:b].tolist(), stops[a:b].tolist())) for a, b in zip(ends, ends[1:])]
    assert rows == [[(0, 4), (5, 9)], [], [(0, 3)], [], [(1, 5), (7, 8)]]
    ends, starts, stops = suffix_dedup.merged_spans(*(lambda e, f: (e, *f))(*suffix_dedup.listed(pa.array([None], kind))))
    assert ends.tolist() == [0, 0] and not len(starts) and not len(stops)
