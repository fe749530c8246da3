import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablaris.llm import chat, language
from tests.llm.test_near_and_repeated import jaccard_groups
from tests.llm.tools import WORDS, awkward, documents, sentence, sha, table_folder

OTHER = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split()


def labelled(spark, count=240):
    rows = []
    for i in range(count):
        pick = random.Random(i)
        words = WORDS if i % 2 else OTHER
        rows.append((i, " ".join(pick.choice(words) for _ in range(pick.randrange(3, 60))), "en" if i % 2 else "de"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def plain_costs(train: dict[str, list[str]], text: str) -> dict[str, float]:
    """Code lengths by the definition, byte by byte, from dictionaries of counts."""
    out = {}
    for lang, texts in train.items():
        counts: dict[bytes, dict[int, int]] = {}
        for t in texts:
            data = b"\n" * 4 + t.encode()
            for i in range(4, len(data)):
                for order in range(5):
                    own = counts.setdefault(data[i - order : i], {})
                    own[data[i]] = own.get(data[i], 0) + 1
        cost, data = 0.0, b"\n" * 4 + text.encode()
        for i in range(4, len(data)):
            for order in range(4, -1, -1):
                own = counts.get(data[i - order : i])
                if own and data[i] in own:
                    cost -= np.log(own[data[i]] / (sum(own.values()) + len(own)))
                    break
                if own:
                    cost -= np.log(len(own) / (sum(own.values()) + len(own)))
            else:
                cost += np.log(256)
        out[lang] = cost
    return out


def test_code_lengths_by_definition(spark):
    docs = labelled(spark, 30)
    rows = docs.collect()
    trees = language.fit(docs)
    train = {lang: [r.text for r in rows if r.lang == lang] for lang in ("de", "en")}
    texts = [sentence(3, 20), "für die Katz", "x", "\n\n a", "日本語 😀", "the of and" * 50]
    got = trees.score([t.encode() for t in texts])
    for t, costs in zip(texts, got):
        want = plain_costs(train, t)
        assert costs == pytest.approx([want["de"], want["en"]], rel=1e-5)


def test_all_grams_of_the_sample_count(spark):
    """More than 60,000 distinct grams of a length, none of them left out."""
    pick = random.Random(8)
    texts = ["".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(2500)) for _ in range(24)]
    docs = spark.createDataFrame([(i, t, "zh" if i % 2 else "yi") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trees = language.fit(docs)
    for length in (4, 5):
        keys, counts = trees.counts[length]
        seen = {}
        for i, t in enumerate(texts):
            data = b"\n" * 4 + t.encode()
            for end in range(5, len(data) + 1):
                seen.setdefault(data[end - length : end], [0, 0])[i % 2] += 1
        assert len(seen) > 60_000 and {k.to_bytes(length, "big"): c for k, c in zip(keys.tolist(), counts.tolist())} == seen
    train = {lang: [t for i, t in enumerate(texts) if (i % 2 == 1) == (lang == "zh")] for lang in ("yi", "zh")}
    want = plain_costs(train, texts[0][:300])
    assert trees.score([texts[0][:300].encode()])[0] == pytest.approx([want["yi"], want["zh"]], rel=1e-5)


def test_the_sample_is_the_first_rows_of_each_language(spark, monkeypatch):
    rows = [(i, f"text{i % 70} " + "ab" * (i % 5), "en" if i % 9 else "de") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(9)
    total = {}
    for lang in ("de", "en"):
        first = sorted(i for i, _, own in rows if own == lang)[:40]
        total[lang] = sum(len(rows[i][1].encode()) for i in first)
    trees = language.fit(docs, order=F.col("doc_id"), docs=40)
    assert trees.counts[5][1].sum(axis=0).tolist() == [total["de"], total["en"]]


def test_a_row_without_an_id_is_held_out(spark, tmp_path):
    docs = labelled(spark, 40).union(spark.createDataFrame([(None, "the of and", "en")], "doc_id long, text string, lang string"))
    rows = language.op3_language_id(spark, table_folder(spark, tmp_path, documents=docs)).collect()
    assert [r.held_out for r in rows if r.doc_id is None] == [True]


def test_blocks_do_not_change_scores(spark, monkeypatch):
    trees = language.fit(labelled(spark, 30))
    texts = [sentence(i, 5 + i).encode() for i in range(20)]
    whole = trees.score(texts)
    monkeypatch.setattr(language, "STEP", 7)
    assert trees.score(texts) == pytest.approx(whole)


def test_op3(spark, tmp_path):
    more = spark.createDataFrame([(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !?", None), (1003, "the of and to", None), (1003, "the of and to", None), (None, "und in den von", "en")], "doc_id long, text string, lang string")
    docs = labelled(spark).union(more).withColumn("score", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    rows = language.op3_language_id(spark, table_folder(spark, tmp_path, documents=docs)).collect()
    assert len(rows) == 246 and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert [by_id[i][0].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"]
    held = [(r.lang_pred, "en" if r.doc_id % 2 else "de") for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) >= 0.95


def test_labels_of_held_out_documents_are_not_seen(spark):
    docs = labelled(spark)
    spoiled = docs.withColumn("lang", F.when(language.held_out(), "zz").otherwise(F.col("lang")))
    a, b = language.fit_documents(docs), language.fit_documents(spoiled)
    assert a.languages == b.languages == ["de", "en"]
    assert all((a.counts[m][0] == b.counts[m][0]).all() and (a.counts[m][1] == b.counts[m][1]).all() for m in a.counts)


def test_no_labels_and_no_rows(spark):
    docs = labelled(spark, 4).withColumn("lang", F.lit(None).cast("string"))
    said = language.identify(docs, language.fit_documents(docs))
    assert {(r.lang_pred, r.score, r.bits_per_byte) for r in said.collect()} == {("und", 0.0, None)}
    assert language.identify(docs.limit(0), language.fit(labelled(spark, 4))).collect() == []


# Chat


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("p", "depth", "tree", "offset")})


SHARED = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello"),
    (2, 0, "system", "Be kind."), (2, 1, "user", "Hi"), (2, 2, "assistant", "Good day"), (2, 3, "user", None),
    (3, 0, "system", "Be kind."), (3, 1, "user", "Bye"), (4, 0, "user", "<|turn|>x<|end|> \\ </s>[INST] a [/INST]<<SYS>>"), (4, 1, "assistant", "\\<|text|>\\\\<"),
    (5, 0, "system", "Be kind."), (5, 1, "user", "Hi"), (5, 2, "assistant", "Hello"), (6, 0, None, "x"), (7, 1, "assistant", ""), (7, 1, "assistant", ""),
    (None, 0, "user", "who"), (8, None, "user", "null turn first"), (8, 0, "assistant", "a\nb" * 4000),
]


def test_tree_shape(spark):
    forest = chat.format_chats(conversations(spark, SHARED))
    nodes = [r for r in forest.nodes.collect()]
    trees = {}
    for r in nodes:
        trees.setdefault(r.tree_id, []).append(r)
    shared = next(t for t in trees.values() if any("Be kind." in r.segment for r in t))
    assert sum("Be kind." in r.segment for r in nodes) == 1 and len(shared) == 6
    for tree in trees.values():
        tree.sort(key=lambda r: r.offset)
        at, path = 0, []
        for r in tree:
            assert r.offset == at  # gapless
            at += len(r.segment)
            path = path[: r.depth - 1]
            assert [(s.start, s.end) for s in r.ancestors] == path  # depth-first
            assert r.position == sum(b - a for a, b in path)
            path.append((r.offset, at))
    assert forest.conversations.where("conv_id IN (1, 5)").select("tree_id", "offset").distinct().count() == 1


def test_op6_rows(spark, tmp_path):
    folder = table_folder(spark, tmp_path, conversations=conversations(spark, SHARED).repartition(3))
    rows = {r.conv_id: r for r in chat.op6_chat_format(spark, folder).collect()}
    given = {}
    said = "</s>[INST] ok [/INST]"
    for c, t, r, x in [*SHARED, (-1, 0, "user", said), (-1, 1, "assistant", said)]:
        given.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert set(rows) == set(given)
    for c, turns in given.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        assert rows[c].n_turns == len(turns) and rows[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns))
        assert rows[c].loss_chars == len(loss) and rows[c].loss_sha256 == sha(loss)
        assert rows[c].formatted_chars >= sum(len(r) + len(x) for _, _, r, x in turns) + 23 * len(turns)


def test_escapes_hide_control_strings(spark):
    texts = ["<|turn|>", "</s>", "<s>", "<<s>", "<</SYS>>", "[/INST][INST]", "\\", "\\\\<|", "<\\|turn|>", "a\nb", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"))


def test_spans_grow_with_turns_not_their_square(spark):
    long = [(1, i, "user", f"t{i}") for i in range(3000)]
    other = [(2, i, "user", f"t{i}" if i < 2000 else f"u{i}") for i in range(2500)]
    more = [(3, i, "user", f"t{i}" if i < 1000 else f"v{i}") for i in range(1200)] + [(None, i, "user", f"t{i}") for i in range(10)]
    given = long + other + more
    forest = chat.format_chats(conversations(spark, given))
    assert forest.turns.count() == 3700
    assert forest.chains.selectExpr("sum(size(spans))").first()[0] <= 3
    back = {r.conv_id: r.formatted for r in chat.read_back(forest).collect()}
    for c in (1, 2, 3, None):
        assert back[c] == "".join(f"{chat.TURN}{r}{chat.BODY}{x}{chat.END}" for i, _, r, x in given if i == c)


def test_no_conversations(spark):
    none = chat.format_chats(conversations(spark, SHARED).limit(0))
    assert none.nodes.collect() == [] and chat.read_back(none).collect() == []


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    line = sentence(77, 12)
    rows = [(100 + i, f"{sentence(3000 + i, 30)}\n{line}") for i in range(6)]
    rows += [(200, sentence(5, 50)), (201, sentence(5, 50) + " more"), (202, "12 34"), (203, None), (204, "mine token=abcdefgh12 and more words")]
    docs = documents(spark, rows + awkward()[:1]).withColumn("n_chars", F.char_length("text").cast("long"))
    folder = table_folder(spark, tmp_path / "in", documents=docs)
    df, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, df, folder).write.parquet(f"{tmp_path}/{name}")
        df = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = df
        if name != "packing":
            assert df.columns == docs.columns
    ids = {name: sorted(r[0] for r in df.select("doc_id").distinct().collect()) for name, df in seen.items()}
    everyone = sorted({i for i, _ in rows + awkward()[:1]})
    assert ids["language_id"] == [i for i in everyone if i not in (202, 203)]
    assert ids["line_dedup"] == ids["language_id"]
    texts = {r.doc_id: r for r in seen["line_dedup"].collect()}
    assert [line in texts[100 + i].text for i in range(6)] == [False] * 5 + [True]
    assert all(r.n_chars == len(r.text) for r in texts.values())
    left = [(i, r.text) for i, r in sorted(texts.items())]
    assert ids["ngram_jaccard_join"] == sorted(i for i, c, _ in jaccard_groups(left) if i == c)
    assert 201 not in ids["ngram_jaccard_join"] and ids["secret_scan"] == ids["ngram_jaccard_join"]
    assert seen["secret_scan"].where("doc_id = 204").first().text == "mine [SECRET] and more words"
    run = corpus_pipeline.run(spark, folder)
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(run.select(keep).collect()) == sorted(seen["packing"].select(keep).collect())


def test_pipeline_of_nothing(spark, tmp_path):
    docs = documents(spark, awkward()).limit(0).withColumn("n_chars", F.lit(0).cast("long"))
    assert corpus_pipeline.run(spark, table_folder(spark, tmp_path, documents=docs)).collect() == []
