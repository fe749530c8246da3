import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablaris.llm import lce, periodic_runs, quality, spelling
from tests.llm.tools import awkward, documents, sentence, sha, table_folder
from tests.oracle import difference

# ---------------------------------------------------------------- periodic runs


def plain_extension(x, i, j):
    n = 0
    while max(i, j) + n < len(x) and x[i + n] == x[j + n]:
        n += 1
    return n


def plain_runs(words):
    """By the definition: every period, every stretch of equal words at that distance."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
            i = max(i, start + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(60))
def test_extensions(seed):
    pick = np.random.default_rng(seed)
    x = pick.integers(0, pick.integers(1, 4), pick.integers(1, 300))
    if seed % 3 == 0:
        x = np.tile(x[: max(1, len(x) // 7)], 20)
    i, j = pick.integers(0, len(x) + 1, (2, 200))
    i, j = i[i != j], j[i != j]
    assert lce.Extensions(x).query(i, j).tolist() == [plain_extension(x, a, b) for a, b in zip(i, j)]


@pytest.mark.parametrize("early", [0, 1 << 12])
def test_runs_of_blocks(monkeypatch, early):
    monkeypatch.setattr(periodic_runs, "EARLY", early)
    for seed in range(400):
        pick, texts = random.Random(seed), []
        for _ in range(pick.randrange(1, 6)):
            words = [str(pick.randrange(pick.randrange(1, 4))) for _ in range(pick.randrange(120))]
            texts.append(words[: pick.randrange(1, 12)] * pick.randrange(8) + words)
        got = periodic_runs.in_block(texts)
        assert [[tuple(r) for r in g.tolist()] for g in got] == [plain_runs(t) for t in texts]


def test_periodic_runs_rows(spark):
    rows = [*awkward(), (20, "a b c " * 4), (21, "go " * 5 + "go"), (22, "x " * 5), (23, "hm hm " * 6), (24, "a b " * 30000)]
    docs = documents(spark, rows, "runs", "collapsed", "n_words", "seed", "c0")
    out = periodic_runs.periodic_runs(docs)
    assert set(out.columns) == set(docs.columns)
    got = out.collect()
    assert len(got) == len(rows) and all(r.seed == 7 and r.c0 == 7 for r in got)
    by_text = {r.doc_id: r for r in got}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = plain_runs(words) if len(words) < 10000 else [(0, 60000, 2)]
        assert [tuple(r) for r in by_text[i].runs] == want or i == 7
        drop = {k for s, n, q in want for k in range(s + q, s + n)}
        assert by_text[i].collapsed == " ".join(w for k, w in enumerate(words) if k not in drop) and by_text[i].n_words == len(words)
    assert [tuple(r) for r in by_text[20].runs] == [(0, 12, 3)] and by_text[20].collapsed == "a b c"
    assert [tuple(r) for r in by_text[21].runs] == [(0, 6, 1)] and not by_text[22].runs
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []


def test_texts_may_be_read_in_another_order(spark):
    docs = spark.createDataFrame([(1, "a b c", 5), (2, "a b c", None), (3, None, 5)], "doc_id long, text string, h long")
    out = periodic_runs.periodic_runs(docs, rewrite=lambda n, h: np.arange(h + n) % n if n else None, seed=F.col("h"))
    assert {r.doc_id: (r.n_words, len(r.runs)) for r in out.collect()} == {1: (8, 0), 2: (3, 0), 3: (0, 0)}
    places = periodic_runs.echo(10, 30)
    assert periodic_runs.echo(10, 31) is None and periodic_runs.echo(0, 30) is None
    assert places.tolist() == [0, 1, 2, 3, 3, 3, 3, 3, 3, 3][:3] + [3 + i % (1 + 7 // 6) for i in range(7)]


# ------------------------------------------------------------ spelling variants


def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def plain_variants(counts):
    forms = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = (best if best is not None and counts[best] >= 5 * n else None, len(near))
    out = set()
    for w, (form, near) in forms.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        out.add((w, form, root, counts[w], near, counts.get(form)))
    return out


def alike(seed, size):
    pick = random.Random(seed)
    words = {"".join(pick.choice("abß") for _ in range(pick.randrange(0, 7))) for _ in range(size)}
    words |= {"prefixed" + w for w in list(words)[::2]} | {w + "ending" for w in list(words)[::2]}
    return {w: pick.choice([5, 6, 30, 31, 200, 1100]) for w in words}


def test_composition():
    for seed in range(80):
        pick = random.Random(seed)
        m = pick.randrange(1, 7)
        words = sorted({"".join(pick.choice("abc") for _ in range(pick.choice((m, m + 1)))) for _ in range(pick.randrange(1, 60))})
        machine = spelling.Acceptor()
        start = machine.add(words)
        assert machine.add(words) == start  # minimised: the same set is the same state
        got = [tuple(sorted(p)) for p in machine.near(start, m, True)]
        want = {(u, v) for u in words for v in words if u < v and one_edit(u, v) and not len(u) == len(v) == m + 1}
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("part, stretch", [(spelling.PART, spelling.STRETCH), (4, 64), (1, 1), (10**6, 2)])
def test_near_words(spark, part, stretch, monkeypatch):
    monkeypatch.setattr(spelling, "BATCH", 7)
    counts = alike(part, 60)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in spelling.near_words(words, part, stretch).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(u, counts[u], v, counts[v]) for u in counts for v in counts if one_edit(u, v)}


def test_variants(spark):
    counts = alike(5, 50) | {"colour": 10, "color": 60, "colors": 400, "tiedab": 5, "tiedac": 50, "tiedaa": 50, "lonely": 9}
    counts |= {"y" * 3000: 5, "y" * 2999: 25, "y" * 1500 + "z" + "y" * 1499: 125}
    rows = [(w, n, 1) for w, n in counts.items()] + [(None, 7, 1), ("nullcount", None, 1)]
    words = spark.createDataFrame(rows, "word string, n long, form int")
    got = {tuple(r) for r in spelling.variants(words).collect()}
    assert got == plain_variants(counts)
    assert ("colour", "color", "colors", 10, 1, 60) in got and ("tiedab", "tiedaa", "tiedaa", 5, 2, 50) in got
    assert spelling.variants(words.limit(0)).collect() == []


def test_vocabulary(spark):
    rows = [(i, "Naïveté, PREFIX2prefix Ärger prefix" if i % 2 else None) for i in range(10)] + [(None, "prefix "), (3, ""), (4, "ÄRGERT " * 5), (4, "x" * 70000)]
    got = dict(spelling.vocabulary(documents(spark, rows, "word", "h", "id", "run")).collect())
    assert got == {"naïveté": 5, "prefix": 16, "Ärgert": 5}
    spoiled = Counter()
    for i, text in rows:
        for word in re.findall("[a-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 3 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            spoiled[word] += 1
    got = dict(spelling.vocabulary(documents(spark, rows), spoil=3, shortest=4, least=1).collect())
    assert got == {w: n for w, n in spoiled.items() if len(w) >= 4}
    assert spelling.vocabulary(documents(spark, rows).limit(0)).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = [t for _, t in awkward()] + [sentence(i, 400).replace("1", "abcdef").replace("2", "abcdeg") for i in range(30)]
    texts += ["tick tock " * i for i in range(10)]
    path = tmp_path_factory.mktemp("tables")
    own = table_folder(spark, path, documents=documents(spark, list(enumerate(texts))).repartition(3))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{own}/documents.parquet/*.parquet')")
    return own, con


@pytest.mark.parametrize(
    "query, sql", [(spelling.op12_spelling_variants, spelling.ORACLE_SQL), (periodic_runs.op13_periodic_runs, periodic_runs.ORACLE_SQL)]
)
def test_against_sql(spark, folder, query, sql):
    assert difference(query(spark, folder[0]), folder[1], sql) is None


# --------------------------------------------------------------------- quality


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = text.split("\n")

    def share(a, b):
        return a / b if b else 0.0

    n = len(text)
    return {
        "chars": np.log1p(n), "words": np.log1p(len(words)), "word_length": share(n, len(words)),
        "letters": share(sum(c.isalpha() for c in text), n), "capitals": share(sum(c.isupper() for c in text), n),
        "digits": share(sum(c in "0123456789" for c in text), n), "marks": share(sum(c in "!?" for c in text), n),
        "symbols": share(sum(c in quality.SYMBOLS for c in text), n),
        "ended": share(len(re.findall(r"[.,;:!?][\x20\x09-\x0D]", text)), len(words)),
        "echoed": share(sum(a == b for a, b in zip(words, words[1:])), len(words)), "distinct": share(len(set(words)), len(words)),
        "line_words": len(words) / len(lines), "lines_repeated": 1 - len(set(lines)) / len(lines) if n else 0.0,
    }


def test_statistics(spark):
    rows = [*awkward(), (30, "No! No! No!\nNo! No! No!\n#a_b [x] 12"), (31, "ab " * 20000)]
    docs = documents(spark, rows, "statistics", "words", "_words", "chars")
    out = quality.with_statistics(docs)
    assert set(out.columns) == set(docs.columns)
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == sorted(str(i) for i, _ in rows)
    for r in out.collect():
        assert r.statistics.asDict() == pytest.approx(plain_statistics(r.text)), r.text
        assert list(r.statistics.asDict()) == quality.STATISTICS
    assert quality.with_statistics(docs.limit(0)).collect() == []


def labelled(spark, count):
    rows = []
    for i in range(count):
        junk = i % 4 == 0
        text = " ".join(w + random.Random(i).choice(["!!", "##", " "]) for w in sentence(i, 30).split()) if junk else sentence(i, 30) + "."
        rows.append((i, text, 0 if junk else 1))
    return quality.with_statistics(spark.createDataFrame(rows, "doc_id long, text string, label int"))


def test_rules(spark):
    rows = labelled(spark, 300)
    model = quality.fit(rows, trees=6)
    assert 0 < len(model.rules) < 6 * 14  # the penalty leaves rules out
    for r in quality.score(rows.drop("text"), model).collect():
        values = r.statistics.asDict()
        total = model.intercept + sum(w for rule, w in model.rules if all(low < values[name] <= high for name, low, high in rule.limits))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total))) and r.predicted == int(r.score >= 0.7)
        assert r.predicted == r.label
    assert all(low < high for rule, _ in model.rules for _, low, high in rule.limits)


def test_labels_that_say_nothing(spark):
    rows = labelled(spark, 20)
    assert quality.fit(rows.limit(0)) == quality.RuleEnsemble(0.0, ())
    assert quality.fit(rows.where("label = 1")) == quality.RuleEnsemble(pytest.approx(np.log(16)), ())
    odd = rows.withColumn("label", F.expr("if(doc_id % 2 = 0, null, 3)"))
    assert quality.fit(odd) == quality.RuleEnsemble(0.0, ())
    same = rows.withColumn("statistics", F.struct(*[F.lit(0.0).alias(n) for n in quality.STATISTICS])).withColumn("label", F.expr("doc_id % 2"))
    assert quality.fit(same).rules == ()
    out = quality.score(rows, quality.RuleEnsemble(0.0, ())).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in out] == [(0.5, 0)]


def test_quality_query(spark, tmp_path):
    data = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    more = spark.createDataFrame([(None, "no id", None, None, None), (10**9, None, None, None, None)], docs.schema)
    # What is not to be learned from changes no score: labels of rows held out, and other columns.
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.lit(0))
    plain = table_folder(spark, tmp_path / "a", documents=docs.union(more).coalesce(1), labels=labels.coalesce(1))
    other = table_folder(
        spark, tmp_path / "b", documents=docs.union(more).withColumns({"lang": F.lit("x"), "source": F.lit("y")}).coalesce(1), labels=spoiled.coalesce(1)
    )
    scores = [{r.doc_id: (r.held_out, round(r.score, 9), r.predicted) for r in quality.op11_quality_classifier(spark, d).collect()} for d in (plain, other)]
    assert scores[0] == scores[1] and len(scores[0]) == docs.count() + 2
    assert scores[0][None][0] is True and 0 <= scores[0][10**9][1] <= 1
    told = [(scores[0][r.doc_id][2], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(told) > 50 and sum(a == b for a, b in told) / len(told) >= 0.97


def test_digest_columns(spark, folder):
    rows = {r.doc_id: r for r in periodic_runs.op13_periodic_runs(spark, folder[0]).collect()}
    empty = next(i for i, (_, t) in enumerate(awkward()) if t is None)
    assert (rows[empty].n_runs, rows[empty].start, rows[empty].exponent_milli) == (0, None, None)
    assert rows[empty].runs_sha256 == rows[empty].collapsed_sha256 == sha("")
