import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tablaris.llm import exact_dedup, line_dedup, secrets
from tests.llm.tools import awkward, documents, sentence, sha, table_folder
from tests.oracle import difference


def no_python(df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls and repeats, ids unique and not null as the SQL wants them."""
    lines = [sentence(100 + i, 9) for i in range(4)] + [sentence(9, 9) + " \t"]
    texts = [t for _, t in awkward()] + ["\n".join([lines[i % 5], sentence(i, 12), lines[4].upper() if i % 2 else lines[4], "short"]) for i in range(40)]
    docs = documents(spark, [(i, t) for i, t in enumerate(texts + ["a  b", "a b", "a\tb", "a b"])])
    path = tmp_path_factory.mktemp("tables")

    own = table_folder(spark, path, documents=docs.repartition(3))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{own}/documents.parquet/*.parquet')")
    return own, con


@pytest.mark.parametrize("query, sql", [(line_dedup.op4_line_dedup, line_dedup.ORACLE_SQL), (exact_dedup.op5_exact_dedup, exact_dedup.ORACLE_SQL)])
def test_against_sql(spark, folder, query, sql):
    df = query(spark, folder[0])
    no_python(df)
    assert difference(df, folder[1], sql) is None


def test_exact_dedup_rows(spark):
    rows = exact_dedup.exact_dedup(documents(spark, awkward(), "keep_id"), salts=2).collect()
    assert len(rows) == len(awkward())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert by_id[7] == [(1, 3, False)] * 2 and by_id[1] == [(1, 3, True)]  # a repeated row counts and goes
    assert by_id[2] == [(2, 2, True)] and by_id[3] == [(2, 2, False)]  # null and empty are equal
    assert by_id[None] == [(None, 1, True)]
    hot = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same  text', concat('t', id)) AS text")
    assert exact_dedup.exact_dedup(hot).where("group_size = 1000 AND keep_id = 0").count() == 1000
    assert exact_dedup.exact_dedup(hot.limit(0)).collect() == []


def test_equal_digests_of_different_texts_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    rows = exact_dedup.exact_dedup(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows} == {(1, 1, 2), (2, 2, 1), (3, 1, 2)}


def test_line_dedup_rows(spark):
    line = "x" * 39 + "Y"
    rows = [(i, f"{line}\nown {i}\n  {line.lower()}\t") for i in range(5)] + [(5, line[:-1]), (None, line), (3, line), (6, None)]
    docs = documents(spark, rows, "at", "mask", "id")
    out = line_dedup.line_dedup(docs, batches=3, fanout=2)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    got = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()}
    want = {(i, f"own {i}", 3, 2) for i in range(4)} | {(4, rows[4][1], 3, 0), (5, line[:-1], 1, 0), (None, "", 1, 1), (3, "", 1, 1), (6, "", 1, 0)}
    assert got == want
    assert line_dedup.line_dedup(docs.limit(0)).collect() == []
    four = line_dedup.line_dedup(documents(spark, rows[:4]))
    assert four.agg(F.sum("n_dropped")).first()[0] == 0


def test_levels_are_compacted(spark):
    runs = line_dedup.LineRuns(fanout=2)
    key = "id AS k1, id AS k2, 1L AS docs, id AS last"
    fresh = [runs.add(spark.range(a, a + 10).selectExpr(*key.split(", "))).count() for a in (0, 5, 0, 20, 21)]
    assert fresh == [10, 5, 0, 10, 1]
    assert all(len(level) < 2 for level in runs.levels)
    assert runs.merged().agg(F.sum("docs"), F.count("*")).first() == (50, 26)


def brute_spans(text):
    """Base spans as the contract words them, by Python's own engine."""
    assign = re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


SECRET_TEXTS = [
    None, "", "no secret here", "token=pass secret:abcdef password = 'hunter22'", "PassWord:é api_key=abc.def-ghi= apikey: \"zzzzzzz", "secret=token:abcdefg",
    "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 9 + " AKIA123", "deadbeef" * 4 + " " + "0" * 23, "😀😀 token: 123456 " + "a1" * 12, "token=" + "f" * 30,
    "x" * 5000 + " secret = " + "q" * 50,
]


def test_base_spans(spark):
    rows = [(i, t) for i, t in enumerate(SECRET_TEXTS)]
    out = secrets.find_secrets(documents(spark, rows, "values", "linked"))
    no_python(out)
    got = {r.doc_id: [tuple(s) for s in r.base] for r in out.collect()}
    assert got == {i: brute_spans(t or "") for i, t in rows}
    assert secrets.find_secrets(documents(spark, rows).limit(0)).collect() == []


def test_weak_parts_need_their_complements(spark):
    key, access, account, endpoint = "Zz9/" * 10, "AKIA" + "Q" * 16, "client_id: svc-7", "https://db.example/x"
    far = " filler" * 60
    rows = [
        (1, key), (2, endpoint), (3, account), (4, f"{access} {key}"), (5, access + far + " " + key), (6, f"{account} {key} {endpoint}"),
        (7, f"{endpoint} {access}"), (8, f"{account} token=abcdefgh"), (9, f"{endpoint} {access} token=abcdefgh"), (9, f"{endpoint} {access} token=abcdefgh"), (None, f"{access} {key}"),
    ]
    out = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kinds = sorted((str(r.doc_id), [secrets.KINDS[s.rank] for s in r.linked]) for r in out)
    want = {"1": [], "2": [], "3": [], "4": ["key"], "5": [], "6": ["account", "key", "endpoint"], "7": [], "8": ["account"], "9": ["endpoint"], "None": ["key"]}
    assert kinds == sorted([(k, v) for k, v in want.items()] + [("9", ["endpoint"])])


def brute_linked(text, reach=200):
    """Every part against every other one."""
    weak = []
    for rank, pattern in ((3, secrets.ACCOUNT), (4, secrets.KEY40), (5, secrets.ENDPOINT)):
        weak += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text)]
    base = brute_spans(text)
    weak = [p for p in weak if p[1] == 5 or not any(b[0] < p[2] and p[0] < b[2] for b in base)]
    out = []
    for p in weak:
        near = {q[1] for q in weak + base if q != p and q[0] - p[2] <= reach and p[0] - q[2] <= reach}
        identifier, secret = bool(near & {1, 3}), bool(near & {0, 2, 4})
        if {3: secret, 4: identifier, 5: identifier and secret}[p[1]]:
            out.append(p)
    return sorted(out)


def test_linked_spans_against_every_pair(spark):
    rows = []
    for seed in range(60):
        pick = random.Random(seed)
        parts = ["client_id: svc-7", "Zz9/" * 10, "https://db.example/x", "AKIA" + "Q" * 16, "token=abcdefgh", "deadbeef" * 4, "user_name=" + "ab" * 20, "token=https://a.example/" + "b" * 450]
        text = "".join(pick.choice(parts) + " é" + "x " * pick.choice([0, 3, 60, 97, 100, 140]) for _ in range(pick.randrange(1, 14)))
        rows.append((seed, text))
    docs = documents(spark, rows, "bin", "p", "q", "weak")
    out = secrets.find_secrets(docs)
    no_python(out)
    got = {r.doc_id: r for r in out.collect()}
    texts = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    assert sum(len(r.linked) for r in got.values()) > 60
    for i, text in rows:
        assert [tuple(s) for s in got[i].linked] == brute_linked(text)
        assert [tuple(s) for s in got[i].base] == brute_spans(text)
        clean, at = "", 0
        for a, _, b in sorted(brute_spans(text) + brute_linked(text)):
            if a >= at:
                clean += text[at:a] + "[SECRET]"
            at = max(at, b)
        assert texts[i] == clean + text[at:]


def test_a_text_of_many_secrets(spark):
    """Linear in the matches: growing arrays or counting up to each place would take hours."""
    count = 40_000
    text = " ".join(f"é{i:05d}{'deadbeef' * 3} client_id: svc-{i}" for i in range(count))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = secrets.find_secrets(docs).selectExpr("size(base) AS base", "size(linked) AS linked", "base[39999] AS last").first()
    assert (row.base, row.linked) == (count, count)
    assert text[row["last"].start : row["last"].end] == f"{count - 1:05d}" + "deadbeef" * 3
    clean = secrets.redact_secrets(docs).first().text
    assert clean == " ".join(["é[SECRET] [SECRET]"] * count)


def test_op10(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(SECRET_TEXTS)]
    for r in secrets.op10_secret_scan(spark, table_folder(spark, tmp_path, documents=documents(spark, rows))).collect():
        base = brute_spans(SECRET_TEXTS[r.doc_id] or "")
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert r.base_sha256 == sha(text) and r.spans == text


def test_redaction(spark):
    rows = [(1, "a token=abcdefgh b"), (1, "a token=abcdefgh b"), (2, "token=" + "f" * 30 + " end"), (3, None), (4, "plain")]
    docs = documents(spark, rows, "x", "is")
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in out.collect())
    assert got == [(1, "a [SECRET] b"), (1, "a [SECRET] b"), (2, "[SECRET] end"), (3, None), (4, "plain")]
