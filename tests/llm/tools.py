"""Small tables with the awkward rows, and brute-force versions."""

from __future__ import annotations

import hashlib
import random

WORDS = "the of and to in is that it was for on are with as his they at be this from have or by one had not but what".split()
#: Columns that operators use inside or add, to clash with.
CLASHING = ["ids", "n", "node", "row", "base", "batch", "hash", "norm", "offset", "text_hash", "digest", "score", "n_lines", "_group"]


def sentence(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(60)) for _ in range(words))


def awkward() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, a long one, equal texts, repeated rows."""
    long = "\n".join(sentence(i, 12) for i in range(600))
    return [
        (1, sentence(1, 60)),
        (2, None),
        (3, ""),
        (4, "  \t\n "),
        (5, long),
        (6, long.replace("the", "a")),
        (7, sentence(1, 60)),
        (7, sentence(1, 60)),
        (8, sentence(1, 60) + " end"),
        (9, "Ünïcödé 😀 \n\n  tabs\t\tand  spaces  " + "x" * 3000),
        (10, "one two"),
        (11, "One, two!"),
        (None, sentence(2, 30)),
    ]


def documents(spark, rows, *more: str):
    """The rows as documents, with clashing columns besides."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    return df.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), **{c: F.lit(7) for c in (*CLASHING, *more)}})


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def components(nodes, links) -> dict:
    """The smallest node reachable from each."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    return root


def table_folder(spark, tmp_path, **tables) -> str:
    """A folder of tables, for the registered queries."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
