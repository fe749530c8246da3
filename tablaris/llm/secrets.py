"""Secret scan with multipart credential linking, DataFrame functions only.

Strong patterns are reported as they are. Weak parts (an account identifier, a
bare 40-character key, an endpoint) mean nothing alone, so each is reported only
when the parts that complete it to a credential lie within ``reach`` code points
of it. Parts become intervals, intervals are dealt to bins of that width, and an
interval join on (row, bin) finds the neighbours; matches of one kind cannot
overlap, so a bin holds a bounded number of them and the join stays linear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablaris.llm.common import stage, table

# The base patterns. Runs below the least length fail as a whole,
# so for `access` and `hex` the length is part of the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak parts.
ACCOUNT = r"(?i:access_?key_?id|client_?id|account_?id|user_?name|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@_.-]{4,}"
KEY40 = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"(?i:https?|wss?|postgres|mysql|redis|amqp|mongodb)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]{4,}"

KINDS = ["assign", "access", "hex", "account", "key", "endpoint"]
IDENTIFIERS, SECRETS = ["access", "account"], ["assign", "hex", "key"]
SPAN, GAPS = "array<struct<start:int,rank:int,end:int>>", "array<struct<start:int,end:int>>"
CHUNK = 512  # matches of a text that are taken together

def running(items: Column, kind: str, first: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``out`` of (at, out: ``kind``), carried through ``items`` by ``step`` from at = ``first``.

    An array that grows by one copies itself at every step, so it grows chunk by
    chunk: the work is linear but for a small part. ``items`` must be a column, as an
    expression would be evaluated for each chunk.
    """
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / CHUNK).cast("int")), lambda k: F.slice(items, k * CHUNK + 1, CHUNK))
    empty = F.array().cast(kind)

    def advance(acc: Column, chunk: Column) -> Column:
        own = F.struct(acc["at"].alias("at"), empty.alias("out"))
        return F.aggregate(chunk, own, step, lambda done: F.struct(done["at"].alias("at"), F.concat(acc["out"], done["out"]).alias("out")))

    return F.aggregate(chunks, F.struct(first.alias("at"), empty.alias("out")), advance, lambda acc: acc["out"])


def gaps_and_lengths(text: Column, matches: Column, pattern: str) -> Column:
    """(g, m) of a pattern's matches: code points before each, and in it. What lies between matches is the split by them."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(F.char_length(g).alias("g"), F.char_length(m).alias("m")))
    return F.when(F.size(matches) > 0, pairs)  # most texts have none, and are not split


def located(pairs: Column, rank: int) -> Column:
    """Spans of :func:`gaps_and_lengths`, which should be a column by now."""

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["g"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["m"]).alias("end"))
        return F.struct((begin + x["m"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(pairs.isNotNull(), running(pairs, SPAN, F.lit(0), step)).otherwise(F.array().cast(SPAN))


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )

def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """One row per input row: id, base (array of spans), linked (array of spans), row.

    A span is (start, rank in ``KINDS``, end) in code points, end exclusive.
    ``linked`` holds weak parts: an account needs a secret within ``reach``, a
    bare key an identifier, an endpoint both. ``row`` is one for rows of the same id
    and text. Null text counts as empty and has
    no spans; equal rows give equal results; ids may repeat or be null. Other
    columns are ignored, whatever their names. An empty table gives an empty
    result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = dict(zip(KINDS, [ASSIGN, ACCESS, HEX, ACCOUNT, KEY40, ENDPOINT]))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.withColumns({f"m_{k}": F.regexp_extract_all("text", F.lit(p), F.lit(0)) for k, p in patterns.items()})
    rows = rows.withColumn("values", F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    rows = rows.withColumns({f"p_{k}": gaps_and_lengths(F.col("text"), F.col(f"m_{k}"), p) for k, p in patterns.items()})
    rows = rows.withColumns({f"s_{k}": located(F.col(f"p_{k}"), i) for i, k in enumerate(patterns)})
    long_enough = F.filter("s_assign", lambda s, i: F.char_length(F.get(F.col("values"), i)) >= 6)
    rows = stage(
        rows.select(
            "id",
            # A row is known by its id and text; the digest stands for the text from here on.
            row_key(F.col("id"), F.col("text")).alias("row"),
            F.concat(long_enough, "s_access", "s_hex").alias("base"),
            F.concat("s_account", "s_key", "s_endpoint").alias("weak"),
        ),
        "secrets",
    )
    ranks = lambda kinds: [F.lit(KINDS.index(k)) for k in kinds]

    def bins(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach))).alias("bin")

    found = rows.where(F.size("weak") > 0)
    weak = found.select("row", F.explode("weak").alias("p")).distinct()
    strong = found.select("row", F.explode("base").alias("p")).distinct()
    # Of a weak part that a base span covers, only an endpoint stays.
    covered = weak.where(F.col("p.rank") != KINDS.index("endpoint")).select("row", "p", bins(F.col("p.start"), F.col("p.end")))
    covered = covered.join(strong.select("row", F.col("p").alias("q"), bins(F.col("p.start"), F.col("p.end"))), ["row", "bin"])
    covered = covered.where("q.start < p.end AND p.start < q.end").select("row", "p").distinct()
    weak = weak.join(covered, ["row", "p"], "left_anti")
    parts = weak.union(strong)
    completing = parts.where(F.col("p.rank").isin(*map(KINDS.index, IDENTIFIERS + SECRETS)))
    near = completing.select("row", F.col("p").alias("q"), bins(F.greatest(F.col("p.start") - reach, F.lit(0)), F.col("p.end") + reach))
    wanted = weak.select("row", "p", bins(F.col("p.start"), F.col("p.end")))
    linked = (
        wanted.join(near, ["row", "bin"])
        .where("q <> p AND q.start - p.end <= {0} AND p.start - q.end <= {0}".format(reach))
        .groupBy("row", "p")
        .agg(
            F.max(F.col("q.rank").isin(*ranks(IDENTIFIERS))).alias("identifier"),
            F.max(F.col("q.rank").isin(*ranks(SECRETS))).alias("secret"),
        )
        .where(
            F.when(F.col("p.rank") == KINDS.index("account"), F.col("secret"))
            .when(F.col("p.rank") == KINDS.index("key"), F.col("identifier"))
            .otherwise(F.col("identifier") & F.col("secret"))
        )
        .groupBy("row")
        .agg(F.collect_list("p").alias("linked"))
    )
    return rows.join(linked, "row", "left").select(
        F.col("id").alias(id_col),
        F.sort_array("base").alias("base"),
        F.sort_array(F.coalesce("linked", F.array().cast(SPAN))).alias("linked"),
        "row",
    )


def row_key(given: Column, text: Column) -> Column:
    """The id and the text's digest, as one string."""
    return F.concat_ws(":", F.coalesce(given.cast("string"), F.lit("-")), F.md5(text))


def redact_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", reach: int = 200) -> DataFrame:
    """``df`` with every span of :func:`find_secrets` replaced by ``mark``.

    Spans that overlap become one mark. Texts without spans, null ones too, stay as
    they are, and so do all other columns and the number of rows.
    """
    found = find_secrets(df, id_col, text_col, reach)
    found = found.select("row", F.concat("base", "linked").alias("spans")).where(F.size("spans") > 0).dropDuplicates(["row"])
    rows = df.select(F.struct("*").alias("x"), row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("is"))
    rows = rows.join(found, F.col("is") == F.col("row"), "left").withColumn("spans", F.sort_array("spans"))
    text = F.col("x")[text_col]

    def step(acc: Column, s: Column) -> Column:
        """What stands between the marks: from the end of one to the start of the next."""
        gap = F.array(F.struct(acc["at"].alias("start"), s["start"].alias("end")))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap)).otherwise(acc["out"]).alias("out")
        )

    # With four bytes to a code point a part of the text is found by its place, not by counting up to it.
    rows = rows.withColumns({"wide": F.when(F.col("spans").isNotNull(), F.encode(text, "UTF-32")), "gaps": running(F.col("spans"), GAPS, F.lit(0), step)})
    last = F.struct(F.array_max(F.transform("spans", lambda s: s["end"])).alias("start"), (F.length("wide") / 4).cast("int").alias("end"))
    rows = rows.withColumn("gaps", F.concat("gaps", F.array(last)))

    def stretch(k: Column) -> Column:
        """The parts of a chunk, with the bytes they lie in: a column's bytes are copied whenever it is read."""
        own = F.slice("gaps", k * CHUNK + 1, CHUNK)
        first = F.get("gaps", k * CHUNK)["start"]
        end = F.get("gaps", F.least((k + 1) * CHUNK, F.size("gaps")) - 1)["end"]
        return F.struct(own.alias("gaps"), first.alias("first"), F.substring("wide", 4 * first + 1, 4 * (end - first)).alias("bytes"))

    def texts(s: Column) -> Column:
        return F.transform(
            s["gaps"], lambda g: F.decode(F.substring(s["bytes"], 4 * (g["start"] - s["first"]) + 1, 4 * (g["end"] - g["start"])), "UTF-32")
        )

    chunks = F.sequence(F.lit(0), F.floor((F.size("gaps") - 1) / CHUNK).cast("int"))
    parts = F.flatten(F.transform(F.transform(chunks, stretch), texts))
    clean = F.array_join(parts, mark)
    return rows.select(*[F.when(F.col("spans").isNull(), text).otherwise(clean).alias(c) if c == text_col else F.col("x")[c].alias(c) for c in df.columns])


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "linked")).alias("spans"),
    )
