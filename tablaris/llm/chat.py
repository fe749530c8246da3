"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share them: a node of a tree is a
turn with all turns before it, and its formatted segment is emitted once. The
nodes of a tree are laid out depth-first; each carries the position id of its
first token, which its own path alone decides, and the intervals of the sequence
that it may attend to, its ancestors'. A token is one code point.

A tree is cut into chains: each conversation goes on alone from some turn, and of
those that share a node the one with the least hash of its end owns it, so what a
conversation owns is the end of its path. A chain is laid out in one piece, then
what branches off it, the deepest first. So only chains are ordered, each by the
chains it comes through, and what a node attends to is one interval for each of
them: all of it together is no longer than the turns. The order is Spark's own:
chains are range-partitioned and sorted, a running sum gives places within a
partition, and one total for each partition moves them on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablaris.llm.common import shuffle_partitions, stage, table

# The template's marks and the control strings of common templates.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = r"([<\[])(?=(?<=<)(?:\||/?s>|</?SYS>>|unk>|pad>)|(?<=\[)/?INST\])"


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


@dataclass
class ChatForest:
    """``turns``: tree_id, chain, offset (in the tree's sequence), place (number in
    the sequence), depth, segment, position (of its first token), loss_start and
    loss_end (in the segment; null without loss). ``chains``: chain, start and first
    (offset and place of its first node), spans (array of (start, end, first, stop):
    the offsets and places that all its nodes attend to besides those before them in
    the chain; touching ones are one). ``conversations``: conv_id and the tree_id,
    offset of its last turn.
    """

    turns: DataFrame
    chains: DataFrame
    conversations: DataFrame

    @property
    def nodes(self) -> DataFrame:
        """``turns`` with ancestors (array of (start, end), one for each, from the root on) for chain.

        That is as long as the square of a conversation's turns; nothing else here reads it.
        """
        length = F.char_length("segment").cast("long")
        above = attended(self.turns, self.chains).select("tree_id", F.col("offset").alias("of"), "place")
        spans = above.join(self.turns.select("tree_id", "place", F.struct(F.col("offset").alias("start"), (F.col("offset") + length).alias("end")).alias("span")), ["tree_id", "place"])
        spans = spans.groupBy("tree_id", F.col("of").alias("offset")).agg(F.sort_array(F.collect_list("span")).alias("ancestors"))
        none = F.array().cast(spans.schema["ancestors"].dataType)
        return self.turns.join(spans, ["tree_id", "offset"], "left").select(
            "tree_id", "offset", "depth", "segment", "position", F.coalesce("ancestors", none).alias("ancestors"), "loss_start", "loss_end"
        )


def attended(turns: DataFrame, chains: DataFrame) -> DataFrame:
    """A row for each place that each of ``turns`` attends to: tree_id, offset, place."""
    own = F.struct(F.col("first").alias("first"), F.col("place").alias("stop"))
    spans = F.concat(F.transform("spans", lambda x: F.struct(x["first"].alias("first"), x["stop"].alias("stop"))), F.array(own))
    each = turns.select("tree_id", "chain", "offset", "place").join(chains, "chain").select("tree_id", "offset", F.explode(spans).alias("x"))
    each = each.where("x.first < x.stop")
    return each.select("tree_id", "offset", F.explode(F.sequence("x.first", F.col("x.stop") - 1)).alias("place"))


def merged(spans: Column) -> Column:
    """Sorted spans, those that touch as one."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), x["end"].alias("end"), last["first"].alias("first"), x["stop"].alias("stop"))
        n = F.size(done)
        return F.when((n > 0) & (F.get(done, n - 1)["end"] == x["start"]), F.concat(F.slice(done, 1, F.greatest(n - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.slice(spans, 1, 0), add)


def format_chats(df: DataFrame, loss_role: str = "assistant") -> ChatForest:
    """Prefix trees of the conversations in ``df`` (conv_id, turn, role, text).

    Turns go by turn, then role, then text, nulls first; repeated rows are turns
    of their own. Null role or text is empty; rows with a null conv_id are one
    conversation. Equal conversations share their last node. Other columns are
    ignored. An empty table gives empty results.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = df.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("depth", F.row_number().over(order))
    # A turn with all before it is known by two hashes that also hold each turn's place.
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    in_conv = Window.partitionBy("conv_id").orderBy("depth")
    keys = [F.bit_xor(F.xxhash64(F.lit(seed), "depth", "role", "text")).over(so_far).alias(f"p{seed}") for seed in (1, 2)]
    rows = rows.select("*", *keys).withColumn("p", F.struct("p1", "p2"))
    whole = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "conv_id", "depth", "role", "text", "p", F.first("p").over(so_far).alias("tree"), F.last("p").over(whole).alias("finish"),
        F.lead("depth").over(in_conv).isNull().alias("last"),
    )
    rows = stage(rows, "chat-turns")
    body = F.concat(F.lit(TURN), escaped(F.min("role")), F.lit(BODY))
    text = escaped(F.min("text"))
    nodes = rows.groupBy("tree", "p").agg(
        F.min("depth").alias("depth"),
        F.min("finish").alias("chain"),
        F.concat(body, text, F.lit(END)).alias("segment"),
        F.when(F.min("role") == loss_role, F.char_length(body)).alias("loss_start"),
        F.when(F.min("role") == loss_role, F.char_length(body) + F.char_length(text)).alias("loss_end"),
    )
    nodes = nodes.withColumn("length", F.char_length("segment").cast("long"))
    in_chain = Window.partitionBy("chain").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.select("*", F.sum("length").over(in_chain).alias("upto"), F.count("*").over(in_chain).alias("number"))
    nodes = stage(nodes, "chat-nodes")
    # The chains that each conversation comes through: where it enters, how far it goes.
    hops = rows.select("tree", "p", "finish").join(nodes.select("tree", "p", "chain", "depth", "upto", "number"), ["tree", "p"])
    hops = hops.groupBy("tree", "finish", "chain").agg(F.min("depth").alias("at"), F.max("upto").alias("length"), F.max("number").alias("n"))
    hops = hops.groupBy("tree", "finish").agg(F.sort_array(F.collect_list(F.struct("at", "chain", "length", "n"))).alias("hops"))
    own = F.element_at("hops", -1)
    chains = hops.where(own["chain"] == F.col("finish")).select(
        "tree", F.col("finish").alias("chain"), "hops", F.transform("hops", lambda x: F.struct((-x["at"]).alias("at"), x["chain"].alias("chain"))).alias("key"),
        own["length"].alias("length"), own["n"].alias("n"),
    )
    chains = chains.repartitionByRange(shuffle_partitions(df.sparkSession), "tree", "key").sortWithinPartitions("tree", "key")
    chains = stage(chains.select("*", F.spark_partition_id().alias("part")), "chat-chains")
    before = Window.partitionBy("part").orderBy("tree", "key").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition: small however many chains there are.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = chains.groupBy("part").agg(F.sum("length").alias("length"), F.sum("n").alias("n"))
    totals = totals.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"base_{c}") for c in ("length", "n")])
    placed = chains.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"at_{c}") for c in ("length", "n")])
    placed = placed.join(F.broadcast(totals), "part").withColumns({f"at_{c}": F.col(f"at_{c}") + F.col(f"base_{c}") for c in ("length", "n")})
    placed = stage(placed.select("tree", "chain", "hops", "at_length", "at_n"), "chat-placed")
    roots = placed.where(F.size("hops") == 1).select("tree", F.col("at_length").alias("root_length"), F.col("at_n").alias("root_n"))
    placed = placed.join(roots, "tree").select(
        "tree", "chain", "hops", (F.col("at_length") - F.col("root_length")).alias("start"), (F.col("at_n") - F.col("root_n")).alias("first")
    )
    placed = stage(placed, "chat-starts")
    # What a chain's nodes attend to outside it.
    above = placed.select("chain", F.explode(F.slice("hops", F.lit(1), F.size("hops") - 1)).alias("x")).select("chain", F.col("x.chain").alias("over"), "x.length", "x.n")
    above = above.join(placed.select(F.col("chain").alias("over"), "start", "first"), "over")
    span = F.struct("start", (F.col("start") + F.col("length")).alias("end"), "first", (F.col("first") + F.col("n")).alias("stop"))
    above = above.groupBy("chain").agg(F.sort_array(F.collect_list(span)).alias("spans"), F.sum("length").alias("base"))
    above = above.select("chain", merged(F.col("spans")).alias("spans"), "base")
    none = F.array().cast(above.schema["spans"].dataType)
    placed = placed.join(above, "chain", "left").select("chain", "start", "first", F.coalesce("spans", none).alias("spans"), F.coalesce("base", F.lit(0)).alias("base"))
    placed = stage(placed, "chat-spans")
    name = F.concat(F.hex("tree.p1"), F.hex("tree.p2")).alias("tree_id")
    inside = F.col("upto") - F.col("length")
    turns = nodes.join(placed.drop("spans"), "chain").select(
        name, "tree", "p", "chain", (F.col("start") + inside).alias("offset"), (F.col("first") + F.col("number") - 1).alias("place"), "depth", "segment",
        (F.col("base") + inside).alias("position"), "loss_start", "loss_end",
    )
    turns = stage(turns, "chat-forest")
    conversations = rows.where("last").select("conv_id", "tree", "p").join(turns.select("tree", "p", "tree_id", "offset"), ["tree", "p"]).select("conv_id", "tree_id", "offset")
    return ChatForest(turns.drop("tree", "p"), placed.drop("base"), conversations)


def read_back(forest: ChatForest) -> DataFrame:
    """Conversations from the emitted sequences: conv_id, formatted, loss (array of texts).

    Each last turn gathers what it attends to, then itself, in sequence order.
    """
    turns = forest.turns
    ends = stage(turns.join(forest.conversations.select("tree_id", "offset").distinct(), ["tree_id", "offset"]).select("tree_id", "chain", "offset", "place"), "chat-ends")
    wanted = attended(ends, forest.chains).union(ends.select("tree_id", "offset", "place")).withColumnRenamed("offset", "leaf")
    parts = wanted.join(turns, ["tree_id", "place"]).groupBy("tree_id", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("offset", "segment", "loss_start", "loss_end"))).alias("parts")
    )
    lost = F.filter("parts", lambda x: x["loss_start"].isNotNull())
    whole = parts.select(
        "tree_id",
        F.col("leaf").alias("offset"),
        F.array_join(F.col("parts.segment"), "").alias("formatted"),
        F.transform(lost, lambda x: unescaped(F.substring(x["segment"], x["loss_start"] + 1, x["loss_end"] - x["loss_start"]))).alias("loss"),
    )
    return forest.conversations.join(whole, ["tree_id", "offset"]).select("conv_id", "formatted", "loss")


def turns_of(formatted: Column) -> Column:
    """Array of (role, text) parsed from a formatted conversation."""
    marks = [m.replace("|", r"\|") for m in (END, BODY)]
    each = F.filter(F.split(formatted, marks[0], -1), lambda s: s != "")
    halves = F.transform(each, lambda s: F.split(F.substr(s, F.lit(len(TURN) + 1)), marks[1], -1))
    return F.transform(halves, lambda h: F.struct(unescaped(F.get(h, F.lit(0))).alias("role"), unescaped(F.get(h, F.lit(1))).alias("text")))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    back = read_back(format_chats(given.union(extra)))
    back = back.withColumns({"turns": turns_of(F.col("formatted")), "all_loss": F.array_join("loss", "")})
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("all_loss").cast("long").alias("loss_chars"),
        F.sha2("all_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
    SELECT *, role || body AS said,
           role || chr(10) || body || chr(10) AS one
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(one, '' ORDER BY turn, role, body)) AS turns_sha256,
       CAST(coalesce(sum(length(body)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(body, '' ORDER BY turn, role, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + 8 + 7 + length(said) + length(said) - length(replace(said, '\', ''))
           + len(regexp_extract_all(role, '<\||<s>|</s>|<<SYS>>|<</SYS>>|<unk>|<pad>|\[INST\]|\[/INST\]'))
           + len(regexp_extract_all(body, '<\||<s>|</s>|<<SYS>>|<</SYS>>|<unk>|<pad>|\[INST\]|\[/INST\]'))) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
