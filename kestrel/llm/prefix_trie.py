"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is a sequence of turns; a node is a distinct sequence of first turns. Conversations are cut into blocks of
``BLOCK`` turns, one row per block with its turns in columns ``t0 .. t7`` and the key of the node where the block
starts. One ``GROUP BY block, key, ROLLUP(t0, .., t7)`` then aggregates all prefixes of all blocks together, ``grouping_id``
telling the depth; a long conversation goes on in further blocks, keyed by the node its prior block ends in, so the
number of passes does not depend on how long conversations are. A node's key is a sum of hashes of its (position, turn)
pairs, three lanes modulo 2**40, so keys of all blocks are running sums.

A second ROLLUP over the nodes themselves sums what lies below each node. What lies below a block's last
turns (its child blocks) is added first, by pointer doubling over the tree of blocks: as many rounds as the logarithm
of the longest conversation.

Turns are put in order by one range sort of all rows; no task ever holds a whole conversation. Conversations that end in a node
are hashed in order as a stream of joined runs of at most ``RUN`` ids.

Defined results: null role or text becomes empty; rows without a conv_id belong to no conversation; turns are ordered by turn (null
first), then role, then text, so repeated rows are turns of their own; an empty table gives no node; other columns are
ignored; long texts are hashed once, when read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import map_arrow
from kestrel.session import materialize

BLOCK, LANES, RUN, SPAN = 8, 3, 4096, 1024
_MASK = (1 << 40) - 1
TURNS = [f"t{i}" for i in range(BLOCK)]
KEY = [f"k{i}" for i in range(LANES)]
NODE = ["depth", *(f"a{i}" for i in range(LANES))]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of a turn, the role's length first so that (role, text) pairs cannot run together."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def _lane(k: int, turn: Column, position: Column) -> Column:
    """40 bits of (position, turn); none for a missing turn."""
    return F.when(turn.isNotNull(), F.shiftrightunsigned(F.xxhash64(F.lit(k), turn["id"], position.cast("long")), 24)).otherwise(0)


def _masked(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_MASK))


def turn_dictionary(conversations: DataFrame) -> DataFrame:
    """``turn_id``, role and text of every distinct turn: the nodes' texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select(turn_id(role, text).alias("turn_id"), role.alias("role"), text.alias("text")).distinct()


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, spans). Turns: conv_id, t (id and words), with the range partition and the place in it, written once. Spans: a row per
    conversation and range partition: its first place there, its rows in earlier partitions and in all."""
    src = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')").cast("long")
    turns = materialize(src.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "conv_id", F.struct(turn_id(F.col("role"), F.col("text")).alias("id"), words.alias("words")).alias("t"),
        F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "turns")
    own = turns.groupBy("conv_id", "pid").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    w = Window.partitionBy("conv_id")  # a row per range partition that holds the conversation
    spans = own.select("conv_id", "pid", "first", F.sum("n").over(w).alias("total"),
                       F.coalesce(F.sum("n").over(w.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return turns, spans


def sequences(conversations: DataFrame, family: int = 0, most_shared: int = 4) -> DataFrame:
    """conv_id, position, t and ``last`` (does the conversation end here); a conversation without turns has one row
    without position. With ``family`` = f, conversation c takes its first h = crc32(c) % most_shared turns from conversation c - c % f
    (as many as that has; none if there is none) and goes on with its own turns after its first h."""
    turns, spans = ordered_turns(conversations)
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most_shared)) if family else F.lit(0)
    spans = spans.withColumn("h", h.cast("long"))
    here = F.col("place") - F.col("first") + F.col("before")
    if family:
        heads = (turns.where(F.col("conv_id") % family == 0).join(spans, ["conv_id", "pid"]).withColumn("at", here)
                 .where(F.col("at") < most_shared - 1).groupBy(F.col("conv_id").alias("head"))
                 .agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("heads")))  # at most most_shared - 1 turns
        spans = (spans.withColumn("head", F.col("conv_id") - F.col("conv_id") % family).join(heads, "head", "left")
                 .withColumn("shared", F.when(F.col("h") > 0, F.slice(F.coalesce("heads", F.array()), F.lit(1), F.greatest("h", F.lit(1)).cast("int")))
                             .otherwise(F.array())))
    else:
        spans = spans.withColumn("shared", F.expr("CAST(array() AS ARRAY<STRUCT<at: BIGINT, t: STRUCT<id: BINARY, words: BIGINT>>>)"))
    spans = (spans.withColumn("n_shared", F.size("shared").cast("long"))
             .withColumn("length", F.col("n_shared") + F.greatest(F.col("total") - F.col("h"), F.lit(0))))
    own = (turns.join(spans.drop("shared", "heads", "head"), ["conv_id", "pid"]).withColumn("at", here).where(F.col("at") >= F.col("h"))
           .select("conv_id", (F.col("at") - F.col("h") + F.col("n_shared")).alias("position"), "t", "length"))
    once = spans.where(F.col("before") == 0)  # a row per conversation
    shared = once.select("conv_id", F.posexplode("shared").alias("position", "s"), "length").select(
        "conv_id", F.col("position").cast("long"), "s.t", "length")
    none = once.where(F.col("length") == 0).select("conv_id", F.lit(None).cast("long").alias("position"), F.lit(None).cast(own.schema["t"].dataType).alias("t"), "length")
    rows = own.unionByName(shared).unionByName(none)
    return rows.select("conv_id", "position", "t", (F.coalesce("position", F.lit(-1)) == F.col("length") - 1).alias("last"))


def blocks(turns: DataFrame) -> DataFrame:
    """A row per conversation and block: block number, key of the node it starts in, turns, its own lanes, and whether the
    conversation ends in it. Written once."""
    at = F.col("position") % BLOCK
    cut = (turns.withColumn("block", F.coalesce(F.expr(f"position div {BLOCK}"), F.lit(0)))
           .groupBy("conv_id", "block").agg(
               F.sort_array(F.collect_list(F.when(F.col("t").isNotNull(), F.struct(at.alias("at"), "t")))).alias("row"),  # at most BLOCK
               *(F.sum(_lane(k, F.col("t"), F.col("position"))).alias(f"s{k}") for k in range(LANES)), F.max("last").alias("ends")))
    # running sums in two levels: inside spans of SPAN blocks, and over the spans
    cut = cut.withColumn("span", F.expr(f"block div {SPAN}"))
    inner = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = cut.groupBy("conv_id", "span").agg(*(_masked(F.sum(f"s{k}")).alias(f"x{k}") for k in range(LANES)))
    spans = spans.select("conv_id", "span", *(F.coalesce(F.sum(f"x{k}").over(outer), F.lit(0)).alias(f"x{k}") for k in range(LANES)))
    keyed = cut.join(spans, ["conv_id", "span"]).select(
        "conv_id", "block", *(_masked(F.coalesce(F.sum(f"s{k}").over(inner), F.lit(0)) + F.col(f"x{k}")).alias(KEY[k]) for k in range(LANES)),
        *(F.get("row", F.lit(i))["t"].alias(TURNS[i]) for i in range(BLOCK)), F.size("row").alias("size"), "ends",
        *(f"s{k}" for k in range(LANES)))
    return materialize(keyed, "trie-blocks")


def _rolled(df: DataFrame, aggregates: str) -> DataFrame:
    """The prefixes of all blocks with ``level`` turns, their node's key and their parent's."""
    name = f"trie_rows_{id(df)}"
    df.createOrReplaceTempView(name)
    groups = ", ".join(["block", *KEY])
    out = df.sparkSession.sql(f"SELECT {groups}, {', '.join(TURNS)}, {BLOCK} - bit_count(grouping_id()) AS level, {aggregates} "
                              f"FROM {name} GROUP BY {groups}, ROLLUP({', '.join(TURNS)})")
    df.sparkSession.catalog.dropTempView(name)
    real = F.element_at(F.array(F.lit(True), *(F.col(t).isNotNull() for t in TURNS)), F.col("level") + 1)
    out = out.where(real & ((F.col("level") > 0) | (F.col("block") == 0)))

    def lanes(k: int, upto: Column) -> Column:
        own = (F.when(F.lit(i) < upto, _lane(k, F.col(t), F.col("block") * BLOCK + i)).otherwise(0) for i, t in enumerate(TURNS))
        return _masked(reduce(lambda x, y: x + y, own, F.col(KEY[k])))

    out = out.withColumn("depth", F.col("block") * BLOCK + F.col("level"))
    return out.select("*", *(lanes(k, F.col("level")).alias(f"a{k}") for k in range(LANES)),
                      *(lanes(k, F.col("level") - 1).alias(f"p{k}") for k in range(LANES)))


def _below_blocks(nodes: DataFrame) -> DataFrame:
    """Per block after the first of its conversations (number and key): the saved tokens and leaves of its nodes and of all blocks below, by pointer doubling."""
    ident = ["block", *KEY]
    own = nodes.where(F.col("block") > 0).groupBy(*ident).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    up = nodes.where((F.col("level") == BLOCK) & (F.col("block") > 0)).select(
        (F.col("block") + 1).alias("block"), *(F.col(f"a{k}").alias(KEY[k]) for k in range(LANES)),
        F.struct("block", *KEY).alias("up"))
    tree = materialize(own.join(up, ident, "left").select(F.struct(*ident).alias("id"), "up", "saved", "leaf"), "trie-tree")
    while not tree.where(F.col("up").isNotNull()).isEmpty():
        gain = (tree.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("id"))
                .agg(F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaf")))
        further = tree.select(F.col("id").alias("up"), F.col("up").alias("further"))
        tree = materialize(tree.join(gain, "id", "left").join(further, "up", "left").select(
            "id", F.col("further").alias("up"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf")), "trie-tree")
    return tree.select("id.*", "saved", "leaf")


def _end_hashes(cut: DataFrame) -> DataFrame:
    """Per node where conversations end: the SHA-256 of their ids in order, joined by commas."""
    ends = cut.where("ends").select("conv_id", (F.col("block") * BLOCK + F.col("size")).alias("depth"),
                                    *(_masked(F.col(KEY[k]) + F.col(f"s{k}")).alias(f"a{k}") for k in range(LANES)))
    run = F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")))
    runs = ends.groupBy(*NODE, F.expr(f"conv_id div {RUN}").alias("run")).agg(run.alias("ids"))  # at most 2 * RUN ids
    ordered = runs.repartition(*NODE).sortWithinPartitions(*NODE, "run")

    def digest(batches):
        held, state = None, None
        for batch in batches:
            out = []
            for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == held:
                    state.update(b",")
                else:
                    if held:
                        out.append((*held, state.hexdigest()))
                    held, state = node, hashlib.sha256()
                state.update(ids.encode())
            yield _digests(out)
        if held:
            yield _digests([(*held, state.hexdigest())])

    return map_arrow(ordered, digest, ", ".join(f"{c} bigint" for c in NODE) + ", ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * (len(NODE) + 1)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.string())], names=[*NODE, "ends_sha256"])


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of ``sequences``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and turn_id (null for the root)."""
    cut = blocks(turns)
    last = F.element_at(F.array(F.lit(None).cast(cut.schema["t0"].dataType), *TURNS), F.col("level") + 1)
    found = materialize(_rolled(cut, "count(*) AS n_convs, min(conv_id) AS conv_id").withColumn("last", last), "trie-prefixes")
    parent = [(F.col("depth") - 1).alias("depth"), *(F.col(f"p{k}").alias(f"a{k}") for k in range(LANES))]
    kids = found.where("depth > 0").select(*parent).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = materialize(found.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                        .withColumn("saved", (F.col("n_convs") - 1) * F.coalesce("last.words", F.lit(0)))
                        .withColumn("leaf", (F.col("n_children") == 0).cast("long")), "trie-nodes")
    below = _below_blocks(nodes).select(F.col("block").alias("next"), *(F.col(KEY[k]).alias(f"a{k}") for k in range(LANES)),
                                        F.col("saved").alias("more_saved"), F.col("leaf").alias("more_leaf"))
    full = nodes.withColumn("next", F.when(F.col("level") == BLOCK, F.col("block") + 1)).join(below, ["next", *NODE[1:]], "left")
    sums = _rolled(full.select("block", *KEY, *TURNS, (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                               (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf")),
                   "sum(saved) AS saved_tokens, sum(leaf) AS n_leaves").select(*NODE, "saved_tokens", "n_leaves")
    above = nodes.select((F.col("depth") + 1).alias("depth"), *(F.col(f"a{k}").alias(f"p{k}") for k in range(LANES)), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.select(*NODE, "p0", "p1", "p2", "conv_id", "n_convs", "n_children", F.col("last.id").alias("turn_id"))
            .join(sums, NODE).join(_end_hashes(cut), NODE, "left").join(above, ["depth", "p0", "p1", "p2"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "turn_id"))
