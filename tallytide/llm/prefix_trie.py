"""Conversation prefix trie as a table of nodes, keyed by prefix digests.

Every conversation is a path of nodes, one per prefix of its turns (the root is
the empty prefix). A node is named by the digest of its prefix, chained turn by
turn (``sha256(parent digest | len(role):role text)``), so equal prefixes share a
node without comparing texts. The steps:

1. enumerate: each conversation emits its prefix digests (one row a turn, and the
   root); one aggregate by digest gives members, smallest member, depth, parent
   and the words of the last text. The same aggregate verifies the digest: all
   rows of a digest must agree on depth, parent digest and last text digest, or
   the run stops (a collision);
2. slots: the distinct digests get dense slots ``0 .. nodes-1``, a contiguous range
   per shard (partition of the saved node table): shard offsets from one count a
   shard, then the position inside it; parents get their slot by a join;
3. accumulate: subtree sums (leaves, saved tokens) run in depth order along each
   conversation's own parent-slot chain: every node is charged once, to the path
   of its smallest member, and the suffix sums of that path, deepest first, are
   scattered back to the nodes of the path by one grouped sum. This needs no
   pass per depth level (conversations of hundreds of turns would need hundreds).

Digests of the members that end at a node are hashed in order of ``conv_id`` in
chunks: a range shuffle cuts a large node into many sorted chunks, and one task a
node hashes only the chunk texts, in order.

Defined results: rows with a NULL ``conv_id`` take no part; a NULL ``role`` or
``text`` is empty; turns are ordered by ``turn`` (NULL first), then role, then
text, so equal turns are in a defined order; a conversation of no turns after
its rebuild is a member of the root only; repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import SPACED_WORDS, saved
from tallytide.scale import dimension_join

GROUP = 20  # turns of conversation c - c % GROUP are borrowed
BORROW = 4  # conversation c borrows crc32(decimal c) % BORROW turns
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_CHUNK = T.StructType([
    T.StructField("dig", T.BinaryType()), T.StructField("first_id", T.LongType()),
    T.StructField("ids", T.StringType()),
])
_ENDS = T.StructType([T.StructField("dig", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])


def ordered(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its turns ``ts`` (array of role, text structs), in order."""
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (
        conversations.filter(F.col("conv_id").isNotNull())
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.array_sort(F.collect_list(turn)).alias("ts"))
        .select("conv_id", F.expr("transform(ts, t -> named_struct('role', t.role, 'text', t.text))").alias("ts"))
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every ``conv_id`` with its rebuilt turns: the first h of its group's head, then its own after its first h."""
    own = ordered(conversations)
    heads = own.select(F.col("conv_id").alias("head_id"), F.slice("ts", 1, BORROW - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BORROW)).cast("int")
    with_head = own.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "head_id", "left")
    return with_head.select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice(F.col("head"), F.lit(1), h), F.array().cast(own.schema["ts"].dataType)),
            F.slice(F.col("ts"), h + 1, F.greatest(F.size("ts"), F.lit(0)))).alias("ts"))


def paths(convs: DataFrame) -> DataFrame:
    """One row per (conversation, depth): digest and parent digest, depth, length, words of the last text,
    and ``check``, a second hash of (parent digest, last turn) that verifies the digest."""
    def step(acc, t):
        line = F.concat(F.element_at(acc, -1), F.lit("|"), F.length(t["role"]).cast("string"), F.lit(":"), t["role"],
                        t["text"])
        return F.concat(acc, F.array(F.sha2(line, 256)))

    chain = F.aggregate("ts", F.array(F.lit("")), step)
    words = F.transform("ts", lambda t: F.size(F.regexp_extract_all(t["text"], F.lit(SPACED_WORDS), F.lit(0))))
    with_chain = convs.select("conv_id", "ts", F.size("ts").alias("n_turns"), chain.alias("digs"), words.alias("words"))
    exploded = with_chain.select("conv_id", "n_turns", F.posexplode("digs").alias("depth", "hex"), "digs", "words", "ts")
    above = F.col("depth") > 0
    pdig = F.when(above, F.unhex(F.element_at("digs", F.col("depth"))))
    last = F.element_at("ts", F.greatest(F.col("depth"), F.lit(1)))
    return exploded.select(
        "conv_id", "n_turns", F.col("depth").cast("long").alias("depth"), F.unhex("hex").alias("dig"),
        pdig.alias("pdig"),
        F.when(above, F.element_at("words", F.col("depth"))).otherwise(F.lit(0)).cast("long").alias("words"),
        F.when(above, F.xxhash64(pdig, last["role"], last["text"])).otherwise(F.lit(0)).alias("check"),
    )


def _chunks(batches):
    """Comma-joined ids of each digest's run in a sorted partition; a run cut by a batch end gives two chunks."""
    for frame in batches:
        if not frame.empty:
            runs = frame.groupby("dig", sort=False)["conv_id"]
            yield runs.agg(first_id="first", ids=lambda s: ",".join(map(str, s))).reset_index()


def _hash_runs(batches):
    """SHA-256 of each digest's chunks, in order, across the batches of a sorted partition."""
    dig, h = None, None
    for frame in batches:
        for d, ids in zip(frame["dig"], frame["ids"], strict=True):
            d = bytes(d)
            if d != dig:
                if dig is not None:
                    yield pd.DataFrame({"dig": [dig], "ends_sha256": [h.hexdigest()]})
                dig, h, first = d, hashlib.sha256(), True
            h.update((ids if first else "," + ids).encode())
            first = False
    if dig is not None:
        yield pd.DataFrame({"dig": [dig], "ends_sha256": [h.hexdigest()]})


def ends_digests(rows: DataFrame) -> DataFrame:
    """``dig`` and ``ends_sha256`` for nodes where some member ends."""
    ends = rows.filter(F.col("depth") == F.col("n_turns")).select("dig", "conv_id")
    chunks = (
        ends.repartitionByRange("dig", "conv_id").sortWithinPartitions("dig", "conv_id")
        .mapInPandas(_chunks, _CHUNK)
    )
    return chunks.repartition("dig").sortWithinPartitions("dig", "first_id").mapInPandas(_hash_runs, _ENDS)


def _slots(nodes: DataFrame) -> DataFrame:
    """Dense slots: each shard (partition of the saved table) owns a contiguous range."""
    spark = nodes.sparkSession
    tagged = nodes.withColumn("_shard", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    tagged = saved(tagged)
    counts = sorted((r["_shard"], r["count"]) for r in tagged.groupBy("_shard").count().collect())  # one row a shard
    offsets, total = [], 0
    for shard, n in counts:
        offsets.append((shard, total))
        total += n
    base = spark.createDataFrame(offsets, "_shard int, _base long")
    # monotonically_increasing_id puts the shard in the upper 31 bits and the position in the lower 33
    return tagged.join(F.broadcast(base), "_shard").select(
        *nodes.columns, (F.col("_base") + F.col("_at") - F.shiftleft(F.col("_shard").cast("long"), 33)).alias("slot"))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    slot, parent_slot (see the module)."""
    rows = saved(paths(rebuilt(conversations)))
    grouped = rows.groupBy("dig").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"), F.max("depth").alias("_depth_hi"),
        F.min("pdig").alias("pdig"), F.max("pdig").alias("_pdig_hi"),
        F.min("words").alias("words"), F.max("words").alias("_words_hi"),
        F.min("check").alias("_check_lo"), F.max("check").alias("_check_hi"))
    nodes = saved(grouped)
    clash = nodes.filter(
        (F.col("depth") != F.col("_depth_hi")) | ~F.col("pdig").eqNullSafe(F.col("_pdig_hi"))
        | (F.col("words") != F.col("_words_hi")) | (F.col("_check_lo") != F.col("_check_hi")))
    if not clash.isEmpty():
        raise RuntimeError("two prefixes share a digest")
    nodes = _slots(nodes.select("dig", "n_convs", "conv_id", "depth", "pdig", "words"))
    children = nodes.filter(F.col("pdig").isNotNull()).groupBy(F.col("pdig").alias("dig")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("dig").alias("pdig"), F.col("slot").alias("parent_slot"),
                           F.col("conv_id").alias("parent_conv_id"))
    linked = dimension_join(nodes, parents, ["pdig"], spread_by=["dig"])
    linked = saved(linked.join(children, "dig", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    # every node charged to the path of its smallest member
    charge = linked.select(
        "dig", "conv_id", ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"))
    charged = rows.select("conv_id", "depth", "dig").join(charge, ["dig", "conv_id"], "left")
    deepest_first = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = charged.select(
        "dig", F.sum(F.coalesce("own_saved", F.lit(0))).over(deepest_first).alias("s"),
        F.sum(F.coalesce("own_leaf", F.lit(0))).over(deepest_first).alias("l"),
    ).groupBy("dig").agg(F.sum("s").alias("saved_tokens"), F.sum("l").alias("n_leaves"))
    ends = ends_digests(rows)
    return linked.join(sums, "dig").join(ends, "dig", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "slot", "parent_slot")
