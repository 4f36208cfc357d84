"""MinHash near-duplicates by a chosen-path set similarity join.

Each text becomes the set of its word 5-grams and a signature of minwise tokens. Equal sets are
one vertex from here on. The vertices are branched down several independent trees: the position
of the token to branch on is chosen by the node, one and sometimes two per node, so that a pair
at the threshold is expected to stay together once per level. Nodes that have become small are
compared exhaustively by signature. A large node of the first level in which nearly all signatures
are close to that of one member has nothing left to separate: it is kept together and branched no
further, as are the nodes that stay large after the last level. What hangs together that way is a
cluster of candidates.

Clusters are then confirmed on full sets. A cluster is cut into blocks of bounded size; the
first block is compared with all blocks, which connects nearly everything that is connected,
and whatever is not in the largest component so far is compared with the whole cluster. Pairs
that are known to be connected are not compared again, so that no link between components is
lost and no group is expanded into all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import components, ready, saved
from tallytide.llm.words import SPACED, U, digest_pair, hash_words, mix, shingle_sets
from tallytide.scale import BROADCAST_BYTES, bound, small_or_shuffled

SHINGLE, PERCENT = 5, 85
TOKENS, TREES, LEVELS = 64, 8, 4
SMALL_NODE, BLOCK_ROWS, BLOCK_SHINGLES, SLICE = 32, 64, 1 << 20, 1 << 14
PIVOTS, SETTLED = 4, 95  # percent of the rows of a large node that may have a common neighbour with a pivot
_KEY = ("k1", "k2")
_LINK = "a1 long, a2 long, b1 long, b2 long"
_SEEDS = mix(np.arange(1, TOKENS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | U(1)


def _signature(values: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> bytes:
    out = np.empty(len(seeds), np.uint32)
    for j in range(len(seeds)):
        out[j] = ((values ^ seeds[j]) * factors[j]).min() >> U(20)
    return out.tobytes()


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, k1, k2, sig) of every text: set size, 128-bit digest of the set, minwise tokens (NULL if empty)."""
    ready(docs.sparkSession)
    work = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = work.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()),
                           T.StructField("k2", T.LongType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(*hash_words(batch.column(1), SPACED), SHINGLE)
            keys = [digest_pair(s) for s in sets]
            sig = [_signature(s, _SEEDS, _FACTORS) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64()), pa.array(sig, pa.binary())],
                names=["id", "n", "k1", "k2", "sig"])

    return work.mapInArrow(run, schema)


# --- trees --------------------------------------------------------------------------------


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), TOKENS)


def _children(node: np.ndarray, tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node): one child for each row and, with the rate that keeps a pair at the threshold, a second."""
    chance = int(10_000 * (100 / percent - 1))
    rows, out = [], []
    every = np.arange(len(node))
    for turn, live in enumerate((every, every[mix(node + U(77)) % U(10_000) < chance])):
        position = (mix(node[live] + U(1 + turn)) % U(TOKENS)).astype(np.int64)
        token = tokens[live, position].astype(U)
        out.append(mix(node[live] * U(0x9E3779B97F4A7C15) + token * U(TOKENS) + position.astype(U) + U(turn)))
        rows.append(live)
    return np.concatenate(rows), np.concatenate(out)


def _branch(frame: DataFrame, percent: int, trees: int) -> DataFrame:
    """(node, k1, k2) one level further down; rows without a node start at the root of every tree."""
    started = "node" in frame.columns
    work = frame.select(*(["node"] if started else []), *_KEY, "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift = int(started)
            k1, k2 = batch.column(shift), batch.column(shift + 1)
            tokens = _tokens(batch.column(shift + 2)) if len(batch) else np.empty((0, TOKENS), np.uint32)
            if started:
                starts = [batch.column(0).to_numpy(zero_copy_only=False).view(U)]
            else:
                starts = [np.full(len(batch), mix(np.array([tree + 1], U))[0], U) for tree in range(trees)]
            for node in starts:
                rows, child = _children(node, tokens, percent)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), k1.take(take), k2.take(take)],
                                                 names=["node", *_KEY])

    return work.mapInArrow(run, "node long, k1 long, k2 long")


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.find(int(x)) for x in rows], np.int64)

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[b] = a
        return a != b


def _links(pairs: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pairs)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a1", "a2", "b1", "b2"])


def _least(percent: int) -> int:
    """Tokens that the signatures of a pair at the threshold agree in, at least (4.5 standard deviations below the mean)."""
    return int((percent / 100 - 4.5 * math.sqrt(percent * (100 - percent)) / 100 / math.sqrt(TOKENS)) * TOKENS)


def _alike(nodes: DataFrame, percent: int) -> DataFrame:
    """Links within small nodes between members whose signatures and sizes allow the threshold."""
    least = _least(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for members in batch.column(0).to_pylist():
                tokens = np.frombuffer(b"".join(m["sig"] for m in members), np.uint32).reshape(-1, TOKENS)
                n = np.array([m["n"] for m in members])
                agree = (tokens[:, None, :] == tokens[None, :, :]).sum(2)
                fits = np.minimum.outer(n, n) * 100 >= np.maximum.outer(n, n) * percent
                forest = _Forest(len(members))
                for x, y in np.argwhere(np.triu((agree >= least) & fits, 1)).tolist():
                    if forest.join(x, y):
                        pairs.append((members[x]["k1"], members[x]["k2"], members[y]["k1"], members[y]["k2"]))
            yield _links(pairs)

    return nodes.mapInArrow(run, _LINK)


def _settled(large: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """The nodes of which ``SETTLED`` percent of the rows could have a common neighbour with one of four of them.

    Two texts with a common neighbour have a similarity of at least 2 ``percent`` - 100. The four are the ends of the
    node in the order of its digests, read either way.
    """
    least = max(_least(2 * percent - 100), TOKENS // 4)
    rows = large.join(vertices, [*_KEY]).select("node", *_KEY, "sig")
    one, turned = F.struct(*_KEY, "sig"), F.struct(*_KEY[::-1], "sig")
    ends = rows.groupBy("node").agg(F.concat(
        *[f(order)["sig"] for order in (one, turned) for f in (F.min, F.max)]).alias("pivots"))
    met = rows.select("node", "sig").join(ends, "node").select("node", "sig", "pivots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            node, where = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            others = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(len(batch), PIVOTS, TOKENS)
            agree = (_tokens(batch.column(1))[:, None, :] == others).sum(2) >= least
            alike = [np.bincount(where, agree[:, i]).astype(np.int64) for i in range(PIVOTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(np.bincount(where)), *[pa.array(x) for x in alike]], names=["node", "rows", *names])

    names = [f"a{i}" for i in range(PIVOTS)]
    counted = met.mapInArrow(run, ", ".join(f"{c} long" for c in ("node", "rows", *names)))
    totals = counted.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("rows", *names)])
    return totals.filter(F.greatest(*names) * 100 >= F.col("rows") * SETTLED).select("node")


def _stars(large: DataFrame) -> DataFrame:
    """Every row of a node linked with the smallest one."""
    first = large.groupBy("node").agg(F.min(F.struct(*_KEY)).alias("first"))
    return large.join(first, "node").select(
        F.col("first.k1").alias("a1"), F.col("first.k2").alias("a2"),
        F.col("k1").alias("b1"), F.col("k2").alias("b2"))


def candidate_links(vertices: DataFrame, percent: int = PERCENT, trees: int = TREES, levels: int = LEVELS) -> DataFrame:
    """Links whose components hold every pair at the threshold together, with the recall of the trees.

    ``vertices``: k1, k2, n, sig. Returns a1, a2, b1, b2.
    """
    rows, small, whole = _branch(vertices, percent, trees), None, None
    for level in range(levels):
        sizes = rows.groupBy("node").count().filter("count > 1")
        rows = saved(rows.join(sizes, "node"))
        done = rows.filter(F.col("count") <= SMALL_NODE).select("node", *_KEY)
        small = done if small is None else small.unionByName(done)
        large = rows.filter(F.col("count") > SMALL_NODE).select("node", *_KEY)
        if large.isEmpty():
            break
        if level == 0 and levels > 1:  # groups are whole here; what gets away from them is smaller further down
            settled = small_or_shuffled(saved(_settled(large, vertices, percent)))
            whole, large = large.join(settled, "node", "left_semi"), large.join(settled, "node", "left_anti")
        if level + 1 < levels:
            rows = _branch(large.join(vertices, [*_KEY]), percent, trees)
        else:
            whole = large if whole is None else whole.unionByName(large)
    members = F.collect_list(F.struct(*_KEY, "n", "sig")).alias("members")
    nodes = small.join(vertices, [*_KEY]).groupBy("node").agg(members)
    out = _alike(nodes.select("members"), percent)
    if whole is not None:
        out = out.unionByName(_stars(whole))
    return out.filter("a1 <> b1 or a2 <> b2").distinct()


# --- confirmation -------------------------------------------------------------------------


def _common(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first ``split`` sets with all the others, by products of bit matrices."""
    n = [len(x) for x in sets]
    _, value, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = times[value] > 1
    value, owner = np.unique(value[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    out = np.zeros((split, len(sets)), np.float64)
    for low in range(0, int(value[-1]) + 1 if len(value) else 0, SLICE):
        a, b = np.searchsorted(value, [low, low + SLICE])
        bits = np.zeros((len(sets), SLICE), np.float32)
        bits[owner[a:b], value[a:b] - low] = 1
        out += bits[:split] @ bits.T
    return out


def _compare(left: list[dict], right: list[dict] | None, percent: int) -> list[tuple]:
    """Links between two blocks, or within one, as few as connect what is connected."""
    members = left if right is None else [*left, *right]
    sets = [np.frombuffer(m["values"], U) for m in members]
    n = np.array([len(x) for x in sets])
    common = _common(sets, len(left))
    union = n[: len(left), None] + n[None, :] - common
    linked = 100 * common >= percent * union
    linked[:, : len(left)] = np.triu(linked[:, : len(left)], 1) if right is None else False
    forest, pairs = _Forest(len(members)), []
    for x, y in np.argwhere(linked).tolist():
        if forest.join(x, y):
            pairs.append((members[x]["k1"], members[x]["k2"], members[y]["k1"], members[y]["k2"]))
    return pairs


def _confirm(work: DataFrame, percent: int) -> DataFrame:
    """``work``: columns ``left`` and ``right`` of blocks; a NULL right compares the left with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                left, right = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                yield _links(_compare(left, right, percent))

    return work.select("left", "right").mapInArrow(run, _LINK)


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(k1, k2, values) of the wanted vertices, found again by the id of one of their texts."""
    ids = wanted.select(F.col("rep").alias("_rep")).distinct()
    if ids.count() * 24 <= bound(docs.sparkSession, BROADCAST_BYTES):
        ids = F.broadcast(ids)  # its size has just been counted
    work = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    work = work.join(ids, F.col("id").eqNullSafe(F.col("_rep")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(*hash_words(batch.column(0), SPACED), SHINGLE)
            keys = [digest_pair(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=[*_KEY, "values"])

    return work.mapInArrow(run, "k1 long, k2 long, values binary")


def _blocks(members: DataFrame) -> DataFrame:
    """(root, block, blocks, members): every cluster cut into blocks of bounded rows and shingles."""
    sizes = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        members.join(sizes, "root")
        .withColumn("block", F.pmod(F.xxhash64(*_KEY), F.col("blocks")))
        .repartition(parts, "root", "block")  # else a large cluster stays where the join put it
        .groupBy("root", "block")
        .agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct(*_KEY, "values")).alias("members"))
    )


def _meet(blocks: DataFrame, right: DataFrame) -> DataFrame:
    """Blocks next to the right-hand blocks of their cluster; the blocks of one cluster are dealt over many tasks."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = F.sequence(F.lit(0), F.ceil(F.col("blocks") / 4) - 1)
    sizes = blocks.groupBy("root").agg(F.first("blocks").alias("blocks"))
    dealt = right.join(sizes, "root").select("root", "right", F.explode(groups).alias("part"))
    left = blocks.select("root", F.col("members").alias("left"), F.floor(F.col("block") / 4).alias("part"))
    # a fixed number of partitions: the rows are few but each is much work
    return left.repartition(parts, "root", "part").join(dealt.repartition(parts, "root", "part"), ["root", "part"])


def confirmed_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links on full sets that connect each cluster exactly as its pairs at the threshold do.

    ``members``: root, k1, k2, n, values.
    """
    blocks = saved(_blocks(members))
    within = blocks.filter("block = 0 or blocks = 1").select(F.col("members").alias("left"), F.lit(None).cast(
        blocks.schema["members"].dataType).alias("right"))
    several = blocks.filter("blocks > 1")
    pivots = several.filter("block = 0").select("root", F.col("members").alias("right"))
    against = _meet(several.filter("block <> 0"), pivots)
    links = saved(_confirm(within.unionByName(against.select("left", "right")), percent))
    if several.isEmpty():
        return links
    inside = several.select("root", F.explode("members").alias("m")).select("root", "m.k1", "m.k2", "m.values")
    label = components(links, ("a1", "a2"), ("b1", "b2")).select(
        F.col("v.c0").alias("k1"), F.col("v.c1").alias("k2"), F.col("root").alias("label"))
    labelled = inside.join(label, [*_KEY], "left").withColumn(
        "label", F.coalesce("label", F.struct(F.col("k1").alias("c0"), F.col("k2").alias("c1"))))
    largest = (
        labelled.groupBy("root", "label").count().groupBy("root").agg(F.max(F.struct("count", "label")).alias("top"))
    )
    rest = labelled.join(largest, "root").filter(F.col("label") != F.col("top.label"))
    rest = saved(rest.select("root", *_KEY, (F.octet_length("values") / 8).cast("long").alias("n"), "values"))
    if rest.isEmpty():
        return links
    open_blocks = _blocks(rest).select("root", F.col("members").alias("right"))
    return links.unionByName(_confirm(_meet(several, open_blocks), percent)).filter("a1 <> b1 or a2 <> b2")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
    trees: int = TREES, levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if 100 times the size of the intersection of their shingle sets is at
    least ``percent`` times that of the union. ``component_id`` is the smallest id in the
    component, ``kept`` whether it is the row's own. A NULL or empty text, or one of spaces, has
    no shingles, is linked with nothing and is kept. NULL ids take part in links but are
    smaller than no id; a component of NULL ids alone has the id NULL. Rows with equal ids have
    equal verdicts if their texts are equal. Other columns of ``docs`` are not read.
    """
    signed = saved(signatures(docs, doc_id, text))
    vertices = saved(
        signed.filter("n > 0").groupBy(*_KEY).agg(
            F.min("id").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig")))
    shaped = vertices.select(*_KEY, "n", "sig")
    links = saved(candidate_links(shaped, percent, trees, levels))
    labels = vertices.select(*_KEY, F.col("rep").alias("component_id"))
    if not links.isEmpty():
        cluster = components(links, ("a1", "a2"), ("b1", "b2"))
        members = cluster.select(F.col("v.c0").alias("k1"), F.col("v.c1").alias("k2"), "root")
        members = saved(members.join(vertices.select(*_KEY, "n", "rep"), [*_KEY]))
        values = _sets(docs, doc_id, text, members)
        full = members.drop("rep").join(values, [*_KEY]).dropDuplicates([*_KEY])
        final = components(confirmed_links(full, percent), ("a1", "a2"), ("b1", "b2"))
        final = final.select(F.col("v.c0").alias("k1"), F.col("v.c1").alias("k2"), "root")
        named = vertices.select(*_KEY, "rep").join(final, [*_KEY], "left").withColumn(
            "root", F.coalesce("root", F.struct(F.col("k1").alias("c0"), F.col("k2").alias("c1"))))
        smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
        labels = named.join(smallest, "root").select(*_KEY, "component_id")
    out = signed.select("id", "n", *_KEY).join(labels, [*_KEY], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))
