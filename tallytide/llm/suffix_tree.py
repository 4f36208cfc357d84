"""Language-model scoring with a probabilistic suffix tree (variable-length contexts).

Tokens are the words of a text (A-Z lower-cased, ``SPACED_WORDS``) and one end
token. A context is up to ``depth`` previous tokens of the same text.

Training (documents not held out):

* counts ``c(s, w)`` of every context ``s`` of length 0..depth and next token ``w``;
* the root (empty context) is the add-half unigram
  ``P0(w) = (c + 0.5) / (N + 0.5 (V + 1))`` (``N`` tokens, ``V`` distinct, one more
  share for unknown tokens);
* a context ``s = a s'`` of length ``k`` is kept when its parent suffix ``s'`` is
  kept, ``c(s) >= min_count`` and the divergence test holds:
  ``sum_w c(s, w) ln(P(w|s) / P(w|s')) >= divergence`` (maximum-likelihood
  estimates, nats); kept contexts are closed under suffixes;
* next-token distributions are smoothed toward the parent (Witten-Bell):
  ``P(w|s) = (c(s, w) + u(s) P(w|s')) / (c(s) + u(s))``, ``u(s) = beta x`` the
  number of distinct tokens seen after ``s``.

Scoring takes, at each position, the longest kept suffix of the preceding tokens.
The smoothed log-probability of a token unseen after a context is its parent's, backed off, so a position takes
``log P(w|s)`` of its longest kept suffix, seen or not, and a text's score is one grouped sum.

All suffixes of a context end in the same token, the one before the position. So a task that holds all positions (training
or not) behind some tokens counts, tests, smooths and scores their contexts of every length, and needs nothing of other
tasks but the count of each token, which is joined once per block of texts. Positions are dealt by that token in rounds;
the shuffle files of a round make room for the next. ``ROUNDS`` bounds their number, as each reads all tokens.

Contexts of more than ``limit`` positions are hot: their positions are dealt by the next longer context (the longest by
row), so that no task gets a hot context whole. Their pair counts come from an aggregate over all tasks, and each task is
sent those of the pairs it holds; totals and tests of hot contexts, one row each, are told to all.

Tokens are keyed by 64-bit hashes (``words.hash_words``), contexts by a chain of their tokens' hashes; at 10^9 distinct
contexts a collision is expected about once in 40 runs, and it merges two contexts.

Defined results: a NULL text has no words (one token, the end); a NULL
``doc_id`` is held out (never learned from); repeated rows each get a row;
empty training data gives ``N = V = 0`` (every token has probability 1 by the
formula). More than ``depth`` is never read back: contexts are whole within a text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready
from tallytide.llm.words import SPACED, U, hash_words, mix
from tallytide.scale import shared_folder

DEPTH = 3  # longest context, in tokens
MIN_COUNT = 3  # least count of a kept context
DIVERGENCE = 2.0  # least count-weighted divergence (nats) of a kept context from its parent
BETA = 1.0  # weight of the parent distribution in smoothing, per distinct follower
FOLD, HELD = 5, 1  # held out: crc32(doc_id as text) % FOLD == HELD
END = U(0x5851F42D4C957F2D)  # stands for the end token
ROUNDS, ROUND_TOKENS = 6, 7_000_000  # rounds at most; training tokens worth a round of their own
PART_POSITIONS, BATCH = 1_200_000, "8"  # positions dealt to a part; rows of an Arrow batch, most of them packed
HOT_SHARE, HOT_LEAST, HOT_MOST = 100, 10_000, 1_000_000  # a context is hot above this share of the tokens, within bounds
_CHAIN = U(0xC2B2AE3D27D4EB4F)
with np.errstate(over="ignore"):
    END_CHAIN = END * _CHAIN
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when their query has ended


def saved(df: DataFrame, path: str | None = None) -> DataFrame:
    """Written as compressed Parquet to the shared folder and read back: cuts lineage, outlives executors, and
    keeps token arrays and counts small on disk (a checkpoint writes rows uncompressed). A given path is overwritten."""
    path = path or f"{shared_folder(df.sparkSession)}/tallytide-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.dictionary.page.size", 8 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLD)) == HELD, F.lit(True))


def _packed(values: np.ndarray, edges: Sequence[int]) -> pa.Array:
    """A binary value for each part of the values between two edges."""
    offsets = (np.asarray(edges, np.int64) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all rows, end to end."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty(0, kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    if offsets[0] == offsets[-1]:
        return np.empty(0, kind)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(kind)


def _listed(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per block of texts (those hashed at once): ``_block`` and lists ``_row``, ``doc_id``, ``held_out``, ``sizes`` (tokens of
    each text, its end token included), ``words`` (hashes of the distinct tokens) and ``codes`` (index into them of each token), both
    packed; saved, so row numbers are stable."""
    ready(docs.sparkSession)
    work = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"))
    schema = T.StructType([*_long("_block"), *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in work.schema.fields[:3]],
                           *_longs("sizes"), *_binary("words", "codes")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                hashes, offsets = hash_words(batch.column(3), SPACED)
                words, codes = _groups(np.insert(hashes, offsets[1:], END))
                whole = pa.array([0, len(batch)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[:1], *[pa.ListArray.from_arrays(whole, x) for x in (*batch.columns[:3], pa.array(np.diff(offsets) + 1))],
                     _packed(words, [0, len(words)]), _packed(codes.astype(np.int32), [0, len(codes)])], names=schema.names)

    return saved(work.mapInArrow(run, schema), path)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block (columns _row, sizes, words, codes): row, size and words; and of every token its code and its place in its text."""
    for i in range(len(batch)):
        sizes = _listed(batch.column(1), i)
        words, codes = _unpacked(batch.column(2).slice(i, 1), U), _unpacked(batch.column(3).slice(i, 1), np.int32)
        yield _listed(batch.column(0), i), sizes, words, codes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into the sorted values, whether it is there) of each wanted one."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def events(toks: DataFrame, levels: Sequence[int], shard: int = 0, shards: int = 1, within: np.ndarray | None = None) -> DataFrame:
    """One row per (position, context length j of ``levels``): ``_row``, ``j``, ``ctx`` and ``parent`` (hashes), ``w`` (hash).

    Only positions of the shard: those whose previous token falls into it, for j = 0 those whose own token does;
    ``within`` (sorted): only contexts whose parents are in it.
    """
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("j", T.IntegerType()),
                           *[T.StructField(n, T.LongType()) for n in ("ctx", "parent", "w")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sizes, words, codes, place in _texts(batch):
                yield from block(words[codes], place, np.repeat(rows, sizes))

    def block(flat: np.ndarray, place: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in (True, False):  # the root, then the deeper levels, which share their positions
            at = np.arange(len(flat)) if first else np.flatnonzero(place > 0)
            at = at[flat[at if first else at - 1].view(np.int64) % shards == shard]
            ctx = np.full(len(at), END)
            for j in (0,) if first else range(1, max(levels) + 1):
                parent = ctx
                if j:
                    enough = place[at] >= j
                    at, parent = at[enough], ctx[enough]
                    ctx = mix(parent * _CHAIN + flat[at - j])
                if j in levels and len(at):
                    own = slice(None) if within is None else _find(within, parent)[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row[at[own]]), pa.array(np.full(len(at[own]), j, np.int32)),
                         *[pa.array(c.view(np.int64)) for c in (ctx[own], parent[own], flat[at[own]])]],
                        names=["_row", "j", "ctx", "parent", "w"])

    return toks.select("_row", "sizes", "words", "codes").mapInArrow(run, schema)


def _chain(flat: np.ndarray, at: np.ndarray, place: np.ndarray, depth: int) -> list[np.ndarray]:
    """The contexts of length 1..depth of positions behind a token; those that reach out of the text are the last whole one."""
    chain, ctx = [], np.full(len(at), END)
    for k in range(1, depth + 1):
        longer = mix(ctx * _CHAIN + flat[np.maximum(at - k, 0)])
        ctx = longer if k == 1 else np.where(place[at] >= k, longer, ctx)
        chain.append(ctx)
    return chain


def _keys(chain: list[np.ndarray], place: np.ndarray, row: np.ndarray, hot: Sequence[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(what positions are dealt by, their hot contexts): the previous token, or parts of the longest hot context."""
    key, deep = chain[0].copy(), np.zeros(len(row), np.int64)
    for k, level in enumerate(hot, 1):
        i, found = _find(level["ctx"], chain[k - 1])
        at = np.flatnonzero(found & (place >= k) & (deep == k - 1))
        deeper = mix(row[at].view(U) + END)
        if k < len(chain):
            deeper = np.where(place[at] > k, chain[k][at], deeper)
        key[at] = mix(chain[k - 1][at] * _CHAIN + deeper % level["parts"][i[at]])
        deep[at] = k
    return key, deep


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, index of each value among them); no stable sort, as ``np.unique`` takes with indices."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    index = np.empty(len(values), np.int64)
    index[order] = np.cumsum(new) - 1
    return ranked[new], index


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.ArrayType(T.LongType())) for n in names]


def _binary(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.BinaryType()) for n in names]


def train_root(toks: DataFrame, folder: str | None = None, hot_least: int = HOT_LEAST) -> tuple[DataFrame, dict]:
    """The empty context: the number ``n`` of training tokens, ``v`` of distinct ones and ``a`` of all tokens, ``large`` (tokens
    that occur more than ``hot_least`` times); and the texts with ``c``, counts of ``words``, packed, and lists ``n_known``, ``base`` and
    ``x``, the log10 probability of the first token.

    A row is the distinct words of a block that fall into one part: parts sum the counts, blocks get them back.
    """
    schema = T.StructType([*_long("_block", "part"), *_binary("w", "m", "a")])
    parts = max(16, toks.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, sizes, w, codes, _) in enumerate(_texts(batch)):
                learnt = np.repeat(~_listed(batch.column(4), i).astype(bool), sizes)
                m = np.bincount(codes, learnt, minlength=len(w)).astype(np.int64)
                part = (w % U(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                found, first = np.unique(part[order], return_index=True)
                edges = np.append(first, len(w))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), batch.column(5)[i].as_py())), pa.array(found),
                     *[_packed(x[order], edges) for x in (w, m, np.bincount(codes, minlength=len(w)))]], names=schema.names)

    def total(rows: pa.Table) -> pa.Table:
        w, m, a = [_unpacked(rows[x], np.int64) for x in ("w", "m", "a")]
        sizes = np.array([len(x.as_buffer()) // 8 for x in rows["w"]])
        words, i = _groups(w)
        c = np.bincount(i, m, minlength=len(words)).astype(np.int64)
        every = np.bincount(i, a, minlength=len(words)).astype(np.int64)
        edges = np.append(0, np.cumsum(sizes))
        own = [rows["_block"].combine_chunks(), _packed(w, edges), _packed(c[i], edges)]
        whole = [pa.nulls(1, pa.int64()), *[_packed(x, [0, len(words)]) for x in (words, c)]]
        top = np.flatnonzero(every > hot_least)
        zeros = pa.array(np.zeros(len(sizes), np.int64))
        return pa.table([
            *[pa.concat_arrays([x, y]) for x, y in zip(own, whole, strict=True)],
            *[pa.concat_arrays([zeros, pa.array([int(x)])]) for x in (c.sum(), (c > 0).sum(), every.sum())],
            *[pa.concat_arrays([pa.ListArray.from_arrays(pa.array(np.zeros(len(sizes) + 1), pa.int32()), pa.array(x[:0])),
                                pa.ListArray.from_arrays(pa.array([0, len(top)], pa.int32()), pa.array(x[top]))]) for x in (words, every)]],
            names=["_block", "words", "c", "n", "v", "a", "top", "top_a"])

    summed = saved(
        toks.select("_row", "sizes", "words", "codes", "held_out", "_block").mapInArrow(run, schema).groupBy("part").applyInArrow(
            total, T.StructType([*_long("_block"), *_binary("words", "c"), *_long("n", "v", "a"), *_longs("top", "top_a")])),
        folder and f"{folder}/counts")
    found = summed.agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("a").alias("a")).first()
    large = summed.filter("_block IS NULL").select(F.inline(F.arrays_zip(F.col("top").alias("w"), F.col("top_a").alias("a"))))
    n, v = int(found["n"] or 0), int(found["v"] or 0)
    denominator = n + 0.5 * (v + 1)
    schema = T.StructType([*toks.schema.fields, *_binary("c"), *_longs("n_known"), T.StructField("base", T.ArrayType(T.DoubleType())),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])

    def attach(texts: pa.Table, known: pa.Table) -> pa.Table:
        batch = texts.select(["_row", "sizes", "words", "codes"]).combine_chunks().to_batches()[0]
        (_, sizes, words, codes, place), = _texts(batch)
        order = np.argsort(_unpacked(known["words"], U))  # the block's words, each once, as ``words``
        c = _unpacked(known["c"], np.int64)[order]
        x = np.log10((c + 0.5) / denominator)[codes]
        start = np.cumsum(sizes) - sizes
        whole = pa.array([0, len(sizes)], pa.int32())
        lists = [pa.ListArray.from_arrays(whole, pa.array(y)) for y in (
            np.add.reduceat((c > 0)[codes].astype(np.int64), start), np.add.reduceat(x, start), x[start])]
        return pa.table([*texts.columns, _packed(c, [0, len(c)]), *lists], names=schema.names)

    known = summed.filter("_block IS NOT NULL").select("_block", "words", "c")
    texts = saved(toks.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(attach, schema))
    return texts, {"large": large, "n": n, "v": v, "a": int(found["a"] or 0), "denominator": denominator}


def positions(texts: DataFrame, depth: int, hot: Sequence[dict], parts: int, shard: int = 0, shards: int = 1) -> DataFrame:
    """The positions behind a token that fall into parts of the shard (part % shards), one row per block of texts and part: ``part``
    and, packed, ``_row``, ``w``, ``c1`` .. (contexts), ``c`` (of w in training), ``tag`` (the number of a position's contexts, plus
    depth + 1 if it is learnt from)."""
    names = ["_row", "w", *[f"c{k}" for k in range(1, depth + 1)], "c", "tag"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, place, row, learnt, flat, counts in _behind(batches):
            c1 = mix(END_CHAIN + flat[at - 1])
            some = (c1 % U(parts)) % U(shards) == shard
            if hot:
                some |= _find(hot[0]["ctx"], c1)[1]
            at = at[some]
            chain = _chain(flat, at, place, depth)
            part = _keys(chain, place[at], row[at], hot)[0] % U(parts)
            own = np.flatnonzero(part % U(shards) == shard)
            if not len(own):
                continue
            own = own[np.argsort(part[own], kind="stable")]  # a text's positions stay together
            at, part = at[own], part[own].astype(np.int64)
            found, first = np.unique(part, return_index=True)
            edges = np.append(first, len(part))
            tag = np.minimum(place[at], depth) + (depth + 1) * learnt[at]
            yield pa.RecordBatch.from_arrays([pa.array(found), *[_packed(x, edges) for x in (
                row[at], flat[at], *[c[own] for c in chain], counts[at], tag)]], names=["part", *names])

    return texts.select("_row", "sizes", "words", "codes", "held_out", "c").mapInArrow(run, T.StructType([*_long("part"), *_binary(*names)]))


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block: the tokens behind another one, and of every token its place, row, whether it is learnt from, itself and its count."""
    for batch in batches:
        for i, (rows, sizes, words, codes, place) in enumerate(_texts(batch)):
            learnt = np.repeat(~_listed(batch.column(4), i).astype(bool), sizes)
            yield (np.flatnonzero(place > 0), place, np.repeat(rows, sizes), learnt, words[codes],
                   _unpacked(batch.column(5).slice(i, 1), np.int64)[codes])


def hot_pairs(texts: DataFrame, depth: int, hot: Sequence[dict], k: int, parts: int) -> DataFrame:
    """``part``, ``ctx``, ``parent``, ``w``, ``m`` and ``c_p`` (counts of the pair in a batch, of w): pairs of the hot contexts of length k."""
    schema = T.StructType(_long("part", "ctx", "parent", "w", "m", "c_p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, place, row, learnt, flat, counts in _behind(batches):
            at = at[_find(hot[0]["ctx"], mix(END_CHAIN + flat[at - 1]))[1]]
            chain = _chain(flat, at, place, depth)
            own = np.flatnonzero(_find(hot[k - 1]["ctx"], chain[k - 1])[1] & (place[at] >= k))
            part = _keys(chain, place[at], row[at], hot)[0][own] % U(parts)
            ctx, parent, at = chain[k - 1][own], chain[max(k - 2, 0)][own], at[own]
            pairs, i = _groups(mix(mix(ctx * _CHAIN + flat[at]) * _CHAIN + part))
            one = np.empty(len(pairs), np.int64)
            one[i] = np.arange(len(i))
            m = np.bincount(i, learnt[at], minlength=len(pairs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                *[y[one].view(np.int64) for y in (part, ctx, parent, flat[at])], m, counts[at][one])], names=schema.names)

    return texts.select("_row", "sizes", "words", "codes", "held_out", "c").mapInArrow(run, schema)


def train_hot(texts: DataFrame, root: dict, depth: int, min_count: int, divergence: float, beta: float,
              limit: int, parts: int) -> tuple[list[dict], DataFrame]:
    """Hot contexts of each length (sorted ``ctx``, ``parts`` to deal them to, ``cs``, ``u``, ``kept``; at most tokens / limit), and
    rows ``part``, ``k``, ``ctx``, ``w``, ``c``: the counts of their pairs, for each part that has positions of the pair."""
    spark, hot = texts.sparkSession, []
    sent = spark.createDataFrame([], "part long, k int, ctx long, w long, c long")
    for k in range(1, depth + 1):
        if k == 1:
            large = [(mix(np.full(1, END_CHAIN) + U(r["w"] % 2**64))[0], r["a"])
                     for r in root["large"].filter(F.col("a") > limit).collect()]
        else:
            large = [(U(r["ctx"] % 2**64), r["a"]) for r in events(texts, [k], within=hot[-1]["ctx"]).groupBy("ctx").agg(
                F.count(F.lit(1)).alias("a")).filter(F.col("a") > limit).collect()]
        if not large:
            break
        large.sort()
        hot.append({"ctx": np.array([x for x, _ in large], U), "parts": np.array([1 + 2 * a // limit for _, a in large], U)})
    for k, level in enumerate(hot, 1):
        listed = [int(x) for x in level["ctx"].view(np.int64)]
        needs = saved(hot_pairs(texts, depth, hot, k, parts).groupBy("part", "ctx", "parent", "w").agg(
            F.sum("m").alias("m"), F.first("c_p").alias("c_p")))
        pairs = needs.groupBy("ctx", "parent", "w").agg(F.sum("m").alias("c"), F.first("c_p").alias("c_p")).filter("c > 0")
        sums = pairs.groupBy("ctx").agg(F.sum("c").alias("cs"), (F.lit(beta) * F.count(F.lit(1))).alias("u"))
        pairs = saved(pairs.join(F.broadcast(sums), "ctx"))
        tested = pairs.withColumn("cs_p", F.lit(root["n"])) if k == 1 else pairs.drop("c_p").join(below, ["parent", "w"])  # noqa: F821
        gain = F.sum(F.col("c") * F.log((F.col("c") * F.col("cs_p")) / (F.col("cs") * F.col("c_p"))))
        found = {r["ctx"]: r for r in tested.groupBy("ctx").agg(
            F.first("cs").alias("cs"), F.first("u").alias("u"), gain.alias("g")).collect()}
        level["cs"] = np.array([found[x]["cs"] if x in found else 0 for x in listed], float)
        level["u"] = np.array([found[x]["u"] if x in found else 0 for x in listed], float)
        level["kept"] = np.array([x in found and found[x]["cs"] >= min_count and found[x]["g"] >= divergence for x in listed])
        below = pairs.select(F.col("ctx").alias("parent"), "w", F.col("c").alias("c_p"), F.col("cs").alias("cs_p"))
        rows = needs.join(pairs.select("ctx", "w", "c"), ["ctx", "w"])
        sent = sent.unionByName(rows.select("part", F.lit(k).alias("k"), "ctx", "w", "c"))
    return hot, saved(sent) if hot else sent


def score_shard(texts: DataFrame, root: dict, depth: int, min_count: int, divergence: float, beta: float, hot: Sequence[dict],
                sent: DataFrame, parts: int, shard: int = 0, shards: int = 1) -> DataFrame:
    """``_row``, ``x``: what positions of the shard add to the log10 probability of a text, one row per part and text.

    The contexts of a part are counted, tested and smoothed level by level; only positions whose context is kept go on.
    """
    schema = T.StructType([*_long("_row"), T.StructField("x", T.DoubleType())])
    n, denominator = root["n"], root["denominator"]

    def run(dealt: pa.Table, told: pa.Table) -> pa.Table:
        row, w, *chain, count, tag = [_unpacked(dealt[i], np.int64) for i in range(1, depth + 5)]
        told = told["told"].combine_chunks().flatten()
        w, told = w.view(U), [told.field(x).to_numpy() for x in ("k", "ctx", "w", "c")]
        place, learnt = tag % (depth + 1), (tag > depth).astype(float)
        x = np.log10((count + 0.5) / denominator)  # of the longest kept context so far, with its counts of the token and of all
        c_p, cs_p, at = count.astype(float), np.full(len(x), float(n)), np.arange(len(x))
        for k in range(1, depth + 1):
            at = at[place[at] >= k] if k > 1 else at
            ctx, ci = _groups(chain[k - 1].view(U)[at])
            weight, is_hot = learnt[at], np.zeros(len(ctx), bool)
            if k <= len(hot):
                level = hot[k - 1]
                i, is_hot = _find(level["ctx"], ctx)
                weight = weight * ~is_hot[ci]
            cs = np.bincount(ci, weight, minlength=len(ctx))
            enough = cs >= max(min_count, 1)
            if is_hot.any():
                cs[is_hot], enough[is_hot] = level["cs"][i[is_hot]], level["kept"][i[is_hot]]
            some = enough[ci]
            at, ci, weight = at[some], ci[some], weight[some]
            pairs, pi = _groups(mix(ctx[ci] * _CHAIN + w[at]))
            one, pc = np.empty(len(pairs), np.int64), np.empty(len(pairs), np.int64)
            one[pi], pc[pi] = at, ci  # a position of the pair, its context
            c = np.bincount(pi, weight, minlength=len(pairs))
            if is_hot.any():
                own = told[0] == k
                i_pair, known = _find(pairs, mix(told[1][own].view(U) * _CHAIN + told[2][own].view(U)))
                c[i_pair[known]] = told[3][own][known]
            seen = np.flatnonzero(c > 0)
            gain = c[seen] * np.log((c[seen] * cs_p[one[seen]]) / (cs[pc[seen]] * c_p[one[seen]]))
            u = beta * np.bincount(pc[seen], minlength=len(ctx))
            kept = np.bincount(pc[seen], gain, minlength=len(ctx)) >= divergence
            if is_hot.any():
                u[is_hot], kept[is_hot] = level["u"][i[is_hot]], level["kept"][i[is_hot]]
            pair = np.flatnonzero(kept[pc])
            new = np.full(len(pairs), np.nan)
            new[pair] = np.log10((c[pair] + u[pc[pair]] * 10.0 ** x[one[pair]]) / (cs[pc[pair]] + u[pc[pair]]))
            go = kept[ci]
            at, pi, ci = at[go], pi[go], ci[go]
            x[at], c_p[at], cs_p[at] = new[pi], c[pi], cs[ci]
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))  # positions of a text are together in a part
        return pa.table([pa.array(row[start]), pa.array(np.add.reduceat(x, start))], names=schema.names)

    sent = sent.filter(F.pmod("part", F.lit(shards)) == shard).groupBy("part").agg(
        F.collect_list(F.struct("k", "ctx", "w", "c")).alias("told"))
    both = positions(texts, depth, hot, parts, shard, shards).groupBy("part").cogroup(sent.groupBy("part"))
    return both.applyInArrow(lambda dealt, told: run(dealt, told) if len(dealt) else pa.table([[], []], schema=pa.schema(
        [("_row", pa.int64()), ("x", pa.float64())])), schema)


def lm_scores(docs: DataFrame, depth: int = DEPTH, rounds: int | None = None, min_count: int = MIN_COUNT,
              divergence: float = DIVERGENCE, beta: float = BETA, limit: int | None = None) -> DataFrame:
    """Train on the documents not held out and score all of them: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. ``rounds``: the number of shards; by default it follows the tokens, up to ``ROUNDS``. ``limit``:
    positions above which a context is hot."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tallytide-tables/{uuid.uuid4().hex}"
    ready(spark)
    before, rows = spark.conf.get(_RELEASE, "false"), spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_RELEASE, "true")
    try:
        toks = tokens(docs, f"{folder}/tokens")
        spark.conf.set(_BATCH_ROWS, BATCH)
        texts, root = train_root(toks, folder, limit or HOT_LEAST)
        saved(spark.createDataFrame([], toks.schema), f"{folder}/tokens")  # the texts hold them now
        rounds = rounds or min(ROUNDS, 1 + root["n"] // ROUND_TOKENS)
        limit = limit or min(HOT_MOST, max(HOT_LEAST, root["a"] // HOT_SHARE))
        each = texts.select(F.inline(F.arrays_zip("_row", "doc_id", "held_out", F.col("sizes").alias("n_tokens"), "n_known", "base", "x")))
        parts = [each.select("_row", "x")]
        if depth:
            test = (depth, min_count, divergence, beta)
            dealt = rounds * max(2 * spark.sparkContext.defaultParallelism, -(-root["a"] // (rounds * PART_POSITIONS)))
            hot, sent = train_hot(texts, root, *test, limit, dealt)
            parts += [saved(score_shard(texts, root, *test, hot, sent, dealt, r, rounds)) for r in range(rounds)]
    finally:
        spark.conf.set(_RELEASE, before)
        spark.conf.set(_BATCH_ROWS, rows)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    per_row = every.groupBy("_row").agg(F.sum("x").alias("score"))
    return each.join(per_row, "_row").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(root["n"]).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score")
