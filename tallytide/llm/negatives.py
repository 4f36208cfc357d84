"""Hard-negative mining by a vertical (dimension-at-a-time) branch-and-bound scan.

For every anchor the rows of a partition are scored one block of dimensions at a
time, in the order of the anchor's largest magnitudes first. After each block the
part still unread is bounded from above and below by the column minima and maxima
of the partition, so a candidate whose best possible score cannot reach the
needed window leaves the candidate set before its remaining dimensions are read.
Survivors end with exact integer scores.

Two passes over the data, each a ``mapInPandas`` over the partitions as they are
read (no shuffle of the vectors):

1. positives: per anchor, the partition's best ``positives`` rows of the anchor's
   label; the partial lists are merged by a window over the anchor;
2. negatives: per (anchor, positive), the partition's first ``negatives`` rows of
   another label inside the window ``low * positive <= 100 * negative <= high *
   positive`` (percent); merged the same way.

Anchors reach the tasks as a broadcast of a block whose size is counted first; if
all anchors do not fit the broadcast bound, the work runs block after block, each
a full pass (the query set is fixed, the rows are all rows).

Defined results:

* rows with a NULL label, a NULL vector, or a NULL, NaN or infinite component
  take no part; an empty vector takes part and scores 0 with every row;
* vectors of different lengths are compared over their common leading positions
  (missing positions count as 0);
* a row never pairs with a row of its own ``vec_id``; repeated rows of one
  ``vec_id`` are each an anchor and a candidate, so their results repeat;
* ties of score go to the smaller ``vec_id``; a negative positive score leaves
  an empty window, a positive score of 0 admits negatives of score 0 only;
  anchors without positives give no rows;
* products are summed in 64-bit integers (components are ``floor(256 * x)``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import saved
from tallytide.scale import BROADCAST_BYTES, bound

ANCHOR_EVERY = 50  # anchors: vec_id divisible by this
RELABEL_EVERY = 7  # rows whose vec_id is divisible by this take label (label + 1) % LABELS
LABELS = 10
SCALE = 256  # components become floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # window of a negative score, in percent of the positive score
BLOCK_DIMS = 8  # dimensions read between two pruning steps
CHUNK_ROWS = 100_000  # rows of a partition scanned together (int64 matrix of CHUNK_ROWS x dimensions)

_CANDIDATE = T.StructType([
    T.StructField("anchor_key", T.LongType()), T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()),
    T.StructField("candidate_id", T.LongType()), T.StructField("score", T.LongType()),
])


def clean(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, the label after relabelling, and the integer vector ``v``; rows that take no part are gone."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(CAST(x AS DOUBLE) - CAST(x AS DOUBLE)))"
    return (
        embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
        .filter(F.expr(finite))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS)
            .otherwise(F.col("label")).cast("long").alias("label"),
            F.expr(f"transform(embedding, x -> CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT))").alias("v"),
        )
    )


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    lengths = {len(v) for v in vectors}
    if lengths == {width}:
        return np.stack([np.asarray(v, dtype=np.int64) for v in vectors]) if len(vectors) else np.zeros((0, width), np.int64)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        v = np.asarray(v, dtype=np.int64)[:width]
        out[i, : len(v)] = v
    return out


def _bond(q: np.ndarray, x: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores of the rows ``alive`` that ``keep(partial, low, high)`` does not drop on the way.

    ``q``: the anchor; ``x``: the partition's rows. Dimensions are read by falling
    ``|q|``; ``keep`` sees the partial score and the least and greatest rest.
    """
    order = np.argsort(-np.abs(q), kind="stable")
    lo_col, hi_col = x.min(axis=0) if len(x) else q * 0, x.max(axis=0) if len(x) else q * 0
    a, b = q * lo_col, q * hi_col
    rest_hi = np.concatenate([np.cumsum(np.maximum(a, b)[order][::-1])[::-1], [0]])
    rest_lo = np.concatenate([np.cumsum(np.minimum(a, b)[order][::-1])[::-1], [0]])
    partial = np.zeros(len(alive), dtype=np.int64)
    for start in range(0, len(order), BLOCK_DIMS):
        dims = order[start:start + BLOCK_DIMS]
        partial += x[np.ix_(alive, dims)] @ q[dims]
        end = min(start + BLOCK_DIMS, len(order))
        if end < len(order):
            mask = keep(partial, partial + rest_lo[end], partial + rest_hi[end])
            alive, partial = alive[mask], partial[mask]
            if not len(alive):
                break
    return alive, partial


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` by score falling, then id rising."""
    return np.lexsort((ids, -scores))[:n]


def _scan(anchors: dict, width: int, positives: int, negatives: int):
    """The per-partition scan of one pass; ``anchors`` holds ids, labels, vectors and, in pass 2, positives."""

    def chunks(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= CHUNK_ROWS:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if n:
            yield pd.concat(held, ignore_index=True)

    def run(batches):
        for frame in chunks(batches):
            found = scan(frame)
            if found is not None:
                yield found

    def scan(frame):
        ids = frame["vec_id"].to_numpy(np.int64)
        labels = frame["label"].to_numpy(np.int64)
        x = _matrix(frame["v"], width)
        out = []
        for key, a_id, a_label, q, pos in zip(
                anchors["key"], anchors["id"], anchors["label"], anchors["q"], anchors["pos"], strict=True):
            if pos is None:  # pass 1: best rows of the same label
                alive = np.flatnonzero((labels == a_label) & (ids != a_id))
                if not len(alive):
                    continue

                def keep(partial, low, high, k=positives):
                    if len(low) <= k:
                        return np.ones(len(low), bool)
                    cut = np.partition(low, len(low) - k)[len(low) - k]
                    return high >= cut

                alive, score = _bond(q, x, alive, keep)
                take = _first(ids[alive], score, positives)
                out += [(key, a_id, None, int(ids[alive[i]]), int(score[i])) for i in take]
            else:  # pass 2: rows of other labels inside some positive's window
                scores = np.array([s for _, s in pos], dtype=np.int64)
                lowest, highest = (LOW * scores).min(), (HIGH * scores).max()
                alive = np.flatnonzero((labels != a_label) & (ids != a_id))
                if not len(alive) or highest < lowest:
                    continue
                alive, score = _bond(
                    q, x, alive, lambda partial, low, high: (100 * high >= lowest) & (100 * low <= highest))
                for p_id, p_score in pos:
                    inside = (LOW * p_score <= 100 * score) & (100 * score <= HIGH * p_score)
                    hits = np.flatnonzero(inside)
                    for i in hits[_first(ids[alive[hits]], score[hits], negatives)]:
                        out.append((key, a_id, p_id, int(ids[alive[i]]), int(score[i])))
        if out:
            return pd.DataFrame(out, columns=["anchor_key", "anchor_id", "positive_id", "candidate_id", "score"]).astype(
                {"anchor_key": "int64", "anchor_id": "int64", "positive_id": "Int64", "candidate_id": "int64",
                 "score": "int64"})

    return run


def _blocks(anchors: DataFrame, width: int) -> list[list]:
    """Anchor rows in blocks that each fit the broadcast bound: (id, label, vector) lists, collected a block at a time."""
    per_row = 8 * (width + 8)
    size = max(1, bound(anchors.sparkSession, BROADCAST_BYTES) // per_row)
    n = anchors.count()
    if n == 0:
        return []
    parts = -(-n // size)
    numbered = anchors.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
    return [numbered.filter(F.col("_block") == b).drop("_block").collect() for b in range(parts)]


def mine(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score (see the module)."""
    spark = embeddings.sparkSession
    rows = saved(clean(embeddings))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    ctx = spark.sparkContext
    found_pos, found_neg = [], []
    for block in _blocks(anchors, width):
        first = ctx.broadcast({
            "key": list(range(len(block))), "id": [r.vec_id for r in block], "label": [r.label for r in block],
            "q": [_matrix([r.v], width)[0] for r in block], "pos": [None] * len(block)})
        near = rows.mapInPandas(_scan(first.value, width, positives, negatives), _CANDIDATE)
        # a repeated row is an anchor of its own: merges go by the anchor's place in the block
        by_anchor = Window.partitionBy("anchor_key").orderBy(F.col("score").desc(), "candidate_id")
        best = saved(
            near.withColumn("_r", F.row_number().over(by_anchor)).filter(F.col("_r") <= positives)
            .select("anchor_key", "anchor_id", F.col("candidate_id").alias("positive_id"),
                    F.col("score").alias("positive_score")))
        chosen = {}
        for r in best.collect():  # at most `positives` rows for each anchor of the block
            chosen.setdefault(r.anchor_key, []).append((r.positive_id, r.positive_score))
        keep = [i for i in range(len(block)) if i in chosen]
        second = ctx.broadcast({
            "key": keep, "id": [block[i].vec_id for i in keep], "label": [block[i].label for i in keep],
            "q": [first.value["q"][i] for i in keep], "pos": [chosen[i] for i in keep]})
        far = rows.mapInPandas(_scan(second.value, width, positives, negatives), _CANDIDATE)
        by_pair = Window.partitionBy("anchor_key", "positive_id").orderBy(F.col("score").desc(), "candidate_id")
        found_neg.append(
            far.withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= negatives)
            .select("anchor_key", "anchor_id", "positive_id", "rank", F.col("candidate_id").alias("negative_id"),
                    F.col("score").alias("negative_score")))
        found_pos.append(best)
    if not found_neg:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    negs, poss = found_neg[0], found_pos[0]
    for n, p in zip(found_neg[1:], found_pos[1:], strict=True):
        negs, poss = negs.unionByName(n), poss.unionByName(p)
    # a positive may repeat within an anchor (repeated rows): one row of it carries its score
    poss = poss.dropDuplicates(["anchor_key", "positive_id"])
    return negs.join(poss, ["anchor_key", "anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score")
