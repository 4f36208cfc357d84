"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins at quantiles of the training rows. Boosting goes
round the features in turn; each step fits a tree of a few leaves over the bins of one feature
(later, of one pair of features) and adds it to that feature's table. A score is the sum of one
table entry per feature and per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import free_name, ready
from tallytide.llm.words import SPACED, hash_words, text_bytes

FEATURES = ["words", "distinct", "repeats", "trigrams", "upper", "digits", "stops", "marks", "lines", "length", "wide"]
TRAIN_ROWS = 20_000  # labelled texts the model is fitted on, at most
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 4, 120, 40, 0.2
THRESHOLD = 0.7


def _byte_classes() -> np.ndarray:
    """Byte -> class: 0 other, 1 A-Z, 2 digit, 3 one of . , 4 other ASCII mark, 5 line end, 6 beyond ASCII, 7 a-z."""
    out = np.zeros(256, np.uint8)
    out[0x21:0x7F] = 4
    out[0x41:0x5B], out[0x61:0x7B], out[0x30:0x3A], out[[0x2E, 0x2C]], out[0x0A], out[0x80:] = 1, 7, 2, 3, 5, 6
    return out


_CLASSES = _byte_classes()


def text_features(column: pa.Array) -> np.ndarray:
    """(rows, features) of a batch of texts; NULL counts as empty."""
    data, offsets = text_bytes(column)
    hashes, ends = hash_words(column, SPACED)
    rows = len(offsets) - 1
    out = np.zeros((rows, len(FEATURES)))
    tri = hashes[:-2] * hashes.dtype.type(3) + hashes[1:-1] * hashes.dtype.type(5) + hashes[2:] if len(hashes) > 2 else hashes[:0]
    for i in range(rows):
        a, b, c, d = offsets[i], offsets[i + 1], ends[i], ends[i + 1]
        n, words = max(int(b - a), 1), hashes[c:d]
        seen = np.bincount(_CLASSES[data[a:b]], minlength=8) / n
        m = len(words)
        letters = max(seen[1] + seen[7], 1e-9)
        grams = tri[c : d - 2] if m > 2 else hashes[:0]
        out[i] = (
            np.log1p(m), len(np.unique(words)) / m if m else 0.0,
            float((words[1:] == words[:-1]).mean()) if m > 1 else 0.0,
            len(np.unique(grams)) / len(grams) if len(grams) else 1.0,
            seen[1] / letters, seen[2], seen[3], seen[4], seen[5], (b - a) / m if m else 0.0, seen[6])
    return out


@dataclass(frozen=True)
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (edge, values) in enumerate(zip(self.edges, self.tables)):
            z += values[np.searchsorted(edge, x[:, f], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.pair_edges)]
            for (f, g), values in zip(self.pairs, self.pair_tables):
                z += values[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, place) of the best cut of a row of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Values over the bins of one feature: the best cut again and again until there are ``leaves`` leaves."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        options = [(*_cut(g[a:b], h[a:b]), a, b) for a, b in parts if b - a > 1]
        gain, place, a, b = max(options, default=(0.0, 0, 0, 0))
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + place), (a + place, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree over a pair: one cut of each feature, four leaves."""
    G = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    H = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best, values = 0.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            quads = [(s, t) for s in (slice(0, i), slice(i, None)) for t in (slice(0, j), slice(j, None))]
            gs = np.array([G[i, j], G[i, -1] - G[i, j], G[-1, j] - G[i, j], G[-1, -1] - G[i, -1] - G[-1, j] + G[i, j]])
            hs = np.array([H[i, j], H[i, -1] - H[i, j], H[-1, j] - H[i, j], H[-1, -1] - H[i, -1] - H[-1, j] + H[i, j]])
            gain = float((gs**2 / (hs + 1)).sum())
            if gain > best:
                best, values = gain, np.zeros_like(g)
                for (s, t), a, b in zip(quads, gs, hs):
                    values[s, t] = _leaf(a, b)
    return best, values


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting on at most TRAIN_ROWS rows; without rows every score is 1: nothing is known against a text."""
    if not len(y):
        return AdditiveModel(40.0, [np.empty(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [], [], [])
    start = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    intercept = float(np.log(start / (1 - start)))
    width = x.shape[1]
    edges = [_edges(x[:, f], BINS) for f in range(width)]
    codes = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(y), intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            g, h = slope()
            step = RATE * _tree(np.bincount(codes[f], g, len(tables[f])), np.bincount(codes[f], h, len(tables[f])))
            tables[f] += step
            z += step[codes[f]]
    coarse_edges = [_edges(x[:, f], PAIR_BINS) for f in range(width)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse_edges)]

    def grid(f: int, g: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse_edges[f]) + 1, len(coarse_edges[g]) + 1)
        return np.bincount(coarse[f] * shape[1] + coarse[g], values, shape[0] * shape[1]).reshape(shape)

    g, h = slope()
    gains = sorted(((_quarters(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    pairs = [(a, b) for gain, a, b in gains[:PAIRS] if gain > 1e-6]
    pair_tables = [np.zeros_like(grid(a, b, g)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            g, h = slope()
            step = RATE * _quarters(grid(a, b, g), grid(a, b, h))[1]
            pair_tables[k] += step
            z += step[coarse[a], coarse[b]]
    return AdditiveModel(intercept, edges, tables, pairs, coarse_edges, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled texts that are not held out, chosen by a hash of the id.

    Labels of one id are averaged; NULL labels and ids are left out.
    """
    spark = ready(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y")).dropna()
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.avg("_y").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rows).collect()  # at most ``rows`` pairs
    if not chosen:
        return fit_additive(np.empty((0, len(FEATURES))), np.empty(0))
    ids = spark.createDataFrame([(r["_id"], r["_y"]) for r in chosen], known.schema)
    found = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(ids), "_id")
    schema = T.StructType([known.schema["_id"], T.StructField("_y", T.DoubleType()),
                           *[T.StructField(f, T.DoubleType()) for f in FEATURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *[pa.array(x[:, f]) for f in range(x.shape[1])]],
                names=["_id", "_y", *FEATURES])

    seen = found.select("_id", "_text", "_y").mapInArrow(run, schema)
    seen = seen.groupBy("_id").agg(*[F.avg(c).alias(c) for c in ("_y", *FEATURES)]).orderBy("_id").collect()
    x = np.array([[r[f] for f in FEATURES] for r in seen], float).reshape(-1, len(FEATURES))
    return fit_additive(x, np.array([float(r["_y"] >= 0.5) for r in seen]))


def score(docs: DataFrame, model: AdditiveModel, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score (0 to 1) to every row; NULL and empty texts are scored like any other."""
    kept = [f for f in docs.schema.fields if f.name != name]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            values = shared.value.score(text_features(columns[names.index(text)]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values)], names=[*names, name])

    ready(docs.sparkSession)
    work = docs.select(*[F.col(f"`{n}`") for n in names])
    return work.mapInArrow(run, T.StructType([*kept, T.StructField(name, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the classifier takes, with their columns unchanged."""
    name = free_name(docs.columns, "_score")
    return score(docs, train(docs, labels, doc_id, text), text, name).filter(F.col(name) >= THRESHOLD).drop(name)
