"""Spark's decision tree, grown to any depth in a number of passes that does not follow the depth.

Spark passes over all rows for every level, and sums dense counts of every open node, feature and
bin for each partition: a tree grown until its leaves are pure has about as many nodes as rows, so
its deep levels cost far more than the rows. Here

* the rows are binned once (by Spark's own thresholds) into blocks of bytes;
* nodes with more rows than ``ROWS_PER_TASK`` are split from counts summed over all blocks, one
  pass a level, as in Spark;
* every other node is finished where its rows are: the rows of a node meet in one task, which grows,
  prunes and numbers the whole subtree.

The nodes are the same as Spark's, number for number (same thresholds, impurities in the same order of
operations, first best split, leaves of one prediction merged), and are loaded as Spark's model.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.scale import reliable_checkpoint, shared_folder

ROWS_PER_TASK = 100_000  # a node of at most these rows is finished in one task
_CELLS = 2_000_000  # counts of one feature held at a time
_EPSILON = 2.0**-52  # Spark takes an impurity below it for 0
_BLOCKS = "n long, y binary, bins binary"
_PLACED = "bucket int, n long, root binary, y binary, bins binary"
_NODES = ("root int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
          "leftChild int, rightChild int, split struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>")


@dataclass(frozen=True)
class Rule:
    """When a node is split: Spark's parameters, with the threshold values of each feature."""

    thresholds: tuple[np.ndarray, ...]
    classes: int
    max_depth: int
    min_rows: int
    min_weight: float
    min_gain: float

    @property
    def sizes(self) -> list[int]:
        return [len(t) + 1 for t in self.thresholds]


class FullTreeClassifier(DecisionTreeClassifier):
    """Spark's classifier with the same parameters, model and nodes; see the module for how it grows.

    Weights, categorical features and impurities other than gini are left to Spark.
    """

    def _fit(self, dataset: DataFrame) -> DecisionTreeClassificationModel:
        label = self.getLabelCol()
        rule = _rule(self, dataset)
        if rule is None:
            return super()._fit(dataset)
        spark = dataset.sparkSession
        nodes = _grow(dataset.select(F.col(label).alias("y"), vector_to_array(self.getFeaturesCol()).alias("x")), rule)
        # a model of one row gives the folder its parameters; the nodes are put in their place
        empty = spark.createDataFrame([(0.0, Vectors.dense([0.0] * len(rule.thresholds)))], [label, self.getFeaturesCol()])
        empty = empty.withMetadata(label, dataset.schema[label].metadata)
        path = f"{shared_folder(spark)}/tallytide-trees/{uuid.uuid4().hex}"
        super()._fit(empty).write().save(path)
        nodes.write.mode("overwrite").parquet(f"{path}/data")
        return self._copyValues(DecisionTreeClassificationModel.load(path))


def _rule(tree: FullTreeClassifier, dataset: DataFrame) -> Rule | None:
    """The thresholds Spark finds for these rows, or None where the tree is left to Spark."""
    labels = dataset.schema[tree.getLabelCol()].metadata.get("ml_attr", {}).get("vals")
    if labels is None or tree.getImpurity() != "gini" or tree.isDefined(tree.weightCol):
        return None
    ml = dataset.sparkSession._jvm.org.apache.spark.ml
    if not _scala(ml.util, "MetadataUtils").getCategoricalFeatures(dataset._jdf.schema().apply(tree.getFeaturesCol())).isEmpty():
        return None
    tree._transfer_params_to_java()
    scala = dataset.sparkSession._jvm.scala
    strategy = tree._java_obj.getOldStrategy(scala.Predef.Map().empty(), len(labels))
    instances = _scala(ml.util, "DatasetUtils").extractInstances(tree._java_obj, dataset._jdf, scala.Option.apply(len(labels)))
    shape = _scala(ml.tree.impl, "DecisionTreeMetadata").buildMetadata(instances, strategy)
    found = _scala(ml.tree.impl, "RandomForest").findSplits(instances, shape, tree.getSeed())
    thresholds = tuple(np.array([s.threshold() for s in splits], dtype=float) for splits in found)
    return Rule(thresholds, len(labels), tree.getMaxDepth(), tree.getMinInstancesPerNode(),
                float(shape.minWeightPerNode()), tree.getMinInfoGain())


def _scala(package, name: str):
    """A Scala object."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


# --- splits -------------------------------------------------------------------------------


def gini(counts: np.ndarray) -> np.ndarray:
    """Impurity of each row of class counts; 0 without rows."""
    total = counts.sum(axis=-1)
    some = np.where(total > 0, total, 1.0)
    out = np.ones(total.shape)
    for c in range(counts.shape[-1]):
        share = counts[..., c] / some
        out -= share * share
    return np.where(total > 0, out, 0.0)


def best_splits(
    histogram: Callable[[int], np.ndarray], counts: np.ndarray, rule: Rule
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature, last bin of the left side and class counts of the left side of the best split of each node.

    ``histogram(f)``: (nodes x bins x classes) rows by bin of feature f. Without a valid split the gain is -inf.
    """
    nodes, total = np.arange(len(counts)), counts.sum(axis=1)[:, None]
    impurity = gini(counts)[:, None]
    gains, feature = np.full(len(counts), -np.inf), np.zeros(len(counts), np.int64)
    split, lefts = np.zeros(len(counts), np.int64), np.zeros_like(counts)
    for f, bins in enumerate(rule.sizes):
        if bins < 2:
            continue
        left = np.cumsum(histogram(f), axis=1)[:, :-1].astype(float)
        right = counts[:, None, :] - left
        n_left, n_right = left.sum(axis=2), right.sum(axis=2)
        gain = impurity - n_left / total * gini(left) - n_right / total * gini(right)
        fewest = np.minimum(n_left, n_right)
        gain[(fewest < rule.min_rows) | (fewest < rule.min_weight) | (gain < rule.min_gain)] = -np.inf
        at = gain.argmax(axis=1)
        better = gain[nodes, at] > gains
        gains[better], feature[better], split[better] = gain[nodes, at][better], f, at[better]
        lefts[better] = left[nodes, at][better]
    return gains, feature, split, lefts


def _children(gains, depth, counts, lefts, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which nodes are split, and the class counts and depth of their children, left before right."""
    inner = (gains > 0) & (depth < rule.max_depth)
    below = np.stack([lefts[inner], counts[inner] - lefts[inner]], axis=1).reshape(-1, counts.shape[1])
    return inner, below, np.repeat(depth[inner] + 1, 2)


def _open(counts: np.ndarray, depth: np.ndarray, rule: Rule) -> np.ndarray:
    """Children that may be split again."""
    return (gini(counts) >= _EPSILON) & (depth < rule.max_depth)


# --- subtrees of one task -----------------------------------------------------------------


@dataclass
class _Level:
    """Nodes of one level of some trees; ``child``: the left child in the next level, -1 in a leaf."""

    counts: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray


def _levels(bins: np.ndarray, y: np.ndarray, node: np.ndarray, roots: int, depth: np.ndarray, rule: Rule) -> list[_Level]:
    """The levels of the trees below ``roots`` open nodes; ``bins``: features x rows, ``node``: the root of each row."""
    counts = np.bincount(node * rule.classes + y, minlength=roots * rule.classes).reshape(roots, -1).astype(float)
    todo, found = np.ones(roots, bool), []
    step = max(1, _CELLS // (max(rule.sizes) * rule.classes))
    while len(counts):
        order = np.argsort(node, kind="stable")
        order = order[todo[node[order]]]
        bins, y, node = bins[:, order], y[order], node[order]
        level = _Level(counts, gini(counts), np.full(len(counts), -np.inf), *(np.zeros(len(counts), np.int64) for _ in range(3)))
        lefts = np.zeros_like(counts)
        at = np.flatnonzero(todo)
        for first in range(0, len(at), step):
            part = at[first : first + step]
            rows = slice(*np.searchsorted(node, [part[0], part[-1] + 1]))
            rank = np.searchsorted(part, node[rows])

            def histogram(f: int) -> np.ndarray:
                size = rule.sizes[f]
                cell = (rank * size + bins[f, rows]) * rule.classes + y[rows]
                return np.bincount(cell, minlength=len(part) * size * rule.classes).reshape(len(part), size, -1)

            level.gain[part], level.feature[part], level.split[part], lefts[part] = best_splits(histogram, counts[part], rule)
        level.impurity[todo & np.isneginf(level.gain)] = -1.0  # as Spark marks a leaf without a valid split
        inner, below, under = _children(level.gain, depth, counts, lefts, rule)
        level.child = np.where(inner, 2 * (np.cumsum(inner) - 1), -1)
        found.append(level)
        kept = np.flatnonzero(inner[node])
        bins, y, node = bins[:, kept], y[kept], node[kept]
        right = bins[level.feature[node], np.arange(len(node))] > level.split[node]
        node, counts, depth = level.child[node] + right, below, under
        todo = _open(counts, depth, rule)
    return found


def _finished(levels: list[_Level], roots: Sequence[int], rule: Rule) -> pa.Table:
    """Pruned nodes of every tree, numbered from 0 in the order parent, left subtree, right subtree."""
    predicted = [level.counts.argmax(axis=1) for level in levels]
    sizes = [np.ones(len(level.child), np.int64) for level in levels]
    for i in range(len(levels) - 2, -1, -1):
        below, inner = levels[i + 1].child, np.flatnonzero(levels[i].child >= 0)
        left = levels[i].child[inner]
        same = (below[left] < 0) & (below[left + 1] < 0) & (predicted[i + 1][left] == predicted[i + 1][left + 1])
        levels[i].child[inner[same]] = -1
        sizes[i][inner] += np.where(same, 0, sizes[i + 1][left] + sizes[i + 1][left + 1])
    tables = []
    root, at = np.asarray(roots), np.zeros(len(roots), np.int64)
    shown = np.arange(len(roots))
    for i, level in enumerate(levels):
        inner = level.child[shown] >= 0
        left = level.child[shown[inner]]
        first = at[inner] + 1
        second = first + (sizes[i + 1][left] if len(left) else 0)
        children = np.full((2, len(shown)), -1)
        children[0, inner], children[1, inner] = first, second
        values = [rule.thresholds[f][s] for f, s in zip(level.feature[shown[inner]], level.split[shown[inner]])]
        tables.append(_node_table(
            root, at, predicted[i][shown], level.impurity[shown], level.counts[shown],
            np.where(inner, level.gain[shown], -1.0), children, np.where(inner, level.feature[shown], -1), values))
        if not inner.any():
            break
        root, at = np.repeat(root[inner], 2), np.stack([first, second], axis=1).ravel()
        shown = np.stack([left, left + 1], axis=1).ravel()
    return pa.concat_tables(tables)


def _node_table(root, at, predicted, impurity, counts, gain, children, feature, values) -> pa.Table:
    """Rows of Spark's saved tree; ``values``: thresholds of the inner nodes."""
    ends = np.concatenate([[0], np.cumsum(feature >= 0)]).astype(np.int32)
    classes = np.arange(0, counts.size + 1, counts.shape[1], dtype=np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(feature, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(values, pa.float64())),
         pa.array(np.full(len(at), -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    return pa.table({
        "root": pa.array(root, pa.int32()), "id": pa.array(at, pa.int32()), "prediction": predicted.astype(float),
        "impurity": impurity, "impurityStats": pa.ListArray.from_arrays(classes, pa.array(counts.ravel())),
        "rawCount": counts.sum(axis=1).astype(np.int64), "gain": gain,
        "leftChild": pa.array(children[0], pa.int32()), "rightChild": pa.array(children[1], pa.int32()), "split": split})


# --- the whole tree -----------------------------------------------------------------------


@dataclass
class _Top:
    """The nodes split from the counts of all blocks; ``child``: the left child, -1 below."""

    counts: list[np.ndarray] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    split: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    impurity: list[float] = field(default_factory=list)
    open: list[bool] = field(default_factory=list)

    def add(self, counts: np.ndarray, depth: int, open_: bool) -> int:
        for to, x in ((self.counts, counts), (self.depth, depth), (self.gain, -1.0), (self.feature, -1), (self.split, 0),
                      (self.child, -1), (self.impurity, float(gini(counts[None])[0])), (self.open, open_)):
            to.append(x)
        return len(self.child) - 1

    def router(self) -> Callable[[np.ndarray], np.ndarray]:
        feature, split, child = (np.array(x, np.int64) for x in (self.feature, self.split, self.child))

        def route(bins: np.ndarray) -> np.ndarray:
            """The node that each row (features x rows) falls into."""
            node = np.zeros(bins.shape[1], np.int64)
            rows = np.arange(bins.shape[1])
            while len(rows):
                rows = rows[child[node[rows]] >= 0]
                at = node[rows]
                node[rows] = child[at] + (bins[feature[at], rows] > split[at])
            return node

        return route


def _blocks(rows: DataFrame, thresholds: Sequence[np.ndarray], limit: int) -> DataFrame:
    """The rows as blocks: labels, and the bin of every feature (how many thresholds lie below the value)."""
    kind = np.min_scalar_type(max((len(t) for t in thresholds), default=0))

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        y = np.concatenate([b.column("y").to_numpy(zero_copy_only=False) for b in batches]).astype(np.int32)
        x = np.concatenate([b.column("x").flatten().to_numpy(zero_copy_only=False) for b in batches])
        x = x.reshape(len(y), len(thresholds))
        bins = np.stack([np.searchsorted(t, x[:, f], "left").astype(kind) for f, t in enumerate(thresholds)])
        return pa.record_batch({"n": pa.array([len(y)], pa.int64()), "y": [y.tobytes()], "bins": [bins.tobytes()]})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held, n = [*held, batch], n + batch.num_rows
            if n >= limit:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)

    return reliable_checkpoint(rows.mapInArrow(pack, _BLOCKS))


def _read(batch: pa.RecordBatch, width: int, kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray, dict]]:
    """Bins (features x rows) and labels of each block, with its other columns."""
    for row in batch.to_pylist():
        yield np.frombuffer(row["bins"], kind).reshape(width, row["n"]), np.frombuffer(row["y"], np.int32), row


def _grow(rows: DataFrame, rule: Rule) -> DataFrame:
    """The nodes of the tree as Spark saves them."""
    spark, width, classes = rows.sparkSession, len(rule.thresholds), rule.classes
    kind = np.min_scalar_type(max((len(t) for t in rule.thresholds), default=0))
    limit = ROWS_PER_TASK
    blocks = _blocks(rows, rule.thresholds, limit)
    labels = np.zeros(classes)

    def label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, y, _ in _read(batch, width, kind):
                yield pa.record_batch({"c": np.arange(classes), "n": np.bincount(y, minlength=classes)})

    for r in blocks.mapInArrow(label_counts, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).collect():
        labels[r.c] = r.n
    top = _Top()
    level = [top.add(labels, 0, True)]
    ends = np.concatenate([[0], np.cumsum(rule.sizes)])
    while big := [i for i in level if top.open[i] and top.counts[i].sum() > limit]:
        counts = _histograms(blocks, top, big, ends, rule, kind)
        sums = np.array([top.counts[i] for i in big])
        gains, feature, split, lefts = best_splits(lambda f: counts[:, ends[f] : ends[f + 1]], sums, rule)
        inner, below, under = _children(gains, np.array([top.depth[i] for i in big]), sums, lefts, rule)
        opened = _open(below, under, rule)
        level, at = [], 0
        for i, node in enumerate(big):
            top.open[node] = False
            if np.isneginf(gains[i]):
                top.impurity[node] = -1.0
            if inner[i]:
                top.gain[node], top.feature[node], top.split[node] = float(gains[i]), int(feature[i]), int(split[i])
                pair = [top.add(below[j], int(under[j]), bool(opened[j])) for j in (at, at + 1)]
                top.child[node], at = pair[0], at + 2
                level += pair
    subtrees = reliable_checkpoint(_subtrees(blocks, top, rule, kind, limit))
    return _joined(spark, subtrees, top, rule)


def _histograms(blocks: DataFrame, top: _Top, nodes: list[int], ends: np.ndarray, rule: Rule, kind: np.dtype) -> np.ndarray:
    """(nodes x bins of all features x classes) rows of the given nodes, in one pass."""
    route, width, classes, bins_ = top.router(), len(rule.thresholds), rule.classes, int(ends[-1])
    rank = np.full(len(top.child), -1)
    rank[nodes] = np.arange(len(nodes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(nodes), bins_, classes), np.int64)
        for batch in batches:
            for bins, y, _ in _read(batch, width, kind):
                at = rank[route(bins)]
                kept = np.flatnonzero(at >= 0)
                at, y, bins = at[kept], y[kept], bins[:, kept]
                for f, size in enumerate(rule.sizes):
                    cell = (at * size + bins[f]) * classes + y
                    total[:, ends[f] : ends[f + 1]] += np.bincount(
                        cell, minlength=len(nodes) * size * classes).reshape(len(nodes), size, classes)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": cells, "n": total.ravel()[cells]})

    sums = blocks.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(nodes), bins_, classes), np.int64)
    out.ravel()[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return out


def _subtrees(blocks: DataFrame, top: _Top, rule: Rule, kind: np.dtype, limit: int) -> DataFrame:
    """Nodes below every open node, each such node and its rows in one task."""
    width = len(rule.thresholds)
    route, depth = top.router(), np.array(top.depth)
    bucket = np.full(len(top.child), -1)
    filled, used = 0, 0
    for i in np.flatnonzero(top.open):  # neighbours share a task up to the bound
        n = top.counts[i].sum()
        if used and used + n > limit:
            filled, used = filled + 1, 0
        bucket[i], used = filled, used + n

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bins, y, _ in _read(batch, width, kind):
                node = route(bins)
                to = bucket[node]
                for b in np.unique(to[to >= 0]):
                    kept = np.flatnonzero(to == b)
                    yield pa.record_batch({
                        "bucket": pa.array([b], pa.int32()), "n": pa.array([len(kept)], pa.int64()),
                        "root": [node[kept].astype(np.int32).tobytes()], "y": [y[kept].tobytes()],
                        "bins": [np.ascontiguousarray(bins[:, kept]).tobytes()]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(bins, y, np.frombuffer(row["root"], np.int32)) for batch in batches for bins, y, row in _read(batch, width, kind)]
        if not parts:
            return
        bins = np.concatenate([p[0] for p in parts], axis=1)
        y, root = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        roots, node = np.unique(root, return_inverse=True)
        levels = _levels(bins, y, node, len(roots), depth[roots], rule)
        yield from _finished(levels, roots, rule).combine_chunks().to_batches(max_chunksize=50_000)

    return blocks.mapInArrow(place, _PLACED).repartitionById(filled + 1, F.col("bucket")).mapInArrow(finish, _NODES)


def _joined(spark: SparkSession, subtrees: DataFrame, top: _Top, rule: Rule) -> DataFrame:
    """Top and subtrees as one tree: leaves of one prediction merged, nodes numbered in one sequence."""
    below = {r.root: r for r in subtrees.groupBy("root").agg(
        F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).collect()}
    child, nodes = list(top.child), range(len(top.child))
    predicted = [int(c.argmax()) for c in top.counts]
    size = [below[i].n if i in below else 1 for i in nodes]
    for i in reversed(nodes):  # children come after their parents
        if child[i] >= 0:
            left, right = child[i], child[i] + 1
            if size[left] == size[right] == 1 and predicted[left] == predicted[right]:
                child[i] = -1
            else:
                size[i] += size[left] + size[right]
    start, shown = {0: 0}, [0]
    for i in shown:
        if child[i] >= 0:
            left, right = child[i], child[i] + 1
            start[left], start[right] = start[i] + 1, start[i] + 1 + size[left]
            shown += [left, right]
    own = [i for i in shown if i not in below]
    offsets = spark.createDataFrame([(i, start[i]) for i in shown if i in below] or [(-1, 0)], "root int, _start int")
    moved = subtrees.join(F.broadcast(offsets), "root").withColumns({
        "id": F.col("id") + F.col("_start"),
        **{c: F.when(F.col(c) < 0, -1).otherwise(F.col(c) + F.col("_start")) for c in ("leftChild", "rightChild")}}).drop("root", "_start")
    if not own:
        return moved
    inner = [i for i in own if child[i] >= 0]
    children = np.array([[start.get(child[i] + k, -1) if child[i] >= 0 else -1 for i in own] for k in (0, 1)])
    table = _node_table(
        np.array(own), np.array([start[i] for i in own]), np.array([predicted[i] for i in own]),
        np.array([top.impurity[i] for i in own]), np.array([top.counts[i] for i in own]),
        np.array([top.gain[i] if child[i] >= 0 else -1.0 for i in own]), children,
        np.array([top.feature[i] if child[i] >= 0 else -1 for i in own]),
        [float(rule.thresholds[top.feature[i]][top.split[i]]) for i in inner])
    return spark.createDataFrame(table.to_pylist(), _NODES).drop("root").unionByName(moved)
