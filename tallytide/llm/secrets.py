"""Secret scans: candidate tokens, then a random forest that removes false positives.

Candidates are runs of key-like characters. The forest sees length, character transitions,
dictionary coverage, the path of the text and the neighbouring words, and is trained on
labelled findings. Where none are given, findings of issued formats, or set in quotes or an
assignment to a name for secrets, count as true, and tokens that read like words, placeholders
or numbers count as false.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready, saved
from tallytide.llm.words import text_bytes

TRAIN_ROWS = 20_000  # labelled findings the forest is fitted on, about
TREES, DEPTH, SEED = 30, 8, 11
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_LONG_WORD = 20  # tokens of letters alone are candidates from this length on
_ISSUED = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|"
    r"sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")
_ASSIGNED = re.compile(r"(?:token|secret|passwd|password|pwd|api[_-]?key|access[_-]?key|auth|bearer)[\"']?\s*[:=]?\s*[\"']?$", re.IGNORECASE)
_HOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test[_-]|0123456789|abcdef0123|12345678", re.IGNORECASE)
_WORDS = re.compile(r"[A-Za-z]+")
# Words a token may be made of without being random
DICTIONARY = frozenset(
    "the and for that with this from have not are was but you all can had her one our out day get has him his how man new now "
    "old see two way who boy did its let put say she too use about after again also back because before between both come could "
    "down each even first give good great here high into just know last life like line long look made make many more most much "
    "must name never next only other over own part people place right same should show since small some still such take tell "
    "than their them then there these they thing think time under very want water well were what when where which while will "
    "work world would year your user data file path index page image static content assets style script version build test "
    "example default config value string number list item".split())
FEATURES = ("length", "digits", "upper", "changes", "entropy", "rare", "words", "vowels", "slashes", "assigned", "quoted", "issued", "path")


def _pairs(docs: DataFrame, text: str) -> np.ndarray:
    """How often one byte follows another in the whole corpus, as log shares: 256 x 256."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a in range(int(offsets[0]), int(offsets[-1]) - 1, 1 << 20):
                part = data[a : min(a + (1 << 20) + 1, int(offsets[-1]))].astype(np.int32)
                total += np.bincount(part[:-1] * 256 + part[1:], minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": seen, "n": total[seen]})

    rows = docs.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    table = np.ones(1 << 16)  # at most 65,536 rows came back
    for r in rows:
        table[r["pair"]] += r["n"]
    table = table.reshape(256, 256)
    return np.log2(table / table.sum(1, keepdims=True)).astype(np.float32)


def _coverage(token: str) -> float:
    """Share of the token's characters in runs of letters that are words of the dictionary, longest first."""
    covered = 0
    for run in _WORDS.findall(token):
        low, at = run.lower(), 0
        while at < len(low):
            size = next((k for k in range(min(9, len(low) - at), 2, -1) if low[at : at + k] in DICTIONARY), 0)
            covered += size
            at += size or 1
    return covered / len(token)


def token_features(text: str, start: int, end: int, path: str, pairs: np.ndarray) -> list[float]:
    token, n = text[start:end], end - start
    codes = np.frombuffer(token.encode("ascii"), np.uint8)
    kinds = np.select([(codes >= 48) & (codes < 58), (codes >= 65) & (codes < 91), codes >= 97], [1, 2, 3], 0)
    before = text[max(0, start - 40) : start]
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(token).values())
    return [
        float(n), float((kinds == 1).mean()), float((kinds == 2).mean()), float((kinds[1:] != kinds[:-1]).mean()), entropy,
        float(-pairs[codes[:-1], codes[1:]].mean()), _coverage(token), sum(c in "aeiouAEIOU" for c in token) / n,
        token.count("/") / n, float(bool(_ASSIGNED.search(before))),
        float(text[start - 1 : start] in ("'", '"') and text[end : end + 1] in ("'", '"')),
        float(bool(_ISSUED.fullmatch(token))), float(bool(re.search(r"test|example|doc|sample", path or "", re.IGNORECASE))),
    ]


def presumed_label(token: str, x: list[float]) -> int:
    """1 a secret, 0 none, -1 not told, by the rules that stand in for labelled findings."""
    f = dict(zip(FEATURES, x))
    if _HOLDER.search(token) or f["entropy"] < 2.0:
        return 0
    if f["issued"] or (f["assigned"] and f["entropy"] >= 2.8 and f["digits"] > 0):
        return 1
    if f["digits"] in (0, 1) or f["words"] >= 0.6 or f["slashes"] > 0.12:
        return 0
    return -1


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, start, end, token, features, presumed) of every candidate token, in code points, end exclusive.

    ``path``: a column with the path or name of the text, if there is one. NULL and empty texts
    have no candidates. Rows are reported as often as they are given.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_pairs(docs, text))
    where = F.col(path).cast("string") if path else F.lit("")
    work = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), where.alias("path"))
    schema = T.StructType([
        T.StructField("id", work.schema["id"].dataType), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("token", T.StringType()), T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("presumed", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end, token, features, presumed = [], [], [], [], [], []
            paths = batch.column(2).to_pylist()
            for i, value in enumerate(batch.column(1).to_pylist()):
                for m in _TOKEN.finditer(value or ""):
                    found = m.group()
                    if found.isalpha() and len(found) < _LONG_WORD:
                        continue
                    x = token_features(value, *m.span(), paths[i], shared.value)
                    row.append(i), start.append(m.start()), end.append(m.end()), token.append(found), features.append(x)
                    presumed.append(presumed_label(found, x))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(token, pa.string()),
                 pa.array(features, pa.list_(pa.float64())), pa.array(presumed, pa.int32())],
                names=["id", "start", "end", "token", "features", "presumed"])

    return work.mapInArrow(run, schema)


def train(found: DataFrame, label: str = "presumed", rows: int = TRAIN_ROWS):
    """A forest fitted on about ``rows`` labelled findings (label 0 or 1), or the one label there is, or None."""
    known = found.filter(F.col(label).isin(0, 1)).select("features", F.col(label).cast("double").alias("label"), "token")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return next(iter(sizes), None)
    share = int(min(1.0, rows / sum(sizes.values())) * (1 << 30))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(SEED), "token"), F.lit(1 << 30)) < share)
    chosen = saved(chosen.select(array_to_vector("features").alias("vector"), "label"))
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(chosen) if chosen.select("label").distinct().count() == 2 else float(max(sizes, key=sizes.get))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                 labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: id, start, end, ``score`` (chance of a secret) and ``is_secret``.

    ``labelled``: findings (features, token, presumed) to train on; the corpus's own, with presumed
    labels, by default. Where the labels know one class only, that is every candidate's verdict;
    without labels nothing is a secret.
    """
    found = saved(findings(docs, doc_id, text, path))
    model = train(found if labelled is None else labelled)
    if model is None or isinstance(model, float):
        scored = found.withColumn("score", F.lit(float(model or 0)))
    else:
        scored = model.transform(found.withColumn("vector", array_to_vector("features"))).withColumn(
            "score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(doc_id), "start", "end", "token", "score", (F.col("score") >= 0.5).alias("is_secret"))
