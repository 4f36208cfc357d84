"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of a text.

A paragraph is a line. A section ends with an empty line, or with a paragraph whose digest says
so, and a piece ends at the first space after a mark or one of a few letters, so that all
borders depend on nearby text only and an edit changes the branches around it. Every node's
digest covers its children in order. Equal roots mean equal texts; where they differ, only
branches with different digests need to be followed to locate an edit.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready

_PIECE = re.compile(r".{24,256}?(?:(?<=[.,;:!?|dgnrst])\s|\Z)|.{1,256}", re.DOTALL)
_FINE = re.compile(r".{6,32}?(?:\s|\Z)|.{1,32}", re.DOTALL)
_FINE_TO = 192  # code points at the head of a text that are cut finely, so that short texts have several leaves
_SECTION_EVERY = 8


def _digest(kind: bytes, data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size, person=kind).digest()


class Tree:
    """Digests of a text: ``root`` (hex), ``sections`` of ``paragraphs`` of leaves (hex digest, code points)."""

    __slots__ = ("root", "sections")

    def __init__(self, text: str) -> None:
        self.sections: list[tuple[bytes, list[tuple[bytes, list[tuple[str, int]]]]]] = []
        section: list[tuple[bytes, list[tuple[str, int]]]] = []
        start = 0
        while start < len(text):
            end = text.find("\n", start) + 1 or len(text)
            leaves, whole = [], hashlib.blake2b(digest_size=12, person=b"paragraph")
            border = min(max(start, _FINE_TO), end)
            for piece in [*_FINE.findall(text, start, border), *_PIECE.findall(text, border, end)]:
                data = piece.encode("utf-8", "surrogatepass")
                leaves.append((_digest(b"leaf", data, 4).hex(), len(piece)))
                whole.update(len(data).to_bytes(4, "big") + data)
            digest = whole.digest()
            section.append((digest, leaves))
            if text[start:end].isspace() or digest[0] % _SECTION_EVERY == 0:
                self._close(section)
                section = []
            start = end
        if section:
            self._close(section)
        self.root = _digest(b"root", b"".join(d for d, _ in self.sections), 16).hex()

    def _close(self, section: list) -> None:
        self.sections.append((_digest(b"section", b"".join(d for d, _ in section), 12), section))

    def leaves(self) -> Counter:
        """Leaf digest -> code points under it."""
        out: Counter = Counter()
        for _, section in self.sections:
            for _, leaves in section:
                for digest, n in leaves:
                    out[digest] += n
        return out

    def __str__(self) -> str:
        """``root:sections``; / between sections, | between paragraphs, a leaf is 8 digits and its length, both hex."""
        return self.root + ":" + "/".join(
            "|".join(" ".join(f"{d}{n:x}" for d, n in leaves) for _, leaves in section) for _, section in self.sections)


def _shared(a: Counter, b: Counter) -> float:
    total = sum(a.values()) + sum(b.values())
    common = sum(min(n, b[d]) for d, n in a.items() if d in b)
    return common / (total - common) if total else 1.0


def likeness(a: str, b: str) -> float:
    """Share of the text under leaves that two fingerprints have in common (0 to 1)."""
    def leaves(fingerprint: str) -> Counter:
        out: Counter = Counter()
        for leaf in re.split(r"[ |/]", fingerprint.partition(":")[2]):
            if leaf:
                out[leaf[:8]] += int(leaf[8:], 16)
        return out

    return 1.0 if a == b else _shared(leaves(a), leaves(b))


def first_difference(a: Tree, b: Tree) -> int | None:
    """Code point of ``a`` from which the texts may differ, found by following differing branches; None if equal."""
    if a.root == b.root:
        return None
    at = 0
    for i, (digest, section) in enumerate(a.sections):
        if i < len(b.sections) and b.sections[i][0] == digest:
            at += sum(n for _, leaves in section for _, n in leaves)
            continue
        other = b.sections[i][1] if i < len(b.sections) else []
        for j, (paragraph, leaves) in enumerate(section):
            if j < len(other) and other[j][0] == paragraph:
                at += sum(n for _, n in leaves)
                continue
            beside = other[j][1] if j < len(other) else []
            for k, leaf in enumerate(leaves):
                if k >= len(beside) or beside[k] != leaf:
                    return at
                at += leaf[1]
            return at
        return at
    return at


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every text; NULL counts as empty. A column ``name`` of ``docs`` is replaced."""
    @F.pandas_udf(T.StringType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(lambda t: str(Tree(t)))

    ready(docs.sparkSession)
    return docs.withColumn(name, of(F.col(text)))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, next to those of the following text.

    The following text is the one with the next smaller id; after the last comes the first.
    NULL ids come last; rows with equal ids are ordered by a hash of the text, rows equal in
    both are interchangeable. NULL texts count as empty; an id is an integer. Returns the id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    edit_found (the code point from which the edit was located). An empty table gives no rows.

    The rows are cut into ranges of ids. A range needs the first row of the one after it, so
    the first rows, one for each range, are dealt to two ranges. Each range is then read in order,
    two texts at a time; the texts are shuffled once.
    """
    spark = ready(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    work = work.withColumn("tie", F.xxhash64("text"))
    narrow = work.select("id", "tie").repartitionByRange(4 * parts, F.desc_nulls_last("id"), F.asc("tie"))
    first = F.min(F.struct(F.col("id").isNull().alias("a"), (-F.col("id")).alias("b"), F.col("tie").alias("c")))
    heads = narrow.groupBy(F.spark_partition_id()).agg(first.alias("head")).collect()  # a row for each range
    keys = sorted((r["head"]["a"], r["head"]["b"] or 0, r["head"]["c"]) for r in heads)
    shared = spark.sparkContext.broadcast(keys)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(ids: pd.Series, ties: pd.Series) -> pd.Series:
        """The range of a row, and, for a first row, also the range before it, as a negative number."""
        cuts, out = shared.value, []
        missing = ids.isna().to_numpy()
        for null, value, tie in zip(missing, ids.where(~missing, 0).astype("int64").tolist(), ties.tolist()):
            key = (bool(null), 0 if null else -value, tie)
            at = bisect.bisect_right(cuts, key) - 1
            out.append([at, -1 - (at - 1) % len(cuts)] if cuts[at] == key else [at])
        return pd.Series(out)

    dealt = work.withColumn("place", F.explode(places(F.col("id"), F.col("tie"))))
    dealt = dealt.withColumn("copy", F.col("place") < 0).withColumn(
        "range", F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")))
    ordered = dealt.repartition(parts, "range").sortWithinPartitions(
        "range", "copy", F.desc_nulls_last("id"), F.asc("tie"))
    schema = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, edit_found long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current, rows = None, None, []

        def finish(row: tuple, following: str, tree: Tree) -> None:
            key, value, own = row
            other = edited(value, following)
            changed = own if other == value else Tree(other)
            leaves = own.leaves()
            rows.append((key, len(value), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), str(own),
                         str(changed), _shared(leaves, changed.leaves()), _shared(leaves, tree.leaves()),
                         first_difference(own, changed)))

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            names = [f.split()[0] for f in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for key, value, copy, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != current:
                    waiting, current = None, at
                if copy and waiting is None:
                    continue
                tree = Tree(value)
                if waiting is not None:
                    finish(waiting, value, tree)
                waiting = None if copy else (key, value, tree)
                if len(rows) >= 200:
                    yield out()
                    rows.clear()
        yield out()

    found = ordered.select("id", "text", "copy", "range").mapInArrow(run, schema)
    return found.withColumnRenamed("id", doc_id)
