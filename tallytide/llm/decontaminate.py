"""Benchmark decontamination: a prefix-filtered containment join of item windows against texts.

A window is ``size`` consecutive words of an item, or all its words if there are fewer. For a
window to occur in a text, every word of it must, so one necessary word is enough to find the
candidates: the rarest one, by its count over the whole corpus. The prefix word of each window
is joined with the words of the texts (a hash join inside the tasks; the build side is one
block of items of bounded size), the position of the word in the window bounds where an
occurrence can lie, and each remaining place is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready, saved
from tallytide.llm.words import ALNUM, U, hash_words

WINDOW = 10
BLOCK_BYTES = 4 << 20  # item text of one block; larger benchmarks run block by block


@dataclass(frozen=True)
class Index:
    """Windows of one block of items, by their prefix word."""

    prefixes: np.ndarray  # sorted distinct prefix words
    first: np.ndarray  # windows of prefix i: first[i]:first[i + 1]
    offset: np.ndarray  # place of the prefix word in the window
    length: np.ndarray
    words: np.ndarray  # (windows, size) word hashes, zero behind the length
    item: np.ndarray  # row of ``names``
    names: list[str]


def _vocabulary(items: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(items)) if items else np.empty(0, U)


def build_index(names: list[str], items: list[np.ndarray], counts: dict[int, int], size: int) -> Index:
    """``counts``: occurrences of each word of the items in the corpus, 0 if it is not listed."""
    rows = {}
    for at, words in enumerate(items):
        n = min(size, len(words))
        for s in range(len(words) - n + 1 if n else 0):
            rows.setdefault((at, words[s : s + n].tobytes()), words[s : s + n])
    length = np.array([len(w) for w in rows.values()], np.int64)
    words = np.zeros((len(rows), size), U)
    offset = np.zeros(len(rows), np.int64)
    for i, w in enumerate(rows.values()):
        words[i, : len(w)] = w
        offset[i] = min(range(len(w)), key=lambda k: (counts.get(int(w[k]), 0), int(w[k])))
    prefix = words[np.arange(len(rows)), offset] if len(rows) else np.empty(0, U)
    order = np.argsort(prefix, kind="stable")
    prefixes, first = np.unique(prefix[order], return_index=True)
    item = np.array([at for at, _ in rows], np.int64)
    return Index(prefixes, np.append(first, len(rows)).astype(np.int64), offset[order], length[order], words[order],
                 item[order], names)


def find_windows(index: Index, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence in a batch; starts count words of the batch."""
    if not len(index.prefixes) or not len(hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    slot = np.searchsorted(index.prefixes, hashes)
    slot[slot == len(index.prefixes)] = 0
    at = np.flatnonzero(index.prefixes[slot] == hashes)
    slot = slot[at]
    row_end = offsets[np.searchsorted(offsets, at, side="right")]
    row_begin = offsets[np.searchsorted(offsets, at, side="right") - 1]
    found_at, found_window = [], []
    many = index.first[slot + 1] - index.first[slot]
    for turn in range(int(many.max()) if len(many) else 0):  # one window of each prefix at a time
        live = many > turn
        window = index.first[slot[live]] + turn
        start = at[live] - index.offset[window]
        fits = (start >= row_begin[live]) & (start + index.length[window] <= row_end[live])
        window, start = window[fits], start[fits]
        for k in range(index.words.shape[1]):
            short = index.length[window] <= k
            equal = hashes[np.minimum(start + k, len(hashes) - 1)] == index.words[window, k]
            keep = short | equal
            window, start = window[keep], start[keep]
        found_at.append(start)
        found_window.append(window)
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_window)


def _merge(spans: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (word positions, end exclusive) and ``hit_items`` to each text.

    ``keep``: the columns of ``docs`` to return, all by default. A NULL or empty text has no
    words and no hits; an item without words is never found, nor is one whose id is NULL. Equal
    items are each found. ``hit_items`` holds distinct ids as text, in order. Rows are returned
    as often as they are given; columns of ``docs`` with one of the new names are replaced.
    """
    spark = ready(docs.sparkSession)
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in ("n_words", "hit_spans", "hit_items")]
    work = docs.select(*{c: None for c in [*kept, text]})
    known = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("t")).filter(
        "id is not null and t is not null"
    ).distinct()
    total = known.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    for block in range(blocks):
        part = known.filter(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == block).collect()  # about block_bytes
        names = [r["id"] for r in part]
        hashes, ends = hash_words(pa.array([r["t"] for r in part], pa.string()), ALNUM)
        words = [hashes[a:b] for a, b in zip(ends[:-1], ends[1:])]
        counts = _corpus_counts(docs.select(text), _vocabulary(words))
        index = spark.sparkContext.broadcast(build_index(names, words, counts, size))
        work = _annotate(work, text, index)
        if block + 1 < blocks:
            work = saved(work)
    return work.select(*[F.col(f"`{c}`") for c in kept], "n_words", "hit_spans", "hit_items")


def _corpus_counts(texts: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How often the corpus has each word of a block; as many rows as the block has words."""
    if not len(vocabulary):
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            hashes, _ = hash_words(batch.column(0), ALNUM)
            slot = np.searchsorted(vocabulary, hashes)
            slot[slot == len(vocabulary)] = 0
            totals += np.bincount(slot[vocabulary[slot] == hashes], minlength=len(vocabulary))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"slot": seen, "n": totals[seen]})

    rows = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    return {int(vocabulary[r["slot"]]): r["n"] for r in rows}


def _annotate(docs: DataFrame, text: str, index) -> DataFrame:
    before = "hit_spans" in docs.columns
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [f for f in docs.schema.fields if f.name not in ("n_words", "hit_spans", "hit_items")]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", spans_type),
                           T.StructField("hit_items", T.ArrayType(T.StringType()))])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch in batches:
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in [*names, *(
                ("hit_spans", "hit_items") if before else ())]}
            hashes, offsets = hash_words(columns[text], ALNUM)
            start, window = find_windows(ix, hashes, offsets)
            row = np.searchsorted(offsets, start, side="right") - 1
            spans, found = [[] for _ in range(len(batch))], [set() for _ in range(len(batch))]
            if before:
                for i, (s, x) in enumerate(zip(columns["hit_spans"].to_pylist(), columns["hit_items"].to_pylist())):
                    spans[i], found[i] = [(d["start"], d["end"]) for d in s], set(x)
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(len(batch) + 1))
            for i in np.unique(row):
                mine = order[cuts[i] : cuts[i + 1]]
                begin = start[mine] - offsets[i]
                new = np.unique(np.stack([begin, begin + ix.length[window[mine]]], 1), axis=0).tolist()
                spans[i] = _merge([*spans[i], *new])
                found[i] |= {ix.names[k] for k in np.unique(ix.item[window[mine]])}
            out = [columns[n] for n in names]
            out.append(pa.array(np.diff(offsets), pa.int64()))
            out.append(pa.array([[{"start": a, "end": b} for a, b in s] for s in spans],
                                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            out.append(pa.array([sorted(x) for x in found], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(out, names=[*names, "n_words", "hit_spans", "hit_items"])

    return docs.mapInArrow(run, schema)


def report(marked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and a digest per text from the output of :func:`decontaminate`."""
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.select(
        doc_id, "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
