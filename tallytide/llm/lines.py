"""Substring dedup by lines: the earliest occurrence of a line stays, its later occurrences are cut out.

Lines are normalised (case, marks, spaces) and hashed where they lie; digests that occur more
than once keep their first occurrence by document rank and offset; the others become spans of
the original text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallytide.llm.common import ready
from tallytide.llm.words import ALNUM, U, mix, place_words, text_bytes

MIN_WORDS = 5  # shorter lines repeat by chance
WINDOW, WINDOWS = 26, 25  # words of a window; windows of which one is a unit: fewer than words, so that units overlap
PASSAGE_WORDS = 20  # a repeated line of so many words is a copy
WORD_CHARS = 8  # characters that count as a word where a line has fewer gaps (scripts without spaces)
_FACTORS = mix(np.arange(1, WINDOW + 1, dtype=U)) | U(1)
_MARKS = re.compile(r"[^\w]+")
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")


def units_of(text: str, paragraphs: bool = False) -> list[tuple[int, int]]:
    """(start, end) of the lines of a text, line ends included, or of the paragraphs between empty lines."""
    if paragraphs:
        cuts = [0, *(m.end() for m in _PARAGRAPH.finditer(text)), len(text)]
    else:
        cuts, at = [0], text.find("\n")
        while at >= 0:
            cuts.append(at + 1)
            at = text.find("\n", at + 1)
        cuts.append(len(text))
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _units(docs: DataFrame, doc_id: str, text: str, min_words: int, paragraphs: bool) -> DataFrame:
    """(id, tie, h1, h2, start, end, words): every unit with enough words and the digest of its normal form."""
    work = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", work.schema["id"].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("tie", "h1", "h2", "start", "end", "words")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, h1, h2, start, end, words = [], [], [], [], [], []
            for i, value in enumerate(batch.column(2).to_pylist()):
                for a, b in units_of(value or "", paragraphs):
                    plain = _MARKS.sub(" ", value[a:b].lower()).strip()
                    size = plain.count(" ") + 1
                    if plain and size >= min_words:
                        x, y = struct.unpack("<qq", hashlib.blake2b(plain.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                        row.append(i), h1.append(x), h2.append(y), start.append(a), end.append(b), words.append(size)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, pa.int64()) for c in (h1, h2, start, end, words)]],
                names=["id", "tie", "h1", "h2", "start", "end", "words"])

    return work.mapInArrow(run, schema)


def _spans(docs: DataFrame, doc_id: str, text: str, min_words: int, paragraphs: bool) -> DataFrame:
    """(id, tie, n_removed, chars_removed, n_long_removed, removed) of the texts that lose something."""
    units = _units(docs, doc_id, text, min_words, paragraphs).distinct()
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "tie", "start")
    kept = units.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(rank).alias("first")).filter("n > 1").drop("n")
    later = units.join(kept, ["h1", "h2"]).filter(~rank.eqNullSafe(F.col("first")))
    return later.groupBy("id", "tie").agg(
        F.count("*").alias("n_removed"), F.sum(F.col("end") - F.col("start")).alias("chars_removed"),
        F.count_if(F.col("words") >= MIN_WORDS).alias("n_long_removed"),
        F.array_sort(F.collect_list(F.struct("start", "end", F.col("first.id").alias("first_doc"), "words"))).alias("removed"))


def chosen_windows(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of the windows that winnowing chooses in each row of hashed words.

    The choice in a stretch of ``WINDOW + WINDOWS - 1`` words depends on its words alone. Of chosen neighbours with
    equal hashes, as in a text that repeats a few words over and over, the first is given.
    """
    n = len(hashes) - WINDOW + 1
    if n < WINDOWS:
        return np.empty(0, np.int64), np.empty(0, U)
    grams = np.zeros(n, U)
    for k in range(WINDOW):
        grams += hashes[k : k + n] * _FACTORS[k]
    grams = mix(grams)
    starts = np.arange(n - WINDOWS + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(starts)]  # of the row that holds the first word
    starts = starts[starts + WINDOW + WINDOWS - 1 <= ends]
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOWS).argmin(axis=1)
    chosen = np.unique(starts + least[starts])
    row = np.searchsorted(offsets, chosen, side="right")
    new = np.ones(len(chosen), bool)
    new[1:] = (grams[chosen[1:]] != grams[chosen[:-1]]) | (row[1:] != row[:-1])
    return chosen[new], grams[chosen[new]]


def _windows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, tie, h, start, end): the chosen windows of every text, in code points."""
    work = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("id", work.schema["id"].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("tie", "h", "start", "end")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, offsets, first, last = place_words(batch.column(2), ALNUM)
            at, h = chosen_windows(hashes, offsets)
            data, edges = text_bytes(batch.column(2))
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            row = np.searchsorted(offsets, at, side="right") - 1
            before = points[edges[row]]
            take = pa.array(row, pa.int64())
            numbers = (h.view(np.int64), points[first[at]] - before, points[last[at + WINDOW - 1] + 1] - before)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, pa.int64()) for c in numbers]],
                names=["id", "tie", "h", "start", "end"])

    return work.mapInArrow(run, schema)


def _copied(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, tie, copied): the chosen windows of a text that an earlier text has, as (start, end, first_doc)."""
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "tie")
    met = _windows(docs, doc_id, text).withColumn("first", F.min(rank).over(Window.partitionBy("h")))
    later = met.filter(~rank.eqNullSafe(F.col("first")))
    return later.groupBy("id", "tie").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", F.col("first.id").alias("first_doc")))).alias("copied"))


def joined_spans(removed: list | None, copied: list | None) -> list[tuple]:
    """Repeated lines and copied windows as disjoint spans (start, end, first_doc, passage) in their order.

    Windows that overlap become one passage, of which the parts outside repeated lines are spans of their own. A
    repeated line is part of a passage if it has ``PASSAGE_WORDS`` words or overlaps one.
    """
    runs: list[list] = []
    for start, end, first_doc in copied or []:
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, first_doc])
    out, k = [], 0
    for start, end, first_doc, words in removed or []:
        while k < len(runs) and runs[k][1] <= start:
            out.append((*runs[k], True))
            k += 1
        meets = k < len(runs) and runs[k][0] < end
        if meets and runs[k][0] < start:
            out.append((runs[k][0], start, runs[k][2], True))
        out.append((start, end, first_doc, meets or max(words, (end - start) // WORD_CHARS) >= PASSAGE_WORDS))
        while k < len(runs) and runs[k][1] <= end:
            k += 1
        if k < len(runs) and runs[k][0] < end:
            runs[k][0] = end
    return out + [(*run, True) for run in runs[k:]]


def _passages(docs: DataFrame, doc_id: str, text: str, min_words: int, paragraphs: bool) -> DataFrame:
    """(id, tie, n_long_removed, removed) of the texts with repeats; ``removed`` as ``joined_spans`` gives it."""
    units = _spans(docs, doc_id, text, min_words, paragraphs).select("id", "tie", "n_long_removed", "removed")
    copied = _copied(docs, doc_id, text).withColumnsRenamed({"id": "id2", "tie": "tie2"})
    met = units.join(copied, F.col("id").eqNullSafe(F.col("id2")) & (F.col("tie") == F.col("tie2")), "full")
    joined = F.udf(joined_spans, T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("first_doc", units.schema["id"].dataType), T.StructField("passage", T.BooleanType())])))
    return met.select(
        F.when(F.col("tie2").isNull(), F.col("id")).otherwise(F.col("id2")).alias("id"),
        F.coalesce("tie", "tie2").alias("tie"), "n_long_removed", joined("removed", "copied").alias("removed"))


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 1, paragraphs: bool = False
) -> DataFrame:
    """One row per text: its id, ``n_removed``, ``chars_removed``, ``removed``, ``n_long_removed`` and ``n_short``.

    ``removed`` lists all repeats in the order of the text, as spans (start, end, first_doc, passage): the units of
    ``repeated_lines`` and, outside of them, the words of windows that an earlier text has. ``passage`` tells copied
    passages from units that repeat by chance (``joined_spans``); ``n_removed`` and ``chars_removed`` count passages,
    ``n_short`` the other spans. Every run of 50 words (``ALNUM`` words, A-Z lowered) that an earlier text shares is met;
    up to ``WINDOWS - 1`` words at each of its ends may lie outside the span. ``n_long_removed`` is that of ``repeated_lines``.
    """
    ready(docs.sparkSession)
    per_text = _passages(docs, doc_id, text, min_words, paragraphs)
    base = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_tie"))
    out = base.join(per_text, F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_tie") == F.col("tie")), "left").withColumn(
        "removed", F.coalesce("removed", F.array().cast(per_text.schema["removed"].dataType)))
    cut = F.filter("removed", lambda s: s["passage"])
    return out.select(
        F.col("_doc").alias(doc_id), F.size(cut).cast("long").alias("n_removed"),
        F.aggregate(cut, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("chars_removed"),
        "removed", F.coalesce("n_long_removed", F.lit(0)).alias("n_long_removed"),
        (F.size("removed") - F.size(cut)).cast("long").alias("n_short"))


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, paragraphs: bool = False
) -> DataFrame:
    """One row per text: its id, ``n_removed``, ``chars_removed``, ``removed`` and ``n_long_removed``.

    ``removed`` lists spans (start, end, first_doc) of the original text in code points, end
    exclusive, line end included, with the id of the text that keeps the unit. Texts are ranked
    by id (NULL last), then by a hash of the text; within a text the earlier offset is first.
    ``n_long_removed`` counts the spans of at least ``MIN_WORDS`` words, which repeat by copying, not by chance.
    Units of fewer than ``min_words`` words stay; words are counted by gaps, so a unit of a script
    without spaces counts as few. With 1 only units without any word stay. Rows with equal id and text count as one text.
    NULL and empty texts lose nothing. Other columns are not read.
    """
    ready(docs.sparkSession)
    per_text = _spans(docs, doc_id, text, min_words, paragraphs).withColumn("removed", F.transform("removed", lambda s: s.dropFields("words")))
    base = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_tie"))
    out = base.join(per_text, F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_tie") == F.col("tie")), "left")
    return out.select(
        F.col("_doc").alias(doc_id), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("chars_removed", F.lit(0)).alias("chars_removed"),
        F.coalesce("removed", F.array().cast(per_text.schema["removed"].dataType)).alias("removed"),
        F.coalesce("n_long_removed", F.lit(0)).alias("n_long_removed"))


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, paragraphs: bool = False,
    passages: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with the repeated units cut out of their texts; the other columns as they are.

    With ``passages`` the passages of ``repeated_passages`` are cut instead.
    """
    ready(docs.sparkSession)
    if passages:
        per_text = _passages(docs, doc_id, text, min_words, paragraphs).withColumn(
            "removed", F.filter("removed", lambda s: s["passage"]))
    else:
        per_text = _spans(docs, doc_id, text, min_words, paragraphs)
    per_text = per_text.select(
        F.col("id").alias("_id"), F.col("tie").alias("_key"), F.col("removed").alias("_removed"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    met = rows.join(per_text, F.col(f"_row.{doc_id}").eqNullSafe(F.col("_id")) & (
        F.xxhash64(F.col(f"_row.{text}")) == F.col("_key")), "left")

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or r is None else _cut(t, r) for t, r in zip(texts, removed)], dtype=object)

    met = met.withColumn("_text", cut(F.col(f"_row.{text}"), F.col("_removed")))
    return met.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _cut(text: str, removed: list) -> str:
    out, at = [], 0
    for span in removed:
        out.append(text[at : span["start"]])
        at = span["end"]
    return "".join(out) + text[at:]
