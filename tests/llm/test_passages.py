"""Passages that texts share inside longer lines: found, and told from lines that repeat by chance."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tallytide.llm import lines, queries
from tallytide.llm.words import ALNUM, place_words

from .conftest import messy_rows


UPPER = str.maketrans("abcdefgh", "ABCDEFGH")


def prose(rng, n):
    return " ".join(rng.choice("é😀abcdefgh") + str(rng.randrange(10**6)) for _ in range(n))


def test_passages_inside_longer_lines(spark, tmp_path):
    rng = random.Random(5)
    long, line, short = prose(rng, 70), prose(rng, 30), "Les."
    docs = [
        (1, f"{prose(rng, 9)} {long}, {prose(rng, 5)}\n{short}\n{line}"),
        (2, f"{prose(rng, 3)}\n{prose(rng, 4)} {long.translate(UPPER).replace(' ', '  ')} {prose(rng, 8)}\n{short}\n{prose(rng, 60)}"),
        (3, f"{short}\n{line}\n{prose(rng, 30)}"), (4, f"{prose(rng, 80)}\n{short}"), (5, None), (6, ""),
        (None, "\n".join(" ".join(long.split()[k : k + 10]) for k in range(0, 70, 10))),
        (2, "another text of the same id"),
    ]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.queries()["op9_line_dedup"](spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    got = sorted((str(r["doc_id"]), r["n_removed"], r["n_short"]) for r in rows)
    assert got == [("1", 0, 0), ("2", 0, 0), ("2", 1, 1), ("3", 1, 1), ("4", 0, 1), ("5", 0, 0), ("6", 0, 0), ("None", 1, 0)]
    two = next(r for r in rows if r["doc_id"] == 2 and r["n_removed"])
    (span,) = [s for s in two["removed"] if s["passage"]]
    cut = docs[1][1][span["start"] : span["end"]].lower().split()
    assert len(cut) >= 70 - 2 * (lines.WINDOWS - 1) and " ".join(cut) in long and span["first_doc"] == 1
    assert two["chars_removed"] == span["end"] - span["start"]
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r["text"] for r in lines.without_repeats(frame, min_words=1, passages=True).filter("doc_id = 3").collect()}
    assert kept == {docs[2][1].replace(f"{line}\n", "")}


def test_every_shared_run_has_a_chosen_window():
    rng = random.Random(1)
    size = lines.WINDOW + lines.WINDOWS - 1
    for _ in range(60):
        run = prose(rng, size)
        texts = pa.array([f"{prose(rng, rng.randrange(90))} {run} {prose(rng, rng.randrange(90))}" for _ in range(2)] + [None, "a b", run])
        words, offsets, _, _ = place_words(texts, ALNUM)
        at, h = lines.chosen_windows(words, offsets)
        row = np.searchsorted(offsets, at, side="right") - 1
        assert set(h[row == 0]) & set(h[row == 1]) & set(h[row == 4])
        assert (at + lines.WINDOW <= offsets[row + 1]).all()
    words, offsets, _, _ = place_words(pa.array(["la " * 500, "x"]), ALNUM)
    assert len(lines.chosen_windows(words, offsets)[0]) == 1


@pytest.mark.parametrize(("removed", "copied", "want"), [
    (None, None, []),
    ([(0, 4, 1, 1)], None, [(0, 4, 1, False)]),
    ([(0, 90, 1, 20), (95, 99, 1, 1)], None, [(0, 90, 1, True), (95, 99, 1, False)]),
    (None, [(3, 9, 1), (8, 20, 1), (30, 40, 2)], [(3, 20, 1, True), (30, 40, 2, True)]),
    ([(10, 14, 5, 2), (14, 16, 5, 1), (40, 44, 6, 1)], [(3, 9, 1), (8, 20, 1)],
     [(3, 10, 1, True), (10, 14, 5, True), (14, 16, 5, True), (16, 20, 1, True), (40, 44, 6, False)]),
    ([(0, 10, 5, 2)], [(2, 6, 1), (8, 12, 1), (20, 30, 1)], [(0, 10, 5, True), (10, 12, 1, True), (20, 30, 1, True)]),
])
def test_lines_and_windows_become_disjoint_spans(removed, copied, want):
    assert lines.joined_spans(removed, copied) == want


def test_passages_on_messy_rows(spark, messy, no_docs):
    assert lines.repeated_passages(messy).count() == len(messy_rows()) and lines.repeated_passages(no_docs).count() == 0
    assert lines.without_repeats(messy, passages=True).columns == messy.columns
