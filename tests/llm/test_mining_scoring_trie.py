"""Hard negatives, suffix-tree scores and the conversation trie against brute-force versions, on rows with every defect."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tallytide.llm import negatives, prefix_trie, suffix_tree

from .brute_lm import brute_pst
from .brute_trie import brute_trie
from .conftest import messy_rows

EMB = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
    # names the operator uses itself
    T.StructField("v", T.StringType()), T.StructField("score", T.StringType()), T.StructField("anchor_id", T.StringType()),
])


def brute_negatives(rows, positives=5, negatives_=3):
    """The contract of op11, pair by pair."""
    clean = []
    for vec_id, emb, label, *_ in rows:
        if vec_id is None or label is None or emb is None or any(x is None or not math.isfinite(x) for x in emb):
            continue
        lab = (label + 1) % 10 if vec_id % 7 == 0 else label
        clean.append((vec_id, lab, [math.floor(256 * float(np.float32(x))) for x in emb]))
    out = []
    for a_id, a_lab, a_v in clean:
        if a_id % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a_v, v, strict=False)), i, lab) for i, lab, v in clean if i != a_id]
        scored.sort(key=lambda t: (-t[0], t[1]))
        pos = [t for t in scored if t[2] == a_lab][:positives]
        for ps, p_id, _ in pos:
            hits = [t for t in scored if t[2] != a_lab and 50 * ps <= 100 * t[0] <= 95 * ps][:negatives_]
            out += [(a_id, p_id, r + 1, n_id, ps, ns) for r, (ns, n_id, _) in enumerate(hits)]
    return sorted(out)


def embedding_rows(n=260, dims=9, seed=3):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        centre = base[i % 6]
        vec = [c + rng.gauss(0, 0.15) for c in centre]
        rows.append((i, vec, i % 4, "x", "y", "z"))
    rows[50] = (50, rows[49][1], 1, "x", "y", "z")  # ties: equal vectors
    rows[51] = (51, rows[49][1], 2, "x", "y", "z")
    rows += [
        (300, None, 1, None, None, None), (301, [0.1] * dims, None, None, None, None),
        (302, [0.1, None] + [0.0] * (dims - 2), 1, None, None, None), (303, [float("nan")] * dims, 1, None, None, None),
        (304, [float("inf")] + [0.0] * (dims - 1), 1, None, None, None), (None, [0.2] * dims, 1, None, None, None),
        (350, [], 2, None, None, None), (400, [0.5, -0.5], 3, None, None, None),  # empty and short vectors
        (100, rows[100][1], rows[100][2], "r", "r", "r"),  # a repeated row: two rows of one vec_id
    ]
    return rows


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_hard_negatives_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", chunk)
    rows = embedding_rows()
    df = spark.createDataFrame(rows, EMB).repartition(3)
    got = sorted(tuple(r) for r in negatives.mine(df).collect())
    assert got == brute_negatives(rows)
    assert len(got) > 50


def test_hard_negatives_in_blocks_of_anchors(spark, monkeypatch):
    """A broadcast bound below all anchors: blocks of anchors, same result."""
    rows = embedding_rows(seed=4)
    spark.conf.set("spark.tallytide.broadcastBytes", "300")
    try:
        got = sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, EMB)).collect())
    finally:
        spark.conf.unset("spark.tallytide.broadcastBytes")
    assert got == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert negatives.mine(spark.createDataFrame([], EMB)).count() == 0
    only_bad = [(0, None, 1, None, None, None), (50, [float("nan")], 2, None, None, None)]
    assert negatives.mine(spark.createDataFrame(only_bad, EMB)).count() == 0


def test_pruning_keeps_exact_windows():
    """The bound scan against a full product on random data."""
    rng = np.random.default_rng(0)
    x = rng.integers(-300, 300, size=(500, 16))
    q = rng.integers(-300, 300, size=16)
    full = x @ q
    for k in (1, 5, 40):
        def keep(partial, low, high, k=k):
            return np.ones(len(low), bool) if len(low) <= k else high >= np.partition(low, len(low) - k)[len(low) - k]
        alive, score = negatives._bond(q, x, np.arange(500), keep)
        assert (score == full[alive]).all()
        assert sorted(score)[-k:] == sorted(full)[-k:]


def docs_frame(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("_row", T.StringType()), T.StructField("tokens", T.StringType())])
    return spark.createDataFrame([(d, t, "x", "y") for d, t in rows], schema)


def close(a, b):
    return abs(a - b) <= 1e-7 * max(1.0, abs(b))


@pytest.mark.parametrize("params", [{}, {"min_count": 1, "divergence": 0.0}, {"depth": 1}])
def test_suffix_tree_matches_brute_force(spark, params):
    rows = [(r[0], r[1]) for r in messy_rows()]
    rng = random.Random(2)
    words = ["a", "b", "c", "D", "e", "ff", "g"]
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    got = suffix_tree.lm_scores(docs_frame(spark, rows), **params).collect()
    want = brute_pst(rows, **{"depth": 3, "min_count": 3, "divergence": 2.0, "beta": 1.0} | params)
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert len(got) == len(want) == len(rows)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and close(g[5], w[5]) and close(g[6], w[6]), (g, w)


def test_suffix_tree_learns_more_than_unigrams(spark):
    """Held out texts of a repeating grammar score higher with contexts than with the unigram base."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        subject = rng.choice(["the cat", "a dog", "the bird"])
        verb = {"the cat": "sleeps", "a dog": "barks", "the bird": "sings"}[subject]
        rows.append((i, " ".join(f"{subject} {verb} now." for _ in range(rng.randint(1, 6)))))
    got = suffix_tree.lm_scores(docs_frame(spark, rows)).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.score > r.base_score for r in held)
    assert all(r.n_known == r.n_tokens for r in held)


def test_suffix_tree_on_empty_tables(spark):
    assert suffix_tree.lm_scores(docs_frame(spark, [])).count() == 0
    only_held = [(3, "a b c"), (None, "a b")]  # crc32("3") % 5 == 1: both held out, nothing learnt
    got = sorted(suffix_tree.lm_scores(docs_frame(spark, only_held)).collect(), key=lambda r: r.n_tokens)
    assert [r.train_tokens for r in got] == [0, 0] and [r.score for r in got] == [0.0, 0.0]


CONV = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    # names the operator uses itself
    T.StructField("dig", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("ts", T.StringType()),
])


def conversation_rows(seed=1):
    rng = random.Random(seed)
    openers = ["hello there", "hi", "Hey you, how are things?"]
    rows = []
    for c in range(0, 90):
        n = rng.choice([0, 1, 2, 3, 5, 8])
        first = rng.choice(openers)
        for t in range(n):
            role = "user" if t % 2 == 0 else "assistant"
            text = first if t == 0 else rng.choice(["ok", "sure thing", "no", f"turn {t}", ""])
            rows.append((c, t, role, text))
    for c in range(200, 206):  # copies of one conversation, a head that is absent for 220..
        rows += [(c, 0, "user", "same start"), (c, 1, "assistant", "same answer here")]
    rows += [(221, 0, "user", "a head that does not exist")]
    rows += [(230, t, "user" if t % 2 else "assistant", f"long {t % 7}") for t in range(120)]  # a long conversation
    rows += [
        (5, None, "user", "null turn first"), (6, 1, None, None), (6, 1, "user", "tie of turns"),
        (7, 0, "user", "repeated"), (7, 0, "user", "repeated"), (None, 0, "user", "no conversation"),
    ]
    return [(*r, "d", "s", "t") for r in rows]


def test_trie_matches_brute_force(spark):
    rows = conversation_rows()
    got = prefix_trie.trie(spark.createDataFrame(rows, CONV).repartition(4)).collect()
    want = brute_trie([r[:4] for r in rows])
    assert len(got) == len(want)
    for r in got:
        w = want[(r.conv_id, r.depth)]
        assert {k: r[k] for k in w} == w
    assert sorted(r.slot for r in got) == list(range(len(got)))
    by_slot = {r.slot: r for r in got}
    assert all(r.parent_slot is None if r.depth == 0 else by_slot[r.parent_slot].depth == r.depth - 1 for r in got)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CONV)).count() == 0
    one = prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b", None, None, None)], CONV)).count()
    assert one == 0
