"""Suffix-tree scores in rounds: the same scores, and the tables of a round replace those of the round before."""

from __future__ import annotations

import os
import random

import pytest

from tallytide.llm import suffix_tree

from .brute_lm import brute_pst
from .conftest import messy_rows


@pytest.mark.parametrize("rounds", [1, 5])
def test_rounds_give_the_scores_of_one_model(spark, rounds):
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in messy_rows()]
    rows += [(1000 + i, " ".join(rng.choice("abcdDeé") for _ in range(rng.randint(0, 40)))) for i in range(80)] + [(1001, "a b")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get(suffix_tree._RELEASE)
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    got = sorted((tuple(r) for r in suffix_tree.lm_scores(docs, rounds=rounds).collect()), key=key)
    want = sorted(brute_pst(rows), key=key)
    assert len(got) == len(want) and spark.conf.get(suffix_tree._RELEASE) == before
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-7, abs=1e-7)


def test_shards_are_disjoint_and_whole(spark):
    docs = spark.createDataFrame([(i, f"a b c {i} a b {i % 3}") for i in range(30)], "doc_id long, text string")
    toks = suffix_tree.tokens(docs)
    whole = sorted(map(tuple, suffix_tree.events(toks, range(4)).collect()))
    parts = [suffix_tree.events(toks, range(4), r, 3).collect() for r in range(3)]
    assert sorted(tuple(r) for part in parts for r in part) == whole
    seen = [{r["ctx"] for r in part if r["j"]} for part in parts]
    assert not (seen[0] & seen[1] or seen[0] & seen[2] or seen[1] & seen[2])
    assert all(r["parent"] in own for part, own in zip(parts, seen) for r in part if r["j"] > 1)


def test_a_round_replaces_the_tables_before(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_tree, "shared_folder", lambda _: str(tmp_path))
    docs = spark.createDataFrame([(i, f"a b c a b {i % 3}") for i in range(40)], "doc_id long, text string")
    suffix_tree.lm_scores(docs, rounds=4)
    models = [d for d in os.listdir(f"{tmp_path}/tallytide-tables") if os.path.isdir(f"{tmp_path}/tallytide-tables/{d}/counts")]
    assert len(models) == 1


@pytest.mark.parametrize("limit", [5, 60])
def test_hot_contexts_give_the_scores_of_one_model(spark, limit):
    """Contexts of every length above the limit, whose positions no task holds whole: the same scores."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("aaab") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(500 + i, "the line all texts share and " + rng.choice(["ends", "stops"])) for i in range(40)]
    rows += [(r[0], r[1]) for r in messy_rows()] + [(None, "a a a a b the line all texts"), (None, "a a a new a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (repr(r[0]), r[2], round(r[6], 6))
    got = sorted((tuple(r) for r in suffix_tree.lm_scores(docs, rounds=2, limit=limit).collect()), key=key)
    want = sorted(brute_pst(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-7, abs=1e-7)


def test_positions_of_a_hot_context_are_dealt_to_many_parts(spark):
    docs = spark.createDataFrame([(i, "a a a " + " ".join(f"x{i * j % 17}" for j in range(12)) + " a") for i in range(60)],
                                 "doc_id long, text string")
    texts, root = suffix_tree.train_root(suffix_tree.tokens(docs), hot_least=30)
    hot, sent = suffix_tree.train_hot(texts, root, 3, 3, 2.0, 1.0, 30, 1000)
    dealt = [r for r in suffix_tree.positions(texts, 3, hot, 1000).selectExpr("part", "length(w) div 8 AS n").collect()]
    most = max(sum(r["n"] for r in dealt if r["part"] == part) for part in {r["part"] for r in dealt})
    assert len(hot) == 3 and most <= 60 and sum(r["n"] for r in dealt) == 60 * 16
    pairs = [(r["part"], r["ctx"], r["w"]) for r in sent.collect()]
    assert len(pairs) == len(set(pairs)) and {r["k"] for r in sent.collect()} == {1, 2, 3}


def test_a_round_moves_every_position_once(spark):
    """Failed while every level was joined and every (position, context) row matched with the kept contexts."""
    docs = spark.createDataFrame([(i, f"a b c a b {i % 3}") for i in range(40)], "doc_id long, text string")
    texts, root = suffix_tree.train_root(suffix_tree.tokens(docs), hot_least=30)
    hot, sent = suffix_tree.train_hot(texts, root, 3, 3, 2.0, 1.0, 1000, 8)
    scores = suffix_tree.score_shard(texts, root, 3, 3, 2.0, 1.0, hot, sent, 8)
    plan = scores._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Window" not in plan
