from __future__ import annotations

import random

import pytest

from tallytide.llm import neardup

from .conftest import sentence
from .test_operators import COLUMNS, brute_components, rows_of


@pytest.mark.parametrize("percent", [80, 85])
def test_a_group_of_near_copies_is_branched_once(spark, monkeypatch, percent):
    """Nodes full of near copies were branched at every level, about 30 rows a text; every component stays as it is."""
    rng = random.Random(8)
    base, docs = sentence(rng, 150).split(), []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(500 + i, " ".join([*base[:30], *sentence(rng, 40).split()])) for i in range(60)]  # a passage in common
    docs += [(900 + i, sentence(rng, 50)) for i in range(20)]
    branch, rows = neardup._branch, []

    def counted(frame, *rest):
        out = branch(frame, *rest)
        rows.append(out.count() if "node" in frame.columns else 0)
        return out

    monkeypatch.setattr(neardup, "_branch", counted)
    got = rows_of(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), percent=percent), *COLUMNS)
    assert got == brute_components(docs, percent)
    assert sum(rows) < 8 * len(docs), rows
