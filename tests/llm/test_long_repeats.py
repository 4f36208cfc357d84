from __future__ import annotations

from tallytide.llm import lines


def test_long_repeats_are_counted_apart(spark):
    passage = "one two three four five six"
    texts = [f"Les.\n{passage}\n", f"Les.\n{passage}\nend\n", "Les.\nother words\n", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lines.repeated_lines(docs, min_words=1).collect()}
    assert [got[i]["n_removed"] for i in range(4)] == [0, 2, 1, 0]
    assert [got[i]["n_long_removed"] for i in range(4)] == [0, 1, 0, 0]
    kept = {r["doc_id"]: r["text"] for r in lines.without_repeats(docs, min_words=1).collect()}
    assert kept == {0: texts[0], 1: "end\n", 2: "other words\n", 3: None}
