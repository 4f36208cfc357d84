"""Each operator against a brute-force version or a held-out measure, and on rows with every defect."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallytide.llm import decontaminate, fingerprint, licences, lines, mixing, neardup, pii, quality, queries, secrets, urls, words
from tallytide.llm.common import components

from .conftest import messy_rows, sentence

SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- words --------------------------------------------------------------------------------


@pytest.mark.parametrize("table, pattern", [(words.SPACED, SPACED), (words.ALNUM, ALNUM)])
def test_hashed_words_follow_the_pattern(table, pattern, monkeypatch):
    monkeypatch.setattr(words, "SEGMENT", 7)  # borders inside words and texts
    texts = ["Ab ab\x00c", None, "", "x" * 40 + " y", "é-ö 漢字,Z1", "end", "end more\x0bwords\x1c", "a", "b"]
    hashes, ends = words.hash_words(pa.array(texts), table)
    want = [pattern.findall(lowered(t)) for t in texts]
    assert np.diff(ends).tolist() == [len(w) for w in want]
    names = {}
    for word, value in zip([w for ws in want for w in ws], hashes.tolist()):
        assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = components(spark.createDataFrame(chain, "a long, b long"), ("a",), ("b",)).collect()
    assert {r["v"]["c0"]: r["root"]["c0"] for r in got} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# --- 1 fingerprints -----------------------------------------------------------------------


def test_fingerprints_of_the_next_text(messy):
    got = fingerprint.compare_with_next(messy).collect()
    rows = [(r[0], r[1] or "") for r in messy_rows()]
    assert len(got) == len(rows)
    known = [r for r in rows if r[0] is not None and sum(x[0] == r[0] for x in rows) == 1]
    by_id = {r["doc_id"]: r for r in got}
    for key, text in known:
        below = sorted((x for x in rows if x[0] is not None and x[0] < key), key=lambda x: -x[0])
        if not below or sum(x[0] == below[0][0] for x in rows) > 1:
            continue
        other = fingerprint.edited(text, below[0][1])
        r = by_id[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(other.encode()).hexdigest()
        assert r["fingerprint"] == str(fingerprint.Tree(text))
        assert r["near_edited"] == pytest.approx(fingerprint.likeness(r["fingerprint"], r["edited_fingerprint"]))


def test_one_text_and_none(spark, no_docs):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert fingerprint.compare_with_next(one).first()["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert fingerprint.compare_with_next(no_docs).count() == 0


def test_edits_are_located_and_roots_test_equality():
    rng = random.Random(1)
    text = "\n".join(sentence(rng, 60) + "." for _ in range(40))
    at = 5000
    tree, other = fingerprint.Tree(text), fingerprint.Tree(text[:at] + "#" + text[at:])
    assert tree.root == fingerprint.Tree(text).root != other.root
    found = fingerprint.first_difference(tree, other)
    assert at - 300 <= found <= at
    assert fingerprint.likeness(str(tree), str(other)) > 0.9 > 0.2 > fingerprint.likeness(str(tree), str(fingerprint.Tree("zz " * 900)))
    assert fingerprint.first_difference(tree, tree) is None and fingerprint.likeness(str(fingerprint.Tree("")), str(fingerprint.Tree(""))) == 1


# --- 2 licences ---------------------------------------------------------------------------


def test_licences_whole_texts_and_lines(spark, messy, no_docs):
    mit = next(t for n, t in licences.KNOWN if n == "MIT" and len(t) > 500)
    docs = spark.createDataFrame([
        (1, "Copyright (c) 2020 Some One\n" + mit.upper().replace("COPYRIGHT NOTICE", "copyright  notice")),
        (2, "a text\nlicensed under the apache licence, version 2.0\nmore"), (3, "MIT"), (4, None), (5, ""),
        (2, "a text\nlicensed under the apache licence, version 2.0\nmore")], "doc_id long, text string")
    got = rows_of(licences.scan_licences(docs, licences.known_licences(spark)), "doc_id", "licence", "notices", "n_notices")
    two = (2, None, "Apache-2.0", 1)
    assert got == sorted([(1, "MIT", "", 0), two, two, (3, None, "", 0), (4, None, "", 0), (5, None, "", 0)], key=repr)
    known = licences.known_licences(spark)
    assert licences.scan_licences(messy, known).count() == len(messy_rows())
    assert licences.scan_licences(no_docs, known).count() == 0
    assert licences.scan_licences(docs, known.limit(0)).filter("licence is not null or n_notices > 0").count() == 0


def test_licences_wrapped_so_that_lines_begin_with_copyright(spark, tmp_path):
    whole = [(name, text) for name, text in licences.KNOWN if "\n" in text]
    docs, want = [], {}
    for name, text in whole:
        for width in range(70, 81):
            want[len(docs)] = name
            docs.append((len(docs), "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))))
        for line in ("Copyright (c) 2020 Some One", "Copyright 2020", "(C) 1999 A, B", "Copyright <year> <owner>", "© Some One",
                     "Copyright Some One", "Copyright: Nora Holderlin", "# Copyright The Authors. All rights reserved.", "Copyright Ören"):
            want[len(docs)] = name
            docs.append((len(docs), line + "\n" + text))
    assert any(line.lower().startswith("copyright notice") for _, text in docs for line in text.split("\n"))
    assert any(line.startswith("COPYRIGHT HOLDERS") for _, text in docs for line in text.split("\n"))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op2_license_scan"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == want


# --- 3 URLs -------------------------------------------------------------------------------


def test_url_rules_and_model(spark):
    cases = [
        ("http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/"), ("https://org/x?y#z", "org", "/x", "org/"),
        ("x", "", "", None), (None, "", "", None), ("http://badexample.org/en/12", "badexample.org", "/en/12", "org/"),
        ("a://b.org", "b.org", "", None), ("http://x.com/fr/", "x.com", "/fr/", "com/fr/"), ("", "", "", None),
        ("http://x.com/fr?u=http://y.org/", "x.com", "/fr", None), ("http://example.org/en/19", "example.org", "/en/19", "example.org/en/1"),
        ("http://q.com/de/1", "q.com", "/de/1", "com/de/"), ("http://q.com/de/1", "q.com", "/de/1", "com/de/"),
    ]
    pages = spark.createDataFrame([(i, c[0], "old") for i, c in enumerate(cases)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert len(got) == len(cases)
    for i, (_, host, path, rule) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        allow = {r.pattern: r.allow for r in urls.RULES}.get(rule)
        assert got[i]["verdict"] == ("allow" if allow else "block") if rule else got[i]["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_trees_learn_from_labelled_addresses(spark):
    rng = random.Random(3)

    def address(bad):
        name = "".join(rng.choice("abcdefghij") for _ in range(8))
        if bad:
            return f"http://{name}.biz/{rng.randint(10**8, 10**9)}?a={rng.randint(1, 99999)}&b={rng.randint(1, 99999)}&c=1"
        return f"https://www.{name}.edu/articles/{name}/index"

    made = [(address(i % 2), i % 2) for i in range(600)]
    labelled = spark.createDataFrame(made[:400], "url string, label int")
    test = spark.createDataFrame([(i, u, y) for i, (u, y) in enumerate(made[400:])], "page_id long, url string, y int")
    got = urls.judge(test, rules=(), labelled=labelled).collect()
    assert np.mean([(r["verdict"] == "block") == bool(r["y"]) for r in got]) > 0.95
    none = urls.judge(test, rules=(), labelled=labelled.limit(0))
    assert none.filter("verdict <> 'allow'").count() == 0


# --- 4 decontamination --------------------------------------------------------------------


def brute_windows(docs, items, size=10):
    out = []
    for key, text in docs:
        ws, hit, found = ALNUM.findall(lowered(text)), set(), set()
        for name, item in items:
            iw = ALNUM.findall(lowered(item))
            n = min(size, len(iw))
            for s in range(len(iw) - n + 1 if n else 0):
                for p in range(len(ws) - n + 1):
                    if ws[p : p + n] == iw[s : s + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(name))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(ws), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination_matches_brute_force(spark, messy, no_docs, block_bytes):
    rng = random.Random(9)
    items = [(i, sentence(rng, n)) for i, n in enumerate([25, 12, 10, 4, 1])] + [(9, None), (10, ""), (11, " - "), (None, "x y")]
    items.append((21, items[0][1]))
    docs = [(i, sentence(rng, 15) + " " + items[i % 5][1].upper().replace(" ", ", ") + " " + sentence(rng, 15)) for i in range(10)]
    docs += [(20, items[0][1] + " " + items[0][1]), (21, " ".join(items[0][1].split()[:9])), (22, None), (23, ""), (24, "Q"), (24, "Q")]
    table = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), table, block_bytes=block_bytes)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontaminate.report(marked), *columns) == brute_windows(docs, [x for x in items if x[0] is not None])
    if block_bytes > 200:
        kept = decontaminate.decontaminate(messy, table)
        assert set(messy.columns) <= set(kept.columns) and kept.count() == len(messy_rows())
        assert kept.schema["n_words"].dataType.typeName() == "long"
        assert decontaminate.decontaminate(no_docs, table).count() == 0
        assert decontaminate.report(decontaminate.decontaminate(messy, table.limit(0))).filter("contaminated").count() == 0


# --- 5 near-duplicates --------------------------------------------------------------------


def shingles(text):
    ws = SPACED.findall(lowered(text))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def brute_components(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(docs[i][0])
    out = []
    for i, (key, _) in enumerate(docs):
        known = [k for k in groups[find(i)] if k is not None]
        smallest = (min(known) if known else None) if sets[i] else key
        out.append((key, len(sets[i]), smallest, key == smallest))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_duplicates_on_messy_rows(messy, no_docs):
    got = rows_of(neardup.near_duplicates(messy), *COLUMNS)
    assert got == brute_components([(r[0], r[1]) for r in messy_rows()])
    assert neardup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_in_a_large_cluster(spark, monkeypatch):
    """A cluster of many blocks whose members are partly below the threshold of one another."""
    monkeypatch.setattr(neardup, "SMALL_NODE", 4)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 6)
    rng = random.Random(2)
    base, docs = sentence(rng, 160).split(), []
    for i in range(90):
        ws = list(base)
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = f"new{rng.randrange(10**6)}"
        docs.append((1000 - i, " ".join(ws)))
    docs += [(i, sentence(rng, 50)) for i in range(30)] + [(5000 + i, docs[3][1]) for i in range(20)]
    got = rows_of(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)), *COLUMNS)
    assert got == brute_components(docs)


# --- 6 mixing -----------------------------------------------------------------------------


def test_mix_targets_and_cuts(spark, messy, no_docs):
    rng = random.Random(4)
    docs = [(i, sentence(rng, rng.randint(0, 30)) or None, rng.choice(["a", "b", "c", "d", None, "a", "a"])) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix_plan(frame).collect()
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(SPACED.findall(text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    free, target = set(order), {}
    while True:  # the definition: reshare the excess until no target is above twice the size
        rest = 1.5 * sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    target |= share
    source_of = {d[0]: d[2] for d in docs}
    taken = Counter()
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    assert rows_of(mixing.mix_plan(frame.repartition(2)), "doc_id", "taken") == rows_of(mixing.mix_plan(frame), "doc_id", "taken")
    mixed = mixing.mix(messy)
    assert mixed.columns == [c for c in messy.columns if c != "taken"] + ["taken"]
    assert mixed.filter("taken > 0").count() == mixing.mix_plan(messy).filter("taken > 0").count()
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_plan(no_docs).count() == 0


# --- 7 personal data ----------------------------------------------------------------------

NAIVE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def naive_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(NAIVE.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and pii._luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if fits:
                out.append((k, *m.span()))
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(6)
    alphabet = ["a", "B", "@", "@", ".", ".", "-", " ", "+", "1", "2", "25", "4", "(", ")", "é", "4111111111111111", "x@y.z", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == naive_spans(text), text


def test_long_runs_are_read_once():
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 100_000, "1." * 100_000, "+1(" * 60_000, "1 " * 100_000):
        pii.candidates(text)


def test_the_method_adds_spans(spark, messy, no_docs):
    texts = ["please call (415) 555-0134 today", "phone (212) 555-0199 or jane.roe [at] site [dot] org", "order 1234567 page 7654321",
             "tel +1 (269) 555-3296 4111111111111111 end", "mail a.b@mail.example.com now"] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.report(pii.find_pii(docs)).collect()}
    assert len(got) == len(texts) and got[0]["n_phone"] == 0 and got[0]["spans"] == "phone:12:26"
    assert got[4]["n_email"] == 1 and got[4]["spans"] == "email:5:25" and got[2]["spans"] == ""
    redacted = {r["doc_id"]: r["text"] for r in pii.find_pii(docs, redact=True).collect()}
    assert redacted[0] == "please call [PHONE] today" and redacted[4] == "mail [EMAIL] now"
    assert "4111" not in redacted[3]
    assert pii.find_pii(messy).count() == len(messy_rows()) and pii.find_pii(no_docs).count() == 0


# --- 8 quality ----------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, messy, no_docs):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        good = i % 3 > 0
        text = sentence(rng, 60).capitalize() + "." if good else " ".join([rng.choice(("lon", "sara", "mi"))] * 40 + ["!!"] * 20)
        docs.append((i, text))
        labels.append((i, int(good), 0))
    labels += [(None, 1, 0), (5, None, 0), (5, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(d, marks)
    got = quality.score(d, model).withColumn("out", quality.held_out(F.col("doc_id"))).collect()
    held = [r for r in got if r["out"]]
    assert len(held) > 50 and np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in held]) > 0.98
    assert model.pairs is not None and quality.score(messy, model).count() == len(messy_rows())
    assert quality.score(no_docs, model).count() == 0
    nothing = quality.train(d, marks.limit(0))
    assert quality.accepted(messy, marks.limit(0)).count() == len(messy_rows()) and nothing.pairs == []


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9


# --- 9 lines ------------------------------------------------------------------------------


def test_line_dedup_matches_brute_force(spark, messy, no_docs):
    rng = random.Random(12)
    pool = [sentence(rng, n) for n in (3, 5, 8, 60, 4)]
    docs = [(i, "\n".join(rng.choice([*pool, sentence(rng, 9)]) + rng.choice(["", ".", "  "]) for _ in range(6))) for i in range(40)]
    docs += [(50, None), (51, ""), (52, "\n\n")]
    seen, want = set(), []
    for key, text in docs:
        spans, at = [], 0
        for part in (text or "").splitlines(keepends=True):
            plain = re.sub(r"[^\w]+", " ", part.lower()).strip()
            if plain.count(" ") >= 4:
                spans += [(at, at + len(part))] if plain in seen else []
                seen.add(plain)
            at += len(part)
        want.append((key, len(spans), spans))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = lines.repeated_lines(frame).collect()
    assert sorted((r["doc_id"], r["n_removed"], [(s["start"], s["end"]) for s in r["removed"]]) for r in got) == want
    cut = {r["doc_id"]: r["text"] for r in lines.without_repeats(frame).collect()}
    for (key, _, spans), (_, text) in zip(want, docs):
        kept = text if text is None else "".join(c for i, c in enumerate(text) if not any(a <= i < b for a, b in spans))
        assert cut[key] == kept
    assert lines.repeated_lines(messy).count() == len(messy_rows()) and lines.repeated_lines(no_docs).count() == 0
    assert lines.without_repeats(messy).columns == messy.columns
    assert lines.units_of("a b\n \nc\nd", paragraphs=True) == [(0, 6), (6, 9)]


def test_line_dedup_query_takes_short_and_unspaced_lines(spark, tmp_path):
    unspaced = "これは区切りのない長い一行の文章でありどの文書にも同じ形で現れる" * 3
    docs = [(1, f"Les.\n{unspaced}\n***\nan only line"), (2, f"les\n---\n***\n{unspaced}\n"), (3, "\n***\n LES! \nother"), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: [(s["start"], s["end"], s["first_doc"]) for s in r["removed"]]
           for r in queries.queries()["op9_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [(0, 4, 1), (12, 12 + len(unspaced) + 1, 1)], 3: [(5, 12, 1)], 4: []}


# --- 10 secrets ---------------------------------------------------------------------------


def test_secrets_on_held_out_findings(spark, messy, no_docs):
    rng = random.Random(13)

    def key(n):
        return "".join(rng.choice("0123456789abcdef") for _ in range(n))

    docs = []
    for i in range(120):
        filler = sentence(rng, 12)
        docs.append((i, (f'{filler} token = "{key(40)}" {filler}', f"{filler} password={key(18)}", f"{filler} stingstingtingstrastrasara {filler}",
                         f"{filler} 123456789012 page-item-file-1-example", f"{filler} api_key = {key(32)} x")[i % 5]))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = secrets.scan_secrets(frame).collect()
    for r in got:
        assert r["is_secret"] == (r["doc_id"] % 5 in (0, 1, 4)), r
    assert {r["doc_id"] for r in got if r["is_secret"]} == {i for i in range(120) if i % 5 in (0, 1, 4)}
    assert secrets.scan_secrets(no_docs).count() == 0 and secrets.scan_secrets(messy, path="source").count() >= 0
