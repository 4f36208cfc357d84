"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm import (
    decontaminate, fingerprint, licences, lines, mixing, negatives, neardup, pii, prefix_trie, quality, secrets,
    suffix_tree, urls,
)
from tallytide.llm.common import table
from tallytide.llm.registry import QUERIES, SQL, query

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  WHERE text IS NOT NULL AND item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM items WHERE len(w) > 0)
),
grams AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT doc_id, p, n, item_id FROM grams JOIN windows USING (n, g)),
places AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""


OP11_SQL = r"""
WITH e AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
),
a AS (SELECT * FROM e WHERE vec_id % 50 = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, e.vec_id AS id, e.label,
         coalesce(list_sum(list_transform(range(1, least(len(a.v), len(e.v)) + 1), lambda i: a.v[i] * e.v[i])), 0) AS score
  FROM a JOIN e ON e.vec_id <> a.vec_id
),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r FROM s WHERE label = anchor_label)
  WHERE r <= 5
),
neg AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 3
"""


# crc32 of the decimal id, bit by bit (reflected polynomial 0xEDB88320), as DuckDB has none
OP13_SQL = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id,
         list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
              ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
bits AS (
  SELECT conv_id, ts, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                 lambda ch: [ascii(ch), -1, -1, -1, -1, -1, -1, -1])) AS steps
  FROM t
),
crc AS (
  SELECT conv_id, ts,
         xor(list_reduce(list_prepend(4294967295, steps), lambda c, x:
             xor((CASE WHEN x >= 0 THEN xor(c, x) ELSE c END) >> 1,
                 CASE WHEN ((CASE WHEN x >= 0 THEN xor(c, x) ELSE c END) & 1) = 1 THEN 3988292384 ELSE 0 END)),
             4294967295) % 4 AS h
  FROM bits
),
r AS (
  SELECT o.conv_id, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts
  FROM crc o LEFT JOIN t b ON b.conv_id = o.conv_id - o.conv_id % 20
),
p AS (SELECT conv_id, len(ts) AS n, d, ts[1:d] AS prefix FROM r, range(0, len(ts) + 1) AS g(d)),
nodes AS (
  SELECT prefix, max(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN d = n THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
         CASE WHEN max(d) = 0 THEN 0
              ELSE len(regexp_extract_all(prefix[max(d)].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM p GROUP BY prefix
),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
withkids AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (prefix)),
up AS (
  SELECT u.prefix[1:a] AS prefix, sum((u.n_convs - 1) * u.words) AS saved_tokens,
         sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM withkids u, range(0, u.depth + 1) AS g(a) GROUP BY 1
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, f.n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(up.n_leaves AS BIGINT) AS n_leaves,
       CAST(up.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM withkids f JOIN up USING (prefix) LEFT JOIN nodes q ON f.depth > 0 AND q.prefix = f.prefix[1:f.depth - 1]
"""


def _mix_sql(rounds: int = 12) -> str:
    """Shares raised until none is above its cap; twelve rounds are more than the sources of the tables need."""
    steps = ["r0 AS (SELECT 1.5 * sum(source_size) / sum(weight) AS rate FROM src)"]
    for k in range(1, rounds + 1):
        steps.append(f"""r{k} AS (
  SELECT greatest(rate, coalesce((SELECT 1.5 * sum(source_size) FROM src) - s.capped, 0) / s.free) AS rate
  FROM r{k - 1}, (SELECT coalesce(sum(CASE WHEN weight * rate > 2.0 * source_size THEN 2.0 * source_size END), 0) AS capped,
                         sum(CASE WHEN weight * rate > 2.0 * source_size THEN 0.0 ELSE weight END) AS free
                  FROM src, r{k - 1}) s)""")
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
),
src AS (
  SELECT source, source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM sized GROUP BY source)
),
{", ".join(steps)},
targets AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(2.0 * source_size, weight * rate) AS target FROM src, r{rounds}),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(floor(target - whole * source_size) AS BIGINT) - before)) AS BIGINT) AS taken
FROM placed
"""


def _canonical_sql(text: str) -> str:
    out = _LOWER.format(f"coalesce({text}, '')")
    for spelling, same in licences.SPELLINGS:
        out = f"replace({out}, '{spelling}', '{same}')"
    out = f"regexp_replace({out}, '{licences._COPYRIGHT}', '', 'g')"
    out = f"regexp_replace({out}, '{licences._GAPS}', ' ', 'g')"
    return f"list_filter(list_transform(string_split({out}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _licence_sql() -> str:
    rows = ", ".join("('" + name + "', '" + text.replace("'", "''") + "')" for name, text in licences.KNOWN)
    return f"""
WITH given(licence, text) AS (VALUES {rows}),
known AS (
  SELECT array_to_string({_canonical_sql("text")}, ' ') AS body, min(licence) AS licence FROM given GROUP BY 1
),
texts AS (SELECT doc_id, {_canonical_sql("text")} AS ls FROM documents),
line_hits AS (
  SELECT doc_id, licence FROM (SELECT doc_id, unnest(ls) AS body FROM texts) JOIN known USING (body)
),
notices AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices FROM line_hits GROUP BY doc_id
)
SELECT t.doc_id, k.licence, coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM texts t LEFT JOIN known k ON len(t.ls) > 0 AND array_to_string(t.ls, ' ') = k.body LEFT JOIN notices n USING (doc_id)
"""


@query("op1_document_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


@query("op2_license_scan", _licence_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"), licences.known_licences(spark))


@query("op3_url_filter")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), keep=["page_id"])


@query("op4_benchmark_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.report(marked)


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_mix_sources", _mix_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).drop("tie")


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op9_line_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_passages(table(spark, sf_dir, "documents"), min_words=1)


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor (vec_id divisible by 50) against all embeddings: 5 positives, 3 negatives each."""
    return negatives.mine(table(spark, sf_dir, "embeddings"))


@query("op12_lm_scoring")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a suffix-tree model learnt from those not held out (no SQL: tested by brute force)."""
    return suffix_tree.lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op13_conversation_trie", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations (the operator's slot columns are not compared)."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
